"""The curation workflows as graphs of steps, restartable at any step.

Chat corpus: 1 profile; 2 sample and 3 exact dedup after it; 4 semantic dedup and 5 leakage check after 3; 6 clean build.
Fine-tuning data: normalize, format, exact dedup, semantic dedup, decontaminate, curriculum, profile, sample.

Steps hand tables to each other as Parquet below ``out``, so a later run can start from any of them.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import chat
from corpuskit.functions import text as T
from corpuskit.operators import clean, curriculum, exact, leakage, ngrams, profile, sampling, vectors
from corpuskit.sources import sinks

STEPS = ("profile", "sample", "exact", "semantic", "leakage", "build")


@dataclass
class Settings:
    sample_size: int = sampling.SIZE
    seed: int = sampling.SEED
    threshold: float = 0.93
    neighbours: int = 10
    leakage_threshold: float = 0.88
    leakage_neighbours: int = 5
    #: None removes all rows with mentions or rubric leaks; a number (``leakage.SAMPLE_CAP`` for compatibility) only the first of each.
    sample_cap: int | None = None
    provider: object = field(default_factory=vectors.feature_hash_provider)


class ChatCorpus:
    """``rows``: row_id and messages (array of role and content). ``benchmarks``: row_id, benchmark, text; may be absent."""

    def __init__(self, rows: DataFrame, out: str, benchmarks: DataFrame | None = None, settings: Settings | None = None):
        m = F.col("messages")
        self.spark, self.out, self.benchmarks, self.settings = rows.sparkSession, out.rstrip("/"), benchmarks, settings or Settings()
        self.rows = rows.select(
            "row_id", "messages", F.size(m).alias("n_messages"), chat.role_path(m).alias("role_path"), chat.last(m, "user").alias("user"),
            chat.last(m, "assistant").alias("assistant"), chat.first(m, "user").alias("first_user"), chat.longest_assistant(m).alias("length"),
        )
        self.seconds: dict[str, float] = {}

    def run(self, start: str = STEPS[0], stop: str = STEPS[-1]) -> dict[str, float]:
        """Run the steps from ``start`` to ``stop``; gives the seconds each took."""
        first, last = STEPS.index(start), STEPS.index(stop)
        if first > last:
            raise ValueError(f"{start} comes after {stop}")
        for name in STEPS[first : last + 1]:
            began = time.time()
            getattr(self, name)()
            self.seconds[name] = time.time() - began
        return self.seconds

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.out}/{name}")
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    def profile(self) -> None:
        r = self.rows
        lengths = {"user_chars": F.length("user"), "assistant_chars": F.length("assistant"), "messages": F.col("n_messages")}
        report = {
            "counters": profile.counters(r, "user", "assistant"), "lengths": profile.moments(r, lengths), "roles": profile.top_counts(r, F.col("role_path"), 20),
            "languages": profile.top_counts(r, T.language("user")), "wrappers": profile.wrapper_counts(r, "assistant"),
            "user_histogram": profile.width_histogram(r, F.length("user")), "think_histogram": profile.think_histogram(r, "assistant"),
            "declared": profile.declared_vs_actual(r, "user", "assistant"),
        }
        sinks.write_report(self.spark, f"{self.out}/profile.json", sinks.nested(report))

    def sample(self) -> None:
        s = self.settings
        r = self.rows.select("row_id", "user", "assistant")
        strata = {
            "uniform": F.lit("uniform"), "language": F.concat(F.lit("language_"), T.language("user")), "type": F.when(T.is_mcq_broad("user"), "type_mcq").otherwise("type_open"),
        }
        parts = [sampling.per_stratum(r, c, s.sample_size, s.seed).drop("place") for c in strata.values()]
        parts.append(sampling.by_topic(r, "user", s.sample_size, s.seed).drop("place"))
        tops = {"longest_user": (F.length("user"), True), "shortest_user": (F.length("user"), False), "longest_assistant": (F.length("assistant"), True)}
        parts += [sampling.top_k(r, c, s.sample_size, high).drop("score").withColumn("stratum", F.lit(n)) for n, (c, high) in tops.items()]
        parts.append(sampling.longest_think(r, "assistant", s.sample_size).drop("score").withColumn("stratum", F.lit("longest_think")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        sinks.write_slices(out, f"{self.out}/sample")

    def exact(self) -> None:
        hashed = self._write(exact.digests(self.rows, "user", "assistant"), "digests")
        self._write(exact.keep_first(hashed, "l3").where("not kept").select("row_id"), "exact_removed")
        self._write(exact.clusters(hashed, "l3"), "exact_clusters")  # a group may hold any number of rows
        report = {"levels": exact.report(hashed), "templates": exact.top_templates(self.rows, hashed, "user")}
        sinks.write_report(self.spark, f"{self.out}/exact.json", sinks.nested(report))

    def _left(self) -> DataFrame:
        return self.rows.join(self.table("exact_removed"), "row_id", "left_anti")

    def semantic(self) -> None:
        s = self.settings
        texts = self._left().select("row_id", T.for_embedding("first_user").alias("text"))
        embedded = sinks.resume_embeddings(texts, s.provider, f"{self.out}/embeddings")
        edges = self._write(vectors.neighbours(embedded, embedded, s.neighbours), "edges")
        labels = self._write(vectors.components(vectors.undirected(edges, s.threshold)), "clusters")
        chosen = vectors.representatives(labels, self.rows.select("row_id", "length"))
        self._write(vectors.removed(labels, chosen).select("row_id"), "semantic_removed")
        near = vectors.nearest(edges)
        report = {
            "histogram": profile.edge_histogram(near, F.col("score"), profile.SELF_BINS), "percentiles": profile.percentiles(near, F.col("score")),
            "bands": vectors.bands(edges), "sizes": vectors.size_counts(labels), "largest": vectors.largest(labels),
        }
        sinks.write_report(self.spark, f"{self.out}/semantic.json", sinks.nested(report))

    def leakage(self) -> None:
        s = self.settings
        left = self._left()
        flags = self._write(leakage.flagged(left, "user", "assistant"), "leak_flags")
        high = leakage.sample_ids(flags, "mention", s.sample_cap).unionByName(leakage.sample_ids(flags, "rubric", s.sample_cap)).distinct()
        self._write(high, "leak_high")
        report = {"benchmarks": leakage.by_benchmark(flags), "totals": leakage.totals(flags), "previews": leakage.top_previews(left, flags, "user")}
        found = self.spark.createDataFrame([], "row_id bigint")
        if self.benchmarks is not None:
            asked = vectors.embed(self.benchmarks, s.provider)
            edges = vectors.neighbours(self.table("embeddings"), asked, s.leakage_neighbours, exclude_self=False)
            matches = self._write(vectors.matches(edges, s.leakage_threshold), "leak_matches")
            names = self.benchmarks.select(F.col("row_id").alias("src"), "benchmark")
            found = matches.select(F.col("dst").alias("row_id")).distinct()
            report |= {"cross": vectors.per_benchmark(names, matches), "cross_top": vectors.top_matches(names, matches)}
        self._write(found, "leak_embedding")
        sinks.write_report(self.spark, f"{self.out}/leakage.json", sinks.nested(report))

    def build(self) -> None:
        sets = {r: self.table(t) for r, t in zip(clean.REASONS, ("exact_removed", "semantic_removed", "leak_high", "leak_embedding"))}
        log = self._write(clean.removal_log(sets), "removal_log")
        sinks.write_jsonl(clean.kept(self.rows, log).select("row_id", "messages"), f"{self.out}/clean")
        counts = {r.reason: r.rows for r in clean.reason_counts(log).collect()}
        steps = [(r.stage, r.rows) for r in clean.funnel(self.rows, sets).orderBy("step").collect()]
        sinks.write_text(self.spark, f"{self.out}/report.md", markdown(steps, counts))


def markdown(steps: list[tuple[str, int]], reasons: dict[str, int]) -> str:
    total, left = steps[0][1], steps[-1][1]
    share = 100 * (total - left) / total if total else 0.0
    lines = ["# Clean build", "", f"Rows: {total:,} in, {left:,} out ({share:.2f} % removed).", "", "| stage | rows |", "|-|-:|", *[f"| {s} | {n:,} |" for s, n in steps]]
    lines += ["", "| reason | rows |", "|-|-:|", *[f"| {r} | {n:,} |" for r, n in sorted(reasons.items(), key=lambda x: -x[1])], ""]
    return "\n".join(lines)


def normalized(raw: DataFrame, min_arabic_ratio: float = 0.85, compat: bool = False, language_filter=None) -> DataFrame:
    """Envelopes (row_id, source, source_config, split, row) to chat rows: one shape, clean texts, both sides present, mostly Arabic.

    The question type is read before lines are joined, ``compat`` reads it after (and so never finds one). ``language_filter`` is a
    column function that replaces the ratio.
    """
    m = F.col("messages")
    rows = raw.select("row_id", F.struct(F.coalesce("source", F.lit("unknown")).alias("source"), "source_config", "split").alias("meta"), chat.dispatch(F.col("row")).alias("messages")).where(F.size("messages") > 0)
    flat = rows.select("row_id", "meta", F.posexplode("messages").alias("pos", "x"))
    cleaned = flat.select("row_id", "meta", "pos", F.col("x.role").alias("role"), T.filled("x.content").alias("raw"), T.unicode_clean(T.filled("x.content")).alias("content"))
    message = F.struct("pos", F.struct("role", "content").alias("m"), "raw")
    again = cleaned.groupBy("row_id", "meta").agg(F.sort_array(F.collect_list(message)).alias("all"))
    again = again.select("row_id", "meta", F.transform("all", lambda x: x["m"]).alias("messages"), F.try_element_at(F.filter("all", lambda x: x["m"]["role"] == "user"), F.lit(1))["raw"].alias("raw_user"))
    user = chat.first(m, "user")
    kept = again.where((user != "") & (chat.first(m, "assistant") != "")).where(language_filter(user) if language_filter else T.arabic_ratio(user) >= min_arabic_ratio)
    return kept.select("row_id", "messages", T.is_mcq_line(user if compat else T.filled("raw_user")).alias("is_mcq"), "meta")


def formatted(rows: DataFrame, system: str, compat: bool = False) -> DataFrame:
    """System prompt first; answers of question rows as letters."""
    m = F.col("messages")
    letters = F.transform(m, lambda x: F.when(F.col("is_mcq") & (x["role"] == "assistant"), F.struct(x["role"].alias("role"), T.answer_letter(x["content"], compat).alias("content"))).otherwise(x))
    return rows.withColumn("messages", letters).withColumn("messages", chat.with_system(m, F.lit(system)))


def tuning_data(raw: DataFrame, benchmarks: DataFrame, out: str, system: str, broad: str, parts: list[str], provider=None, threshold: float = 0.95, k: int = 4, compat: bool = False, min_arabic_ratio: float = 0.85) -> dict[str, int]:
    """The whole chain for fine-tuning data; every step is written below ``out``. Gives the rows of each step."""
    spark, counts = raw.sparkSession, {}

    def step(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        made = spark.read.parquet(f"{out}/{name}")
        counts[name] = made.count()
        return made

    rows = step("normalized", normalized(raw, min_arabic_ratio, compat))
    rows = step("formatted", formatted(rows, system, compat))
    m = F.col("messages")
    texts = rows.select("row_id", chat.last(m, "user").alias("user"), chat.last(m, "assistant").alias("assistant"), chat.first(m, "user").alias("text"))
    rows = step("exact_deduped", rows.join(exact.keep_first(exact.digests(texts, "user", "assistant"), "l3").where("kept").select("row_id"), "row_id", "left_semi"))
    embedded = step("embeddings", vectors.embed(rows.select("row_id", chat.first(m, "user").alias("text")), provider or vectors.feature_hash_provider()))
    rows = step("deduped", rows.join(vectors.greedy_keep(embedded, vectors.neighbours(embedded, embedded, k), threshold).where("kept").select("row_id"), "row_id", "left_semi"))
    prompts = rows.select("row_id", chat.first(m, "user").alias("text"))
    rows = step("decontaminated", ngrams.decontaminated(rows, ngrams.hits(prompts, benchmarks)))
    sourced = rows.withColumn("source", F.col("meta.source"))
    step("phase1", curriculum.phase1(sourced, broad).drop("source"))
    step("phase2", curriculum.phase2(sourced, parts).drop("source", "part"))
    by_source = {r["source"]: r["rows"] for r in curriculum.counts(sourced).collect()}
    sinks.write_text(spark, f"{out}/curriculum.yaml", curriculum.as_yaml({"phase1": {broad: by_source.get(broad, 0)}, "phase2": {p: by_source.get(p, 0) for p in parts}}, ["Lower the learning rate before phase2."]))
    return counts
