"""Vector and evaluation-store queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.operators import evalstore, profile, rollups, vectors
from corpuskit.plans import inputs as I
from corpuskit.staging import staged

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
#: The driver's vectors hardly resemble each other; at this cosine about a third of them have a neighbour.
THRESHOLD = 0.35


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- neighbours -----------------------------------------------------------------------------------------------------------------


def _knn_sql(src: str, dst: str, k: int) -> str:
    """Ranked cosine neighbours; ``src`` and ``dst`` are conditions on ids."""
    return (
        "v AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL), "
        "u AS (SELECT id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v), "
        f"s AS (SELECT q.id AS src, p.id AS dst, list_dot_product(q.e, p.e) / (q.n * p.n) AS score FROM u q JOIN u p ON q.id <> p.id WHERE {src} AND {dst}), "
        f"r AS (SELECT src, dst, score, CAST(row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS INTEGER) AS rank FROM s), knn AS (SELECT * FROM r WHERE rank <= {k})"
    )


_ALL = _knn_sql("true", "true", 10)
_SEARCH = _knn_sql("q.id % 20 = 0", "true", 10)
_CROSS = _knn_sql("q.id % 20 = 0", "true", 5)


def _self(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = I.vectors(spark, sf_dir)
    return staged(vectors.neighbours(v, v, 10), "edges")


def _cross(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v = I.vectors(spark, sf_dir)
    asked = v.where("row_id % 20 = 0")
    return vectors.neighbours(v, asked, 5), asked.select(F.col("row_id").alias("src"), F.concat(F.lit("b"), F.col("label").cast("string")).alias("benchmark"))


@query(f"WITH {_SEARCH} SELECT src, dst, round(score, 5) AS score, rank FROM knn")
def knn_topk(spark, sf_dir):
    v = I.vectors(spark, sf_dir)
    return vectors.neighbours(v, v.where("row_id % 20 = 0"), 10).select("src", "dst", F.round("score", 5).alias("score"), "rank")


def _hist_sql(edges: tuple) -> str:
    n = len(edges) - 1
    return " UNION ALL ".join(
        f"SELECT {k} AS bin, CAST({edges[k]} AS DOUBLE) AS low, CAST({edges[k + 1]} AS DOUBLE) AS high, count(*) AS count FROM knn WHERE rank = 1 AND score >= {edges[k]} AND score {'<' if k < n - 1 else '<='} {edges[k + 1]}" for k in range(n)
    )


#: Finer bins than the defaults, where the driver's vectors lie.
FINE = (0, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 1.01)


@query(f"WITH {_ALL} {_hist_sql(profile.SELF_BINS)}")
def sim_histogram(spark, sf_dir):
    return profile.edge_histogram(vectors.nearest(_self(spark, sf_dir)), F.col("score"), profile.SELF_BINS)


@query(f"WITH {_ALL} {_hist_sql(FINE)}")
def sim_histogram_fine(spark, sf_dir):
    return profile.edge_histogram(vectors.nearest(_self(spark, sf_dir)), F.col("score"), FINE)


_PERCENTILES = "round(avg(score), 5) AS mean, round(max(score), 5) AS max, " + ", ".join(f"round(quantile_cont(score, {p / 100}), 5) AS p{p}" for p in (50, 90, 95, 99))


@query(f"WITH {_ALL} SELECT {_PERCENTILES} FROM knn WHERE rank = 1")
def sim_percentiles(spark, sf_dir):
    out = profile.percentiles(vectors.nearest(_self(spark, sf_dir)), F.col("score"))
    return out.select(*[F.round(c, 5).alias(c) for c in out.columns])


BANDS = ((">=0.45", 0.45, 9.0), ("0.40-0.45", 0.40, 0.45), ("0.35-0.40", 0.35, 0.40))
_BAND = "CASE " + " ".join(f"WHEN score >= {a} AND score < {b} THEN '{n}'" for n, a, b in BANDS) + " END"


@query(
    f"WITH {_ALL}, b AS (SELECT *, {_BAND} AS band FROM knn WHERE dst > src), o AS (SELECT *, CAST(row_number() OVER (PARTITION BY band ORDER BY src, rank) AS INTEGER) AS place FROM b WHERE band IS NOT NULL) "
    "SELECT band, place, src, dst, round(score, 5) AS score FROM o WHERE place <= 50"
)
def sim_bands(spark, sf_dir):
    return vectors.bands(_self(spark, sf_dir), BANDS).withColumn("score", F.round("score", 5))


# --- clusters -------------------------------------------------------------------------------------------------------------------

_GRAPH = (
    f"RECURSIVE {_ALL}, e AS (SELECT src AS a, dst AS b FROM knn WHERE score >= {THRESHOLD} UNION SELECT dst, src FROM knn WHERE score >= {THRESHOLD}), "
    "reach(node, other) AS (SELECT a, a FROM e UNION SELECT r.node, e.b FROM reach r JOIN e ON r.other = e.a), labels AS (SELECT node AS row_id, min(other) AS cluster FROM reach GROUP BY node), "
    "chosen AS (SELECT cluster, arg_min(row_id, (-coalesce(n_chars, 0), row_id)) AS representative FROM labels LEFT JOIN documents ON doc_id = row_id GROUP BY cluster)"
)


def _labels(spark, sf_dir):
    return vectors.components(vectors.undirected(_self(spark, sf_dir), THRESHOLD))


def _lengths(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("n_chars").alias("length"))


@query(f"WITH {_GRAPH}, z AS (SELECT cluster, count(*) AS size FROM labels GROUP BY 1) SELECT CAST(row_number() OVER (ORDER BY size DESC, cluster) - 1 AS INTEGER) AS cluster_id, cluster, size FROM z")
def sem_clusters(spark, sf_dir):
    return vectors.clusters(_labels(spark, sf_dir))


@query(f"WITH {_GRAPH} SELECT cluster, representative FROM chosen")
def sem_representatives(spark, sf_dir):
    return vectors.representatives(_labels(spark, sf_dir), _lengths(spark, sf_dir))


@query(f"WITH {_GRAPH} SELECT vec_id AS row_id FROM embeddings WHERE vec_id NOT IN (SELECT row_id FROM labels JOIN chosen USING (cluster) WHERE row_id <> representative)")
def sem_keep(spark, sf_dir):
    labels = _labels(spark, sf_dir)
    gone = vectors.removed(labels, vectors.representatives(labels, _lengths(spark, sf_dir)))
    return I.vectors(spark, sf_dir).select("row_id").join(gone.select("row_id"), "row_id", "left_anti")


@query(f"WITH {_GRAPH}, z AS (SELECT cluster, count(*) AS size FROM labels GROUP BY 1) SELECT size, count(*) AS clusters FROM z WHERE size <= 15 GROUP BY 1")
def cluster_size_hist(spark, sf_dir):
    return vectors.size_counts(_labels(spark, sf_dir))


@query(f"WITH {_GRAPH}, z AS (SELECT cluster, count(*) AS size FROM labels GROUP BY 1) SELECT cluster, size FROM z WHERE size > 15 ORDER BY size DESC, cluster LIMIT 30")
def cluster_largest(spark, sf_dir):
    return vectors.largest(_labels(spark, sf_dir))


# a step per row that has neighbours, in the order of ids
_WALK = (
    f"RECURSIVE {_ALL}, n AS MATERIALIZED (SELECT src, list(DISTINCT dst) AS others, row_number() OVER (ORDER BY src) AS step FROM s WHERE score >= {THRESHOLD} GROUP BY src), "
    "walk(step, gone) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL "
    "SELECT n.step, CASE WHEN list_contains(gone, src) THEN gone ELSE list_concat(gone, others) END FROM walk JOIN n ON n.step = walk.step + 1), "
    "lost AS (SELECT DISTINCT unnest(gone) AS row_id FROM (SELECT arg_max(gone, step) AS gone FROM walk))"
)


@query(f"WITH {_WALK} SELECT vec_id AS row_id, vec_id NOT IN (SELECT row_id FROM lost) AS kept FROM embeddings")
def sem_greedy_keep(spark, sf_dir):
    """All pairs at the threshold count, not the nearest few of each row."""
    return vectors.greedy_keep_all(I.vectors(spark, sf_dir), THRESHOLD)


# --- cross search ---------------------------------------------------------------------------------------------------------------

_FOUND = f"{_CROSS}, q AS (SELECT vec_id AS src, 'b' || CAST(label AS VARCHAR) AS benchmark FROM embeddings WHERE vec_id % 20 = 0), found AS (SELECT knn.*, benchmark FROM knn JOIN q USING (src) WHERE score >= {THRESHOLD})"


@query(f"WITH {_FOUND} SELECT benchmark, src, dst, round(score, 5) AS score, rank FROM found")
def xsearch_matches(spark, sf_dir):
    edges, asked = _cross(spark, sf_dir)
    return vectors.matches(edges, THRESHOLD).join(asked, "src").select("benchmark", "src", "dst", F.round("score", 5).alias("score"), "rank")


@query(
    f"WITH {_FOUND}, z AS (SELECT benchmark, count(*) AS p, count(DISTINCT src) AS w, count(DISTINCT dst) AS t FROM found GROUP BY 1) "
    "SELECT benchmark, count(*) AS questions, coalesce(max(p), 0) AS match_pairs, coalesce(max(w), 0) AS questions_with_match, coalesce(max(t), 0) AS training_rows FROM q LEFT JOIN z USING (benchmark) GROUP BY 1"
)
def xsearch_per_bench(spark, sf_dir):
    edges, asked = _cross(spark, sf_dir)
    return vectors.per_benchmark(asked, vectors.matches(edges, THRESHOLD))


@query(f"WITH {_CROSS} {_hist_sql(profile.LEAK_BINS)}")
def xsearch_hist(spark, sf_dir):
    return profile.edge_histogram(vectors.nearest(_cross(spark, sf_dir)[0]), F.col("score"), profile.LEAK_BINS)


@query(f"WITH {_CROSS} SELECT {_PERCENTILES} FROM knn WHERE rank = 1")
def xsearch_percentiles(spark, sf_dir):
    out = profile.percentiles(vectors.nearest(_cross(spark, sf_dir)[0]), F.col("score"))
    return out.select(*[F.round(c, 5).alias(c) for c in out.columns])


@query(
    f"WITH {_FOUND}, o AS (SELECT *, CAST(row_number() OVER (PARTITION BY benchmark ORDER BY score DESC, src, rank) AS INTEGER) AS place FROM found) SELECT benchmark, place, src, dst, round(score, 5) AS score FROM o WHERE place <= 10"
)
def xsearch_top10(spark, sf_dir):
    edges, asked = _cross(spark, sf_dir)
    return vectors.top_matches(asked, vectors.matches(edges, THRESHOLD)).withColumn("score", F.round("score", 5))


@query(
    f"WITH {_CROSS}, b AS (SELECT *, {_BAND} AS band FROM knn WHERE rank = 1), o AS (SELECT *, CAST(row_number() OVER (PARTITION BY band ORDER BY src, rank) AS INTEGER) AS place FROM b WHERE band IS NOT NULL) "
    "SELECT band, place, src, dst, round(score, 5) AS score FROM o WHERE place <= 30"
)
def xsearch_bands(spark, sf_dir):
    return vectors.bands(_cross(spark, sf_dir)[0], BANDS, k=30, one_way=False, only_first=True).withColumn("score", F.round("score", 5))


# --- evaluation store: requests and statistics made of events ------------------------------------------------------------------------

_RUN = "concat('bench', CAST(user_id % 3 AS VARCHAR), ':subset=', event_type, ',model=m')"
_RUN_SPARK = "concat('bench', CAST(user_id % 3 AS STRING), ':subset=', event_type, ',model=m')"


def _stat(name: str, mean, total):
    return F.struct(F.struct(F.lit(name).alias("name")).alias("name"), mean.cast("double").alias("mean"), total.cast("double").alias("sum"))


def _metrics(spark, sf_dir):
    """Each event is an instance: an overwritten exact match, a sum without a mean, and for bench2 a judge's score."""
    e, none = I.table(spark, sf_dir, "events"), F.lit(None)
    stats = F.array(
        _stat("exact_match", F.lit(0.5), none), _stat("exact_match", F.when(F.col("event_id") % 3 == 0, 1.0).otherwise(0.0), none), _stat("num_completion_tokens", none, F.col("event_id") % 7),
        _stat("other", F.lit(9.0), none), _stat("inference_runtime", none, none),
    )
    judged = F.when(F.col("user_id") % 3 == 2, F.array(_stat("alrage_score", F.col("event_id") % 10 / 10, none))).otherwise(F.array().cast(f"array<{evalstore.STAT}>"))
    rows = e.select(F.expr(_RUN_SPARK).alias("run_dir"), F.concat(F.lit("id"), F.col("event_id").cast("string")).alias("instance_id"), F.lit(0).alias("entry"), F.concat(stats, judged).alias("stats"))
    return evalstore.instance_metrics(rows)


def _states(spark, sf_dir):
    e = I.table(spark, sf_dir, "events")
    reference = lambda text, tags: F.struct(F.struct(text.alias("text")).alias("output"), tags.alias("tags"))
    references = F.array(reference(F.lit("no"), F.array().cast("array<string>")), reference(F.col("event_type"), F.when(F.col("event_id") % 5 > 0, F.array(F.lit("correct"))).otherwise(F.array().cast("array<string>"))))
    answer = F.struct(F.when(F.col("event_id") % 2 == 0, "A").otherwise("C").alias("text"), F.struct(F.lit("stop").alias("reason")).alias("finish_reason"))
    completions = F.when(F.col("event_id") % 11 > 0, F.array(answer)).otherwise(F.filter(F.array(answer), lambda x: F.lit(False)))
    state = F.struct(
        F.struct(F.concat(F.lit("id"), F.col("event_id").cast("string")).alias("id"), F.struct(F.col("event_type").alias("text")).alias("input"), references.alias("references")).alias("instance"),
        F.when(F.col("user_id") % 3 != 2, F.create_map(F.lit("A"), F.col("event_type"))).alias("output_mapping"), F.struct(F.lit("p").alias("prompt")).alias("request"),
        F.struct(completions.alias("completions"), F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 100 / 8).alias("request_time")).alias("result"), F.lit("").alias("annotations"),
    )
    return e.select(F.expr(_RUN_SPARK).alias("run_dir"), F.col("event_id").alias("idx"), state.alias("state"))


_INSTANCE = (
    f"i AS (SELECT {_RUN} AS run_dir, 'id' || CAST(event_id AS VARCHAR) AS instance_id, event_id, user_id, event_type, CASE WHEN event_id % 3 = 0 THEN 1.0 ELSE 0.0 END AS exact_match, "
    "CAST(event_id % 7 AS DOUBLE) AS num_completion_tokens, CAST(0 AS DOUBLE) AS inference_runtime, CASE WHEN user_id % 3 = 2 THEN event_id % 10 / 10 END AS alrage_score FROM events)"
)


@query(f"WITH {_INSTANCE} SELECT run_dir, instance_id, CAST(exact_match AS DOUBLE) AS exact_match, num_completion_tokens, inference_runtime, CAST(alrage_score AS DOUBLE) AS alrage_score FROM i")
def eval_instance_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query(
    f"WITH {_INSTANCE} SELECT run_dir, CAST(event_id AS INTEGER) AS sample_index, event_type AS category, CASE WHEN user_id % 3 = 2 THEN 'generation' ELSE 'MCQ_2' END AS format, event_type AS instruction, "
    "CASE WHEN event_id % 5 > 0 THEN event_type END AS reference, CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 2 = 1 THEN 'C' WHEN user_id % 3 = 2 THEN 'A' ELSE event_type END AS prediction, "
    "'p' AS raw_prompt, CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 2 = 0 THEN 'A' ELSE 'C' END AS raw_response, CAST(exact_match AS DOUBLE) AS judge_score, "
    "CASE WHEN event_id % 4 > 0 AND event_id % 100 > 0 THEN round(event_id % 100 / 8 * 1000, 2) END AS latency_ms, CAST(event_id % 7 AS INTEGER) AS answer_tokens FROM i"
)
def eval_samples(spark, sf_dir):
    return evalstore.samples(_states(spark, sf_dir), _metrics(spark, sf_dir)).drop("meta")


_SUBSETS = (
    f"{_INSTANCE}, s AS (SELECT split_part(run_dir, ':', 1) AS task, event_type AS subset, count(*) AS samples, CASE WHEN count(alrage_score) > 0 THEN sum(alrage_score) / count(*) "
    "ELSE count(*) FILTER (WHERE exact_match = 1.0) / count(*) END AS score FROM i GROUP BY 1, 2)"
)


def _subsets(spark, sf_dir):
    totals = _states(spark, sf_dir).groupBy("run_dir").agg(F.count(F.lit(1)).alias("total_samples"))
    return evalstore.subset_report(_metrics(spark, sf_dir), _metrics(spark, sf_dir), totals)


@query(f"WITH {_SUBSETS} SELECT task, subset, samples, round(score, 6) AS score FROM s")
def eval_subset_metrics(spark, sf_dir):
    return _subsets(spark, sf_dir).withColumn("score", F.round("score", 6))


@query(f"WITH {_SUBSETS} SELECT task, CAST(sum(samples) AS BIGINT) AS samples, round(sum(score * samples) / sum(samples), 6) AS score, string_agg(subset, ',' ORDER BY subset) AS subsets FROM s GROUP BY 1")
def eval_task_metrics(spark, sf_dir):
    out = evalstore.task_report(_subsets(spark, sf_dir))
    return out.select("task", "samples", F.round("score", 6).alias("score"), F.array_join(F.array_sort(F.map_keys("per_subset")), ",").alias("subsets"))


@query(
    "SELECT o_orderpriority AS run_dir, CASE WHEN avg(o_totalprice) IS NULL THEN NULL ELSE round(max(o_totalprice), 2) END AS exact_match FROM orders WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_orderpriority) GROUP BY 1"
)
def eval_run_metrics(spark, sf_dir):
    """The last statistic of a name counts: orders as entries of a run per priority."""
    orders = I.table(spark, sf_dir, "orders")
    entry = F.struct(F.struct(F.lit("exact_match").alias("name")).alias("name"), F.lit(None).cast("double").alias("mean"), F.col("o_totalprice").alias("sum"))
    # the entries before the last are folded away before they are gathered
    last = orders.groupBy("o_orderpriority").agg(F.max_by(entry, "o_orderkey").alias("e"), F.min_by(entry, "o_orderkey").alias("f"))
    metrics = evalstore.run_metrics(last.select(F.col("o_orderpriority").alias("run_dir"), F.array("f", "e").alias("stats")))
    return metrics.select("run_dir", F.round(F.col("metrics")["exact_match"], 2).alias("exact_match"))


@query(
    f"WITH d AS (SELECT DISTINCT {_RUN} AS run_dir, user_id % 3 AS k FROM events), n AS (SELECT run_dir, split_part(run_dir, ',', 1) AS run_name FROM d), stored AS (SELECT run_name FROM n WHERE run_name LIKE 'bench0%') "
    "SELECT run_dir, run_name FROM n WHERE run_name NOT IN (SELECT run_name FROM stored)"
)
def eval_import_new(spark, sf_dir):
    runs = I.table(spark, sf_dir, "events").select(F.expr(_RUN_SPARK).alias("run_dir")).distinct().withColumn("run_name", F.split("run_dir", ",")[0])
    return evalstore.new_runs(runs, runs.where(F.col("run_name").startswith("bench0")).select("run_name"))


# --- rollups and charts -------------------------------------------------------------------------------------------------------------


@query("SELECT event_type AS task, count(DISTINCT user_id) AS runs, count(*) AS samples, round(avg(value), 6) AS avg_score FROM events GROUP BY 1")
def rollup_by_task(spark, sf_dir):
    return rollups.by_task(I.table(spark, sf_dir, "events"), "event_type", "user_id", F.col("value")).withColumn("avg_score", F.round("avg_score", 6))


@query("SELECT role AS key, count(*) AS rows, round(count(*) / (SELECT count(*) FROM conversations), 6) AS share FROM conversations GROUP BY 1")
def format_distribution(spark, sf_dir):
    return rollups.distribution(I.table(spark, sf_dir, "conversations"), F.col("role")).withColumn("share", F.round("share", 6))


_STATUS = ("F", "O", "P")


@query(f"SELECT o_orderpriority AS dataset, {', '.join(f'count(*) FILTER (WHERE o_orderstatus = {s!r}) AS {chr(34)}{s}{chr(34)}' for s in _STATUS)} FROM orders GROUP BY 1")
def status_pivot(spark, sf_dir):
    return rollups.status_pivot(I.table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", list(_STATUS))


_LEVEL = "CASE p_size % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END"


@query(
    f"SELECT p_brand AS model, {_LEVEL} AS difficulty, count(*) FILTER (WHERE p_retailprice >= 1200) AS questions_above_threshold, count(*) AS total_questions, CAST(min(p_size % 3) + 1 AS INTEGER) AS difficulty_sort_key FROM part GROUP BY 1, 2"
)
def leaderboard(spark, sf_dir):
    part = I.table(spark, sf_dir, "part").withColumn("model", F.col("p_brand")).withColumn("difficulty", F.expr(_LEVEL))
    return rollups.leaderboard(part, ["model", "difficulty"], F.col("p_retailprice"), 1200, "difficulty")


@query("SELECT lang AS label, count(*) AS value, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 6) AS percent FROM documents GROUP BY 1")
def chart_language_share(spark, sf_dir):
    counts = I.table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return rollups.share_table(counts, "lang", "n").withColumn("percent", F.round(F.col("percent").cast("double"), 6))


@query(
    f"WITH {I.CHATS_SQL}, n AS (SELECT count(*) AS n FROM chats) SELECT 'has_alef_variants' AS label, count(*) FILTER (WHERE regexp_matches(\"user\", '[آأإٱ]')) AS value, round(count(*) FILTER (WHERE regexp_matches(\"user\", '[آأإٱ]')) * 100.0 / (SELECT n FROM n), 6) AS percent FROM chats "
    "UNION ALL SELECT 'has_ta_marbuta', count(*) FILTER (WHERE contains(\"user\", 'ة')), round(count(*) FILTER (WHERE contains(\"user\", 'ة')) * 100.0 / (SELECT n FROM n), 6) FROM chats"
)
def chart_orthography(spark, sf_dir):
    counters = profile.counters(I.chats(spark, sf_dir), "user", "assistant")
    return rollups.flag_shares(counters, ["has_alef_variants", "has_ta_marbuta"]).withColumn("percent", F.round(F.col("percent").cast("double"), 6))
