"""Sources and sinks as queries: whole tables are written to the shared folder and read back, with the SQL of what must come out."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.operators import evalstore, sampling, vectors
from corpuskit.plans import inputs as I
from corpuskit.sources import benchmarks, evalruns, jsonl, sinks
from corpuskit.staging import shared_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SCHEMA = "doc_id bigint, text string, lang string, source string"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def _clean_lines(docs):
    return docs.select(F.col("doc_id").alias("row_id"), F.to_json(F.struct("doc_id", "text", "lang", "source")).alias("value"))


def _written(spark, sf_dir, broken: bool = True) -> str:
    """The documents as JSON lines; among them blank lines and, if asked for, broken ones."""
    path = shared_path(spark, "lines")
    rows = _clean_lines(I.table(spark, sf_dir, "documents"))
    extra = [F.when(F.col("row_id") % 7 == 0, "  ")] + ([F.when(F.col("row_id") % 11 == 0, '{"doc_id": ')] if broken else [])
    each = F.filter(F.array("value", *extra), lambda x: x.isNotNull())
    sinks.write_lines(rows.select("row_id", F.explode(each).alias("value")), path)
    return path


@query("SELECT false AS parse_failed, count(*) AS n FROM documents UNION ALL SELECT true, count(*) FROM documents WHERE doc_id % 11 = 0 HAVING count(*) > 0")
def jsonl_counted(spark, sf_dir):
    return jsonl.read_jsonl(spark, _written(spark, sf_dir), SCHEMA, mode="count").groupBy("parse_failed").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, text, lang, source FROM documents")
def jsonl_skipped(spark, sf_dir):
    return jsonl.read_jsonl(spark, _written(spark, sf_dir), SCHEMA).drop("row_id")


@query("SELECT doc_id, length(text) AS n_chars FROM documents")
def jsonl_strict(spark, sf_dir):
    return jsonl.read_jsonl(spark, _written(spark, sf_dir, broken=False), SCHEMA, mode="fail").select("doc_id", F.length("text").cast("bigint").alias("n_chars"))


@query("SELECT count(*) + count(*) FILTER (doc_id % 11 = 0) AS n FROM documents")
def jsonl_line_count(spark, sf_dir):
    return spark.createDataFrame([(jsonl.count_rows(spark, _written(spark, sf_dir)),)], "n bigint")


@query("SELECT count(*) + 10 AS n, count(*) + 10 AS ids, count(*) + 9 AS last FROM documents")
def jsonl_files_capped(spark, sf_dir):
    """One file twice with a missing one between, up to ten lines into the second."""
    docs, path = I.table(spark, sf_dir, "documents"), shared_path(spark, "lines")
    sinks.write_lines(_clean_lines(docs), path)
    rows = jsonl.read_jsonl(spark, [path, f"{path}-missing", path], SCHEMA, max_rows=docs.count() + 10)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("ids"), F.max("row_id").alias("last"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source_config, CASE WHEN doc_id % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM documents")
def jsonl_splits(spark, sf_dir):
    docs, path = _clean_lines(I.table(spark, sf_dir, "documents")), shared_path(spark, "splits")
    files = {("even", "train"): f"{path}/even", ("odd", "test"): f"{path}/odd", ("odd", "train"): f"{path}/none"}
    sinks.write_lines(docs.where("row_id % 2 = 0"), f"{path}/even")
    sinks.write_lines(docs.where("row_id % 2 <> 0"), f"{path}/odd")
    return jsonl.read_splits(spark, files, SCHEMA).select("doc_id", "source_config", "split")


_PATTERN = "(?i)license|src1"
_MATCH = " OR ".join(f"coalesce(regexp_matches({c}, '{_PATTERN}'), false)" for c in ("text", "lang", "source"))


@query(
    f"SELECT 'all' AS kind, doc_id FROM documents WHERE {_MATCH} UNION ALL SELECT 'capped', doc_id FROM documents WHERE doc_id < 500 AND ({_MATCH}) "
    "UNION ALL SELECT 'fallback', doc_id FROM documents WHERE doc_id < 500"
)
def scan_matching(spark, sf_dir):
    """Rows of which any text matches: of all rows, of those a cap lets through, and with the fallback where none does."""
    rows = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text", "lang", "source")
    found = {
        "all": jsonl.matching(rows, _PATTERN), "capped": jsonl.matching(rows, _PATTERN, 500),
        "fallback": jsonl.matching(rows, "no such text", 500, fallback=True), "none": jsonl.matching(rows, "no such text"),
    }
    parts = [df.select(F.lit(k).alias("kind"), F.col("row_id").alias("doc_id")) for k, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "WITH q AS (SELECT 'arabic_mmlu' AS benchmark, 'c' AS config_name, item_id AS \"index\", text || chr(10) || 'A) ' || substr(text, 1, 7) || chr(10) || 'C) x' AS raw FROM benchmark "
    "UNION ALL SELECT 'alrage', 'd', item_id, CASE WHEN length(text) > 20 THEN text END FROM benchmark) "
    f"SELECT benchmark, {I.ws('raw')} AS text, substr(raw, 1, 500) AS raw_question, config_name, \"index\" FROM q WHERE length({I.ws('raw')}) >= 10"
)
def benchmark_loaders(spark, sf_dir):
    """Two registered loaders; a split that is not in the layout and a name without loader are passed over."""
    items = I.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("row_id"), "text")
    options = [F.substring("text", 1, 7).alias("Option 1"), F.lit("").alias("Option 2"), F.lit("x").alias("Option 3"), F.lit(None).cast("string").alias("Option 4")]
    loaders = benchmarks.Loaders()
    loaders.register("arabic_mmlu", lambda s, config, split: items.select("row_id", F.col("text").alias("Question"), *options))
    loaders.register("alrage", lambda s, config, split: items.withColumnRenamed("text", "body"))
    wanted = [("arabic_mmlu", "c", "test"), ("arabic_mmlu", "c", "train"), ("alrage", "d", "train"), ("unknown", "e", "test")]
    return benchmarks.questions(loaders.load(spark, wanted))


@query(
    "SELECT 'docs' AS benchmark, text, count(*) AS n FROM (SELECT text FROM documents UNION ALL SELECT lang FROM documents UNION ALL SELECT source FROM documents "
    "UNION ALL SELECT source || '!' FROM documents) WHERE text <> '' GROUP BY ALL"
)
def json_texts(spark, sf_dir):
    """All texts of nested records, down to the second level."""
    path = shared_path(spark, "records") + ".jsonl"
    inner = F.struct(F.col("source").alias("x"), F.array(F.concat("source", F.lit("!"))).alias("y"), F.lit(5).alias("z"))
    records = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("t"), F.array("lang", F.lit("")).alias("l"), inner.alias("d"))
    sinks.write_jsonl(records, path, order="doc_id")
    return jsonl.read_texts(spark, [path, f"{path}-missing"], "docs").groupBy("benchmark", "text").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT r_regionkey, r_name, (SELECT count(*) FROM nation) AS nations FROM region")
def report_file(spark, sf_dir):
    """A nested report, written and read as one document; a missing one has no rows."""
    path, schema = shared_path(spark, "report"), "regions array<struct<r_regionkey:bigint,r_name:string>>, totals struct<nations:bigint>"
    totals = I.table(spark, sf_dir, "nation").agg(F.count(F.lit(1)).alias("nations"))
    sinks.write_report(spark, path, sinks.nested({"regions": I.table(spark, sf_dir, "region").select("r_regionkey", "r_name"), "totals": totals}))
    read = jsonl.read_json(spark, path, schema).unionByName(jsonl.read_json(spark, f"{path}-missing", schema))
    return read.select(F.explode("regions").alias("r"), "totals.nations").select("r.r_regionkey", "r.r_name", "nations")


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS inversions, CAST(0 AS BIGINT) AS overlaps, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents")
def jsonl_ordered(spark, sf_dir):
    """The JSON lines of a sink keep the order of rows: inside each file, and from file to file."""
    path = shared_path(spark, "ordered")
    sinks.write_jsonl(I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text"), path)
    rows = spark.read.schema("row_id bigint, text string").json(path)
    rows = rows.select("row_id", F.length("text").alias("n"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    before = F.lag("row_id").over(Window.partitionBy("file").orderBy("block", "at"))
    files = rows.withColumn("inverted", before > F.col("row_id")).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("inverted").alias("inverted"), F.min("row_id").alias("low"), F.max("row_id").alias("high"), F.sum("n").alias("chars")
    )
    # a row per file
    files = files.withColumn("overlap", F.lag("high").over(Window.orderBy("file")) > F.col("low"))
    return files.agg(F.sum("rows").alias("n"), F.sum("inverted").alias("inversions"), F.count_if("overlap").alias("overlaps"), F.sum("chars").alias("n_chars"))


@query("SELECT lang AS slice, least(25, count(*)) AS in_files, least(25, count(*)) AS in_index FROM documents GROUP BY lang")
def slice_files(spark, sf_dir):
    path = shared_path(spark, "slices")
    docs = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text", "lang")
    sinks.write_slices(sampling.per_stratum(docs, F.col("lang"), 25), path)
    files = spark.read.json(f"{path}/slices").groupBy("slice").agg(F.count(F.lit(1)).alias("in_files"))
    return files.join(spark.read.json(f"{path}/index").select("slice", F.col("count").alias("in_index")), "slice", "full")


@query(
    "WITH b AS (SELECT doc_id, CASE WHEN doc_id % 10 < 3 THEN 'band_0.90-0.93' WHEN doc_id % 10 < 6 THEN 'band_0.93-0.96' WHEN doc_id % 10 < 9 THEN 'band_0.96-0.99' ELSE 'band_from0.99' END AS file FROM documents), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY doc_id) AS n FROM b) SELECT file, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM r WHERE n <= 50 GROUP BY file"
)
def band_files(spark, sf_dir):
    path = shared_path(spark, "bands")
    score = (F.lit(905) + 10 * (F.col("doc_id") % 10)) / F.lit(1000.0)
    edges = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("src"), (F.col("doc_id") + 1).alias("dst"), score.alias("score"), F.lit(1).alias("rank"))
    sinks.write_bands(vectors.bands(edges), path)
    return spark.read.json(path).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum("src").alias("ids"))


@query(
    "SELECT CAST(s_suppkey AS VARCHAR) AS run_dir, CASE WHEN s_suppkey % 3 = 0 THEN 'completed' ELSE 'started' END AS status, CASE WHEN s_suppkey % 3 = 0 THEN 0.0::DOUBLE ELSE s_acctbal END AS total, coalesce(n, 0) AS samples "
    "FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey WHERE s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0"
)
def run_store(spark, sf_dir):
    """Suppliers as runs, their lines as samples: two appends, orphans dropped, runs deleted, runs updated."""
    path, key = shared_path(spark, "store"), F.col("run_dir").cast("bigint")
    runs_path, samples_path = f"{path}/runs", f"{path}/samples"
    runs = I.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("run_dir"), F.lit("started").alias("status"), F.col("s_acctbal").alias("total"))
    samples = I.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("run_dir"), "l_orderkey", "l_linenumber")
    for part in (0, 1):
        sinks.append_run(runs.where((key % 2 == part) & (key % 5 != 0)), samples.where(key % 2 == part), runs_path, samples_path)
    sinks.drop_orphans(spark, runs_path, samples_path)
    sinks.drop_runs(spark, runs.where(key % 7 == 0), runs_path, samples_path)
    sinks.update_runs(spark, runs.where(key % 3 == 0).select("run_dir", F.lit("completed").alias("status"), F.lit(0.0).alias("total")), runs_path)
    counted = spark.read.parquet(samples_path).groupBy("run_dir").agg(F.count(F.lit(1)).alias("samples"))
    return spark.read.parquet(runs_path).join(counted, "run_dir", "full").na.fill(0, ["samples"])


@query(
    "SELECT (SELECT max(s_suppkey) FROM supplier WHERE s_suppkey % 2 = 0) + row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS id, CAST(s_suppkey AS VARCHAR) AS run_dir FROM supplier WHERE s_suppkey % 2 = 1"
)
def run_ids(spark, sf_dir):
    """New runs are numbered behind the stored ones."""
    rows = I.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").cast("string").alias("run_dir"))
    return evalstore.with_ids(rows.where("id % 2 = 1").select("run_dir"), rows.where("id % 2 = 0"))


@query("SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS run_name FROM supplier")
def stored_run_names(spark, sf_dir):
    """Names out of the stored configuration documents; a table that is not there yet has none."""
    path = shared_path(spark, "runs")
    config = F.to_json(F.struct(F.lit("s").alias("suite"), F.col("s_name").alias(evalstore.RUN_NAME_KEY)))
    I.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("id"), config.alias("config")).write.parquet(path)
    return evalruns.stored_runs(spark, path).unionByName(evalruns.stored_runs(spark, f"{path}-missing"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'new' ELSE n_name END AS n_name FROM nation UNION ALL SELECT 1000, 'added'")
def keyed_upsert(spark, sf_dir):
    stored = I.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")
    new = stored.where("n_nationkey % 3 = 0").select("n_nationkey", F.lit("new").alias("n_name")).unionByName(spark.createDataFrame([(1000, "added")], "n_nationkey int, n_name string"))
    return sinks.upsert(stored, new, "n_nationkey")


def _run_folders(spark, sf_dir, root: str) -> None:
    """A folder of results per region with its nations as requests, and one that is not complete."""
    nations: dict = {}
    for n in I.table(spark, sf_dir, "nation").collect():  # 25 rows at any size
        nations.setdefault(n.n_regionkey, []).append(n)
    for r in I.table(spark, sf_dir, "region").collect():
        states, metrics = [], []
        for n in sorted(nations.get(r.r_regionkey, []), key=lambda n: n.n_nationkey):
            key = f"id{n.n_nationkey}"
            references = [{"output": {"text": "A"}, "tags": ["correct"]}, {"output": {"text": "B"}, "tags": []}]
            done = {"completions": [{"text": "A", "finish_reason": {"reason": "stop"}}], "request_time": 0.5}
            states.append({"instance": {"id": key, "input": {"text": n.n_name}, "references": references}, "output_mapping": {"A": n.n_name}, "request": {"prompt": f"p {n.n_name}"}, "result": done})
            metrics.append({"instance_id": key, "stats": [{"name": {"name": "exact_match"}, "mean": n.n_nationkey % 2}]})
        spec = {"name": f"{r.r_name}:model=m", "adapter_spec": {"model": "m"}, "scenario_spec": {"class_name": "a.b.QuizScenario"}}
        whole = {"run_spec": spec, "scenario_state": {"request_states": states}, "per_instance_stats": metrics, "stats": [{"name": {"name": "exact_match"}, "mean": 1.0}]}
        for name, document in whole.items():
            sinks.write_report(spark, f"{root}/{r.r_name}/{name}.json", document)
    sinks.write_report(spark, f"{root}/BROKEN/run_spec.json", {"name": "broken"})


@query(
    "SELECT r_name AS run_dir, CAST(n_nationkey AS BIGINT) AS sample_index, n_name AS instruction, 'A' AS reference, n_name AS prediction, 'p ' || n_name AS raw_prompt, CAST(n_nationkey % 2 AS DOUBLE) AS judge_score, 500.0::DOUBLE AS latency_ms, "
    "'{\"output_mapping\":{\"A\":\"' || n_name || '\"},\"all_references\":[{\"text\":\"A\",\"correct\":true},{\"text\":\"B\",\"correct\":false}],\"finish_reason\":\"stop\",\"instance_id\":\"id' || n_nationkey || '\"}' AS meta "
    "FROM nation JOIN region ON n_regionkey = r_regionkey"
)
def run_folder_samples(spark, sf_dir):
    """Result folders on disk to sample rows; the folder that lacks files is passed over."""
    root = shared_path(spark, "run-folders")
    _run_folders(spark, sf_dir, root)
    dirs = evalruns.discover(spark, root)
    rows = evalstore.samples(evalruns.states(spark, dirs), evalstore.instance_metrics(evalruns.instance_stats(spark, dirs)))
    return rows.select("run_dir", F.col("sample_index").cast("bigint").alias("sample_index"), "instruction", "reference", "prediction", "raw_prompt", "judge_score", "latency_ms", "meta")


@query("SELECT item_id, CAST(length(text) + CASE WHEN item_id % 2 = 0 THEN 0 ELSE 100000 END AS DOUBLE) AS size, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS spaces FROM benchmark")
def embeddings_resumed(spark, sf_dir):
    """Half of the rows are stored by one provider; a second run, by another, makes the missing ones alone."""

    def provider(more):
        return lambda texts: [[len(t) + more, t.count(" ")] for t in texts]

    path, items = shared_path(spark, "vectors"), I.table(spark, sf_dir, "benchmark").select("item_id", "text")
    sinks.resume_embeddings(items.where("item_id % 2 = 0"), provider(0), path, key="item_id")
    made = sinks.resume_embeddings(items, provider(100_000), path, key="item_id")
    return made.select("item_id", F.col("embedding")[0].cast("double").alias("size"), F.col("embedding")[1].cast("double").alias("spaces"))


@query(f"SELECT doc_id, substr({I.ws('text')}, 1, 5000) AS text FROM documents")
def embedding_texts(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", T.for_embedding("text").alias("text"))


@query(f"SELECT doc_id, {I.ws(chr(39) + 'fi1 AB ' + chr(39) + ' || text')} AS text FROM documents WHERE text IS NOT NULL")
def unicode_cleaned(spark, sf_dir):
    """Ligatures, circled and wide forms are folded, invisible marks go; the documents themselves are in normal form."""
    docs = I.table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", T.unicode_clean(F.concat(F.lit("ﬁ①​\tＡＢ­ "), "text")).alias("text"))
