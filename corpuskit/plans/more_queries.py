"""Templates, payloads, names, specifications and schedules as queries, with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from corpuskit import schema
from corpuskit.functions import text as T
from corpuskit.functions.numbers import round_exact
from corpuskit.functions.patterns import OPTION_LETTERS
from corpuskit.operators import specs, synth
from corpuskit.plans import inputs as I
from corpuskit.plans import text_queries as texts
from corpuskit.plans import workflow
from corpuskit.staging import hadoop_path, shared_path
from corpuskit.streaming import profile as streams

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_TEMPLATE = "Write about {topic} ({difficulty}): {focus}. {topic}"


@query(f"SELECT doc_id, replace(replace(replace('{_TEMPLATE}', '{{topic}}', source), '{{difficulty}}', lang), '{{focus}}', lang || '، ' || source) AS prompt FROM documents")
def template_prompts(spark, sf_dir):
    return I.table(spark, sf_dir, "documents").select("doc_id", T.fill_template(F.lit(_TEMPLATE), "source", "lang", F.array("lang", "source")).alias("prompt"))


@query("SELECT item_id, text || chr(10) || 'A) ' || substr(text, 1, 7) || chr(10) || CASE WHEN item_id % 2 = 0 THEN 'B) ' || substr(text, 8, 5) || chr(10) ELSE '' END || 'C) none' AS question FROM benchmark")
def benchmark_questions(spark, sf_dir):
    """An option that is empty is passed over and keeps its letter."""
    second = F.when(F.col("item_id") % 2 == 0, F.substring("text", 8, 5)).otherwise("")
    return I.table(spark, sf_dir, "benchmark").select("item_id", T.options_text("text", F.array(F.substring("text", 1, 7), second, F.lit("none"))).alias("question"))


_ANSWER = "'Sure:' || chr(10) || '```json' || chr(10) || CASE event_id % 3 WHEN 0 THEN 'none' WHEN 1 THEN props ELSE '{\"a\": ' || props || chr(10) || '}' END || chr(10) || '```'"


@query(f"SELECT event_id, nullif(regexp_extract(regexp_replace({_ANSWER}, '(?m)^ *```[A-Za-z]* *$', '', 'g'), '(?s)\\{{.*\\}}'), '') AS body, CASE event_id % 3 WHEN 1 THEN CAST(props::JSON->>'$.k' AS BIGINT) WHEN 2 THEN CAST(props::JSON->>'$.k' AS BIGINT) END AS k FROM events")
def answer_objects(spark, sf_dir):
    """The outermost JSON object of an answer, and a value by its path."""
    body = T.json_object(F.expr(_ANSWER))
    rows = I.table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return rows.select("event_id", "body", F.coalesce(F.get_json_object("body", "$.k"), F.get_json_object("body", "$.a.k")).cast("bigint").alias("k"))


_CLASS = "CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN 'bench.suite.' || l_returnflag || 'QuizScenario' ELSE l_linestatus || 'Scenario' END"
_RUN = "l_returnflag || ':subset=' || l_linestatus || ',model=m'"
_MODEL = "l_shipmode || CASE WHEN l_linenumber = 2 THEN '-Thinking' ELSE '' END".replace("l_shipmode", "l_returnflag")
_EFFORT = "CASE l_linenumber WHEN 1 THEN 'off' WHEN 3 THEN 'low' WHEN 4 THEN '' END"


@query(
    f"SELECT l_orderkey, l_linenumber, coalesce(nullif(lower(replace(split_part({_CLASS}, '.', -1), 'Scenario', '')), ''), split_part({_RUN}, ':', 1)) AS task, "
    f"contains(lower({_MODEL}), 'thinking') OR coalesce({_EFFORT}, '') NOT IN ('', 'off') AS thinking, '{{\"model\":\"' || {_MODEL} || '\",\"suite\":\"s\"}}' AS config FROM lineitem"
)
def run_names(spark, sf_dir):
    """Task names of scenario classes, models that think, the configuration as JSON."""
    rows = I.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_CLASS).alias("c"), F.expr(_RUN).alias("r"), F.expr(_MODEL).alias("model"), F.expr(_EFFORT).alias("effort"))
    config = F.to_json(F.struct("model", F.lit("s").alias("suite")))
    return rows.select("l_orderkey", "l_linenumber", T.task_of("c", "r").alias("task"), T.is_thinking_model("model", "effort").alias("thinking"), config.alias("config"))


_OPTIONS = {OPTION_LETTERS[0]: "lang", OPTION_LETTERS[1]: "source", OPTION_LETTERS[2]: "CASE WHEN doc_id % 4 = 0 THEN ' ' ELSE 'x' END", OPTION_LETTERS[3]: "'y'"}


@query(
    f"SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN '' ELSE 'q' END <> '' AND trim(lang) <> '' AND trim(source) <> '' AND doc_id % 4 <> 0 AND doc_id % 5 <> 0 AS mcq, "
    "doc_id % 2 = 0 AND doc_id % 3 <> 0 AND length(text) > 0 AS dialogue FROM documents"
)
def valid_payloads(spark, sf_dir):
    """Whether payloads with holes of several kinds are valid questions and dialogues."""
    docs = I.table(spark, sf_dir, "documents")
    options = F.create_map(*[x for k, v in _OPTIONS.items() for x in (F.lit(k), F.expr(v))])
    question = F.when(F.col("doc_id") % 6 == 0, "").otherwise("q")
    answer = F.when(F.col("doc_id") % 5 == 0, "z").otherwise(OPTION_LETTERS[1])
    message = lambda role, content: F.struct(role.alias("role"), content.alias("content"))
    both = F.array(message(F.lit("user"), F.col("text")), message(F.when(F.col("doc_id") % 3 == 0, "judge").otherwise("assistant"), F.lit("a")))
    messages = F.when(F.col("doc_id") % 2 == 0, both).otherwise(F.slice(both, 1, 1))
    return docs.select("doc_id", synth.valid_mcq(question, options, answer).alias("mcq"), synth.valid_dialogue(messages).alias("dialogue"))


_SCHEDULE = (
    "WITH t AS (SELECT DISTINCT source AS topic FROM documents WHERE source IS NOT NULL), n AS (SELECT count(*) AS c FROM t), "
    "e AS (SELECT topic, c, unnest(range(0, CAST(ceil(100.0 / c) AS BIGINT))) AS cycle FROM t, n), "
    "r AS (SELECT topic, cycle * c + row_number() OVER (PARTITION BY cycle ORDER BY md5('42:' || cycle || ':' || topic), topic) - 1 AS task FROM e) "
)
_TYPE = "CASE WHEN task < 85 THEN 'mcq' ELSE 'dialogue' END"


@query(f"{_SCHEDULE}SELECT CAST(task AS BIGINT) AS task, topic, {_TYPE} AS type FROM r WHERE task < 100")
def topic_schedule(spark, sf_dir):
    topics = I.table(spark, sf_dir, "documents").where("source IS NOT NULL").select(F.col("source").alias("topic")).distinct()
    return synth.schedule(topics, 100).select(F.col("task").cast("bigint").alias("task"), "topic", "type")


def _answer(prompt: str) -> str:
    """Stands in for a model: examples in a fence, none for topics with a one in their name."""
    if "1" in prompt:
        return "none"
    message = [{"role": "user", "content": prompt}, {"role": "assistant", "content": "a"}]
    question = {"question": prompt, "options": {x: "o" for x in OPTION_LETTERS}, "answer": OPTION_LETTERS[0]}
    made = question if prompt.startswith("Q") else {"messages": message}
    return "Sure:\n```json\n" + json.dumps(made, ensure_ascii=False) + "\n```"


@query(f"{_SCHEDULE}SELECT CAST(task AS BIGINT) AS task, topic, {_TYPE} AS type, CASE WHEN task < 85 THEN 'Q ' ELSE 'D ' END || topic || ' (easy): x' AS raw_prompt, 2 AS n FROM r WHERE task < 100 AND NOT contains(topic, '1')")
def generated_records(spark, sf_dir):
    """Valid examples of a provider; tasks without one are asked again until the budget is spent."""
    topics = I.table(spark, sf_dir, "documents").where("source IS NOT NULL").select(F.col("source").alias("topic")).distinct()
    topics = topics.select("topic", F.lit("easy").alias("difficulty"), F.array(F.lit("x")).alias("focus"))
    rest = " {topic} ({difficulty}): {focus}"
    made = synth.generate(topics, 100, {"mcq": "Q" + rest, "dialogue": "D" + rest}, "system", _answer, budget=2)
    return made.select(F.col("task").cast("bigint").alias("task"), "topic", "type", "raw_prompt", F.size("messages").alias("n"))


@query(f"SELECT doc_id AS row_id, {I.ws('text')} AS prompt, 'docs' AS source FROM documents WHERE {I.ws('text')} <> '' AND length({I.ws('text')}) % 2 = 0")
def language_filtered(spark, sf_dir):
    """Envelopes to chat rows with a language filter that the caller brings; an even length stands in for its verdict."""
    envelope = F.struct(F.lit("docs").alias("source"), F.struct(F.col("text").alias("prompt"), F.lit("a").alias("response")).alias("row"))
    raw = I.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.from_json(F.to_json(envelope), schema.ENVELOPE).alias("e")).select("row_id", "e.*")
    kept = workflow.normalized(raw, language_filter=lambda user: F.length(user) % 2 == 0)
    return kept.select("row_id", F.col("messages")[0]["content"].alias("prompt"), "meta.source")


@query("SELECT item_id, sha1(text) AS digest FROM benchmark")
def text_digests(spark, sf_dir):
    return I.table(spark, sf_dir, "benchmark").select("item_id", T.gram_digest("text").alias("digest"))


@query(
    "WITH parts AS (SELECT n_regionkey AS r, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS place, lower(n_name) AS part FROM nation), "
    "e AS (SELECT lower(r_name) AS benchmark, r_regionkey AS r, unnest(['all', 'one', NULL]) AS value FROM region) "
    "SELECT benchmark, CASE WHEN value IS NULL THEN NULL ELSE 'subset=' || coalesce(part, value) END AS arguments, 'm' AS model, CAST(coalesce(place, 0) AS INTEGER) AS place, "
    "CASE WHEN e.r = 0 THEN 'renamed' ELSE benchmark END || ':' || CASE WHEN value IS NULL THEN '' ELSE 'subset=' || coalesce(part, value) || ',' END || 'model=m' AS spec "
    "FROM e LEFT JOIN parts ON e.r = parts.r AND value = 'all' AND e.r < 4"
)
def run_specs(spark, sf_dir):
    """Nations as the subsets of regions; the last region lists none, the first has a name of its own at the evaluator."""
    region, nation = I.table(spark, sf_dir, "region"), I.table(spark, sf_dir, "nation")
    name = F.lower("r_name").alias("benchmark")
    place = F.expr("CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INT)").alias("place")
    parts = nation.where("n_regionkey < 4").select("n_regionkey", place, F.lower("n_name").alias("part")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    parts = parts.select(name, F.lit("subset").alias("argument"), "place", "part", F.when(F.col("r_regionkey") == 0, "renamed").alias("run_name"))
    entries = region.select(name, F.explode(F.array(F.lit("all"), F.lit("one"), F.lit(None))).alias("value"), F.lit("m").alias("model"))
    entries = entries.withColumn("argument", F.when(F.col("value").isNotNull(), "subset"))
    return specs.expanded(entries, parts)


@query()
def rounded_prices(spark, sf_dir):
    """Rounded by the exact binary value; SQL rounds by decimal form or not exactly (tested against Python)."""
    return I.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", round_exact(F.col("l_extendedprice") * F.col("l_discount"), 1).alias("price"))


def _document_stream(spark, sf_dir):
    path = f"{sf_dir}/documents.parquet"
    fs, place = hadoop_path(spark, path)
    source = spark.readStream.schema(spark.read.parquet(path).schema)
    return source.parquet(path) if fs.getFileStatus(place).isDirectory() else source.option("pathGlobFilter", "documents.parquet").parquet(sf_dir)


@query(
    "SELECT CAST(doc_id // 300 * 300 AS BIGINT) AS window_start, " + I.language("t") + " AS language, count(*) AS rows, avg(length(t)) AS mean_chars, max(length(t)) AS max_chars, "
    f"count(*) FILTER (WHERE {I.mcq('t')}) AS mcq FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) GROUP BY ALL"
)
def stream_profile(spark, sf_dir):
    """The running profile over all documents as a stream that ends: each one arrives at the second of its id."""
    source = _document_stream(spark, sf_dir)
    out = shared_path(spark, "stream-profile")
    counted = streams.running_profile(source.withColumn("ts", F.timestamp_seconds("doc_id")), "text")
    flow = counted.writeStream.outputMode("complete").option("checkpointLocation", shared_path(spark, "stream-state"))
    flow.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select(F.unix_timestamp("w.start").alias("window_start"), "language", "rows", "mean_chars", "max_chars", "mcq")


@query(f"WITH {I.DOCS_SQL}, {texts._hashes('docs')} SELECT count(DISTINCT l3) AS rows, count(DISTINCT l3) AS digests FROM h")
def stream_first_copies(spark, sf_dir):
    """Exact dedup of all documents as a stream that ends; all arrive within the watermark."""
    stream = _document_stream(spark, sf_dir).select("text", F.lit("").alias("a"), F.timestamp_seconds(F.lit(86_400)).alias("ts"))
    out = shared_path(spark, "first-copies")
    flow = streams.first_copies(stream, "text", "a").select("l3").writeStream.outputMode("append").option("checkpointLocation", shared_path(spark, "stream-state"))
    flow.format("parquet").option("path", out).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("l3 string").parquet(out).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("l3").alias("digests"))
