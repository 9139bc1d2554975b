"""Profile, dedup, sampling, formatting and leakage queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import chat
from corpuskit.functions import patterns as P
from corpuskit.functions import text as T
from corpuskit.operators import clean, curriculum, exact, leakage, ngrams, profile, sampling
from corpuskit.plans import inputs as I
from corpuskit.staging import staged

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def q(x: str) -> str:
    return '"' + x + '"'


_FLAGS = {
    "empty_user": "length(\"user\") = 0", "empty_assistant": "length(assistant) = 0", "is_mcq": I.mcq('"user"'), "has_think": "regexp_matches(assistant, '(?s)<think>.*?</think>')",
    "has_alef_variants": "regexp_matches(\"user\", '[آأإٱ]')", "has_ta_marbuta": "contains(\"user\", 'ة')", "has_alef_maksura": "contains(\"user\", 'ى')",
    "has_tashkeel": r"""regexp_matches("user", '[\x{064B}-\x{065F}\x{0670}]')""", "has_wrapper": " OR ".join(f"contains(assistant, '{w}')" for w in P.ANSWER_WRAPPERS),
    "has_code": "contains(assistant, '```') OR contains(\"user\", '```')", "has_url": "regexp_matches(assistant, 'https?://') OR regexp_matches(\"user\", 'https?://')",
}


@query(f"WITH {I.CHATS_SQL} SELECT 'rows' AS metric, count(*) AS value FROM chats " + " ".join(f"UNION ALL SELECT '{n}', count(*) FILTER (WHERE {c}) FROM chats" for n, c in _FLAGS.items()))
def profile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.counters(I.chats(spark, sf_dir), "user", "assistant")


_MOMENTS = "count(v) AS count, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, min(v) AS min, max(v) AS max, sum(v) AS total"


@query(
    f"WITH {I.CHATS_SQL}, x AS (SELECT 'user_chars' AS metric, CAST(length(\"user\") AS DOUBLE) AS v FROM chats UNION ALL SELECT 'assistant_chars', length(assistant) FROM chats "
    f"UNION ALL SELECT 'messages', n_messages FROM chats) SELECT metric, {_MOMENTS} FROM x GROUP BY metric"
)
def profile_lengths(spark, sf_dir):
    m = profile.moments(I.chats(spark, sf_dir), {"user_chars": F.length("user"), "assistant_chars": F.length("assistant"), "messages": F.col("n_messages")})
    return m.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("SELECT CAST(floor(length(coalesce(text, '')) / 100) * 100 AS BIGINT) AS bucket, count(*) AS count FROM documents GROUP BY 1 ORDER BY 1 LIMIT 30")
def profile_len_hist(spark, sf_dir):
    return profile.width_histogram(I.documents(spark, sf_dir), F.length("user"))


@query(f"WITH {I.CHATS_SQL} SELECT role_path AS key, count(*) AS count FROM chats GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def profile_role_patterns(spark, sf_dir):
    return profile.top_counts(I.chats(spark, sf_dir), F.col("role_path"), 20)


@query("SELECT n AS key, count(*) AS count FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id) GROUP BY 1")
def profile_msg_counts(spark, sf_dir):
    return profile.top_counts(I.chats(spark, sf_dir), F.col("n_messages"))


@query(f"WITH {I.CHATS_SQL} SELECT 'user' AS side, {I.language(q('user'))} AS language, count(*) AS count FROM chats GROUP BY ALL UNION ALL SELECT 'assistant', {I.language('assistant')}, count(*) FROM chats GROUP BY ALL")
def profile_language(spark, sf_dir):
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), T.language(s).alias("language")) for s in ("user", "assistant")]))
    return I.chats(spark, sf_dir).select(sides.alias("x")).groupBy("x.side", "x.language").agg(F.count(F.lit(1)).alias("count"))


@query(
    f"WITH {I.CHATS_SQL}, n AS (SELECT count(*) AS n, count(*) FILTER (WHERE {I.language(q('user'))} = 'arabic') AS ar, count(*) FILTER (WHERE {I.mcq(q('user'))}) AS mcq, "
    "count(*) FILTER (WHERE regexp_matches(assistant, '(?s)<think>.*?</think>')) AS th FROM chats) SELECT 'arabic' AS claim, CAST(93.0 AS DOUBLE) AS declared, round(ar * 100.0 / n, 6) AS actual FROM n "
    "UNION ALL SELECT 'mcq', 85.0, round(mcq * 100.0 / n, 6) FROM n UNION ALL SELECT 'thinking', 96.0, round(th * 100.0 / n, 6) FROM n"
)
def profile_declared_vs_actual(spark, sf_dir):
    return profile.declared_vs_actual(I.chats(spark, sf_dir), "user", "assistant").withColumn("actual", F.round(F.col("actual").cast("double"), 6))


@query(f"WITH {I.CHATS_SQL} SELECT w AS key, count(*) AS count FROM chats, (SELECT unnest([{', '.join(repr(w) for w in P.ANSWER_WRAPPERS)}]) AS w) WHERE contains(assistant, w) GROUP BY 1")
def profile_wrappers(spark, sf_dir):
    return profile.wrapper_counts(I.chats(spark, sf_dir), "assistant")


@query(
    f"WITH {I.CHATS_SQL}, t AS (SELECT unnest(regexp_extract_all(assistant, '(?s)<think>(.*?)</think>', 1)) AS b FROM chats) "
    "SELECT CAST(floor(length(b) / 100) * 100 AS BIGINT) AS bucket, count(*) AS count FROM t GROUP BY 1 ORDER BY 1 LIMIT 30"
)
def profile_think_hist(spark, sf_dir):
    return profile.think_histogram(I.chats(spark, sf_dir), "assistant")


@query(
    rf"""WITH {I.CHATS_SQL}, m AS (SELECT regexp_matches("user", '\n[ \t\n\r\f\v]*[أبجدهـA-E][\)\.][ \t\n\r\f\v]') AS mcq, trim(assistant) IN ('أ', 'ب', 'ج', 'د', 'هـ', 'A', 'B', 'C', 'D', 'E') AS ok FROM chats)
    SELECT count(*) FILTER (WHERE mcq) AS mcq, count(*) FILTER (WHERE mcq AND ok) AS letter_only FROM m"""
)
def profile_answer_compliance(spark, sf_dir):
    return profile.answer_compliance(I.chats(spark, sf_dir), "user", "assistant")


# --- exact dedup ----------------------------------------------------------------------------------------------------------------


def _hashes(rows: str) -> str:
    u, a, zero = '"user"', "assistant", "chr(0)"
    return (
        f"h AS (SELECT row_id, sha256({u} || {zero} || {a}) AS l1, sha256({I.ws(u)} || {zero} || {I.ws(a)}) AS l2, sha256({I.ws(u)} || {zero} || {I.ws(I.no_think(a))}) AS l3, "
        f"sha256({I.ws(u)}) AS l4, sha256({I.canon(u)}) AS l5 FROM {rows})"
    )


def _levels_sql(rows: str, source: str) -> str:
    each = " UNION ALL ".join(f"SELECT '{x}' AS level, {x} AS hash FROM h" for x in exact.LEVELS)
    return (
        f"WITH {source}, {_hashes(rows)}, s AS (SELECT level, hash, count(*) AS n FROM ({each}) GROUP BY ALL) SELECT level, CAST(sum(n) AS BIGINT) AS rows, count(*) AS unique_hashes, "
        "count(*) FILTER (WHERE n = 1) AS singletons, count(*) FILTER (WHERE n > 1) AS duplicate_clusters, CAST(sum(n - 1) AS BIGINT) AS removable, round(sum(n - 1) / sum(n), 4) AS fraction FROM s GROUP BY level"
    )


@query(_levels_sql("chats", I.CHATS_SQL))
def exact_levels_report(spark, sf_dir):
    return exact.report(exact.digests(I.chats(spark, sf_dir), "user", "assistant")).withColumn("fraction", F.round("fraction", 4))


@query(_levels_sql("docs", I.DOCS_SQL))
def exact_levels_documents(spark, sf_dir):
    return exact.report(exact.digests(I.documents(spark, sf_dir), "user", "assistant")).withColumn("fraction", F.round("fraction", 4))


def _digests(spark, sf_dir):
    """(row_id, l3) of documents, written once: the first of each group and the rows beside it are both read from there."""
    return staged(exact.digests(I.documents(spark, sf_dir), "user", "assistant").select("row_id", "l3"), "digests")


@query(f"WITH {I.DOCS_SQL}, {_hashes('docs')} SELECT row_id, l3 AS hash, row_id = min(row_id) OVER (PARTITION BY l3) AS kept FROM h")
def exact_l3_keep(spark, sf_dir):
    return exact.keep_first(_digests(spark, sf_dir), "l3")


@query(
    f"WITH {I.DOCS_SQL}, {_hashes('docs')}, t AS (SELECT l5 AS hash, count(*) AS size, min(row_id) AS first_id FROM h GROUP BY l5 HAVING count(*) > 1 ORDER BY size DESC, first_id LIMIT 200) "
    "SELECT hash, size, first_id, row_id FROM h JOIN t ON l5 = hash"
)
def exact_clusters_top(spark, sf_dir):
    return exact.clusters(exact.digests(I.documents(spark, sf_dir), "user", "assistant"), "l5")


@query(f"WITH {I.DOCS_SQL}, {_hashes('docs')} SELECT count(*) AS size, min(row_id) AS first_id FROM h GROUP BY l3 HAVING count(*) > 1 ORDER BY size DESC, first_id LIMIT 20")
def exact_top_sizes(spark, sf_dir):
    return exact.top_sizes(exact.digests(I.documents(spark, sf_dir), "user", "assistant"), "l3")


@query(
    f"WITH {I.DOCS_SQL}, {_hashes('docs')}, t AS (SELECT count(*) AS size, min(row_id) AS first_id FROM h GROUP BY l5 ORDER BY size DESC, first_id LIMIT 20) "
    'SELECT CAST(row_number() OVER (ORDER BY size DESC, first_id) AS INTEGER) AS place, size, first_id, substr("user", 1, 300) AS preview FROM t JOIN docs ON row_id = first_id'
)
def exact_top_templates(spark, sf_dir):
    docs = I.documents(spark, sf_dir)
    return exact.top_templates(docs, exact.digests(docs, "user", "assistant"), "user")


# --- samples --------------------------------------------------------------------------------------------------------------------


def _sample_sql(source: str, rows: str, stratum: str, k: int = 50) -> str:
    return (
        f"WITH {source} SELECT stratum, place, row_id FROM (SELECT {stratum} AS stratum, row_id, CAST(row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42:' || CAST(row_id AS VARCHAR)), row_id) AS INTEGER) AS place FROM {rows}) WHERE place <= {k}"
    )


@query(_sample_sql(I.DOCS_SQL, "docs", "'all'"))
def sample_uniform(spark, sf_dir):
    return sampling.per_stratum(I.documents(spark, sf_dir), F.lit("all")).select("stratum", "place", "row_id")


@query(_sample_sql(I.DOCS_SQL, "docs", "lang"))
def sample_by_language(spark, sf_dir):
    return sampling.per_stratum(I.documents(spark, sf_dir), F.col("lang")).select("stratum", "place", "row_id")


_BROAD = " OR ".join(
    f"regexp_matches(\"user\", '{p}')"
    for p in (r"\n[ \t\n\r\f\v]*[أبجدهـ][\)\.][ \t\n\r\f\v]", r"\n[ \t\n\r\f\v]*[A-E][\)\.][ \t\n\r\f\v]", r"\n[ \t\n\r\f\v]*\d+[\)\.][ \t\n\r\f\v].*\n[ \t\n\r\f\v]*\d+[\)\.][ \t\n\r\f\v]", r"(?i)Choose the correct", r"(?i)multiple.choice", r"(?s)\bA\)[ \t\n\r\f\v].*\bB\)[ \t\n\r\f\v]")
)


@query(_sample_sql(I.CHATS_SQL, "chats", f"CASE WHEN {_BROAD} THEN 'mcq' ELSE 'open' END"))
def sample_by_type(spark, sf_dir):
    return sampling.per_stratum(I.chats(spark, sf_dir), F.when(T.is_mcq_broad("user"), "mcq").otherwise("open")).select("stratum", "place", "row_id")


_TOPIC_SQL = {n: p.replace("(?Udi)", "(?i)") for n, p in P.TOPICS.items()}
_TOPIC_ROWS = " UNION ALL ".join(f"""SELECT row_id, '{n}' AS topic FROM chats WHERE regexp_matches("user", '{p}')""" for n, p in _TOPIC_SQL.items())


@query(_sample_sql(f"{I.CHATS_SQL}, topics AS ({_TOPIC_ROWS})", "topics", "topic"))
def sample_by_topic(spark, sf_dir):
    return sampling.by_topic(I.chats(spark, sf_dir), "user").select("stratum", "place", "row_id")


@query(
    f"WITH s AS ({_sample_sql(I.DOCS_SQL, 'docs', 'lang')}) SELECT stratum AS slice, count(*) AS count, string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id) AS row_ids FROM s GROUP BY 1"
)
def sample_index(spark, sf_dir):
    return sampling.slice_index(sampling.per_stratum(I.documents(spark, sf_dir), F.col("lang")))


@query(f"WITH {I.DOCS_SQL} SELECT row_id, length(\"user\") AS score FROM docs ORDER BY score DESC, row_id LIMIT 50")
def topk_longest(spark, sf_dir):
    return sampling.top_k(I.documents(spark, sf_dir), F.length("user").cast("bigint")).select("row_id", "score")


@query(f"WITH {I.DOCS_SQL} SELECT row_id, length(\"user\") AS score FROM docs ORDER BY score, row_id LIMIT 50")
def topk_shortest(spark, sf_dir):
    return sampling.top_k(I.documents(spark, sf_dir), F.length("user").cast("bigint"), high=False).select("row_id", "score")


@query(
    f"WITH {I.CHATS_SQL}, t AS (SELECT row_id, regexp_extract_all(assistant, '(?s)<think>(.*?)</think>', 1) AS b FROM chats) "
    "SELECT row_id, CAST(list_sum(list_transform(b, lambda x: length(x))) AS BIGINT) AS score FROM t WHERE len(b) > 0 ORDER BY score DESC, row_id LIMIT 50"
)
def topk_think(spark, sf_dir):
    return sampling.longest_think(I.chats(spark, sf_dir), "assistant").select("row_id", F.col("score").cast("bigint").alias("score"))


# --- canonical forms, formats ---------------------------------------------------------------------------------------------------


@query(
    f"WITH {I.CHATS_SQL} SELECT row_id, {I.canon(q('user'))} AS canonical, {I.ws('assistant')} AS collapsed, {I.ws(I.no_think('assistant'))} AS answer FROM chats"
)
def canon_arabic(spark, sf_dir):
    return I.chats(spark, sf_dir).select("row_id", T.canonical("user").alias("canonical"), T.collapse("assistant").alias("collapsed"), T.collapse(T.strip_think("assistant")).alias("answer"))


# the threads are in normal form NFKC and hold no invisible marks; folding itself is tried in unicode_cleaned
@query(f"""WITH {I.CHATS_SQL}, c AS (SELECT row_id, {I.mcq_line('"user"')} AS is_mcq, {I.ws('"user"')} AS u, {I.ws("assistant")} AS a FROM chats)
    SELECT row_id, is_mcq, u AS "user", a AS assistant FROM c WHERE u <> '' AND a <> ''""")
def normalize_filter(spark, sf_dir):
    """NFKC cleaning, both sides present, ratio of Arabic letters; the question type is read before lines are joined."""
    rows = I.chats(spark, sf_dir).select("row_id", T.is_mcq_line("user").alias("is_mcq"), T.unicode_clean("user").alias("user"), T.unicode_clean("assistant").alias("assistant"))
    return rows.where((F.length("user") > 0) & (F.length("assistant") > 0)).where(T.arabic_ratio("user") >= 0.0)


@query(
    f"""WITH {I.CHATS_SQL} SELECT row_id, CASE row_id % 5 WHEN 2 THEN "user" || chr(10) || 'more' WHEN 4 THEN "user" || chr(10) || 'أ) x' || chr(10) || 'ب) ' || chr(10) || 'ج) ' || chr(10) || 'د) ' ELSE "user" END AS first_user,
    assistant AS first_assistant, CASE WHEN row_id % 5 = 1 AND assistant = '' THEN 1 ELSE 2 END AS n FROM chats WHERE NOT (row_id % 5 = 1 AND "user" = '')"""
)
def shape_dispatch(spark, sf_dir):
    """Records of five shapes, by row_id, through the dispatcher."""
    rows, k = I.chats(spark, sf_dir), F.col("row_id") % 5
    only = lambda test, c: F.when(test, c)
    record = F.struct(
        only(k == 0, chat.pair(F.col("user"), F.col("assistant"))).alias("messages"),
        only(k == 1, F.array(*[F.struct(F.lit(None).cast("string").alias("role"), F.lit(r).alias("from"), F.lit(None).cast("string").alias("content"), F.col(c).alias("value")) for r, c in (("human", "user"), ("gpt", "assistant"))])).alias("conversations"),
        only(k == 2, F.col("user")).alias("instruction"), only(k == 2, F.lit("more")).alias("input"), only(k == 2, F.col("assistant")).alias("output"),
        only(k == 3, F.col("user")).alias("prompt"), only(k == 3, F.col("assistant")).alias("response"),
        only(k == 4, F.col("user")).alias("question"), only(k == 4, F.create_map(F.lit("أ"), F.lit("x"))).alias("options"), only(k == 4, F.col("assistant")).alias("answer"),
        F.lit(None).cast("string").alias("user"), F.lit(None).cast("string").alias("assistant"),
    )
    m = F.col("m")
    out = rows.select("row_id", chat.dispatch(record).alias("m")).where(F.size("m") > 0)
    return out.select("row_id", chat.first(m, "user").alias("first_user"), chat.first(m, "assistant").alias("first_assistant"), F.size("m").alias("n")).where(~((k == 1) & (F.col("first_user") == "")))


@query(f"WITH {I.CHATS_SQL} SELECT row_id, 'system->user->assistant' AS roles, 3 AS n FROM chats")
def format_chat(spark, sf_dir):
    m = chat.with_system(chat.pair(F.col("user"), F.col("assistant")), F.lit("Answer the question."))
    return I.chats(spark, sf_dir).select("row_id", chat.role_path(m).alias("roles"), F.size(m).alias("n"))


@query(
    f"""WITH {I.CHATS_SQL} SELECT row_id, CASE WHEN regexp_matches(assistant, '[أبجدهـ]') THEN regexp_extract(assistant, '[أبجدهـ]') WHEN regexp_matches(assistant, '\\b([A-E])\\b')
    THEN map {{'A': 'أ', 'B': 'ب', 'C': 'ج', 'D': 'د', 'E': 'هـ'}}[regexp_extract(assistant, '\\b([A-E])\\b', 1)] ELSE regexp_replace(assistant, '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g') END AS letter FROM chats"""
)
def answer_letter(spark, sf_dir):
    return I.chats(spark, sf_dir).select("row_id", T.answer_letter("assistant").alias("letter"))


# --- n-grams --------------------------------------------------------------------------------------------------------------------

_PUNCT = rf"""translate({{x}}, '{P.FOLD_FROM + P.PUNCT_FROM + P.DELETED}', '{P.FOLD_TO + ' ' * len(P.PUNCT_FROM)}')"""


def _grams(x: str, keys: str, rows: str) -> str:
    norm = I.ws(rf"lower(regexp_replace({_PUNCT.format(x=x)}, '[\x{{064B}}-\x{{065F}}\x{{0670}}]', '', 'g'))")
    return (
        f"SELECT DISTINCT {keys}, sha1(array_to_string(list_slice(w, i, i + 12), ' ')) AS gram FROM (SELECT {keys}, w, unnest(range(1, len(w) - 11)) AS i FROM "
        f"(SELECT {keys}, list_filter(string_split({norm}, ' '), lambda y: y <> '') AS w FROM {rows}) WHERE len(w) >= 13)"
    )


_NGRAM = (
    f"{I.DOCS_SQL}, bench AS (SELECT 'b' || CAST(item_id % 4 AS VARCHAR) AS benchmark, coalesce(text, '') AS text FROM benchmark), bg AS ({_grams('text', 'benchmark', 'bench')}), "
    f"dg AS ({_grams(q('user'), 'row_id', 'docs')}), hits AS (SELECT row_id, benchmark, count(*) AS overlap FROM dg JOIN bg USING (gram) GROUP BY ALL)"
)


def _bench(spark, sf_dir):
    return I.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("b"), (F.col("item_id") % 4).cast("string")).alias("benchmark"), "text")


def _hits(spark, sf_dir):
    return ngrams.hits(I.documents(spark, sf_dir), _bench(spark, sf_dir), text="user")


@query(f"WITH {_NGRAM} SELECT benchmark, count(*) AS grams FROM bg GROUP BY 1")
def ngram_sizes(spark, sf_dir):
    return ngrams.benchmark_grams(_bench(spark, sf_dir)).groupBy("benchmark").agg(F.count(F.lit(1)).alias("grams"))


@query(f"WITH {_NGRAM} SELECT row_id, benchmark, overlap FROM hits")
def ngram_hits(spark, sf_dir):
    return _hits(spark, sf_dir)


@query(f"WITH {_NGRAM} SELECT row_id FROM docs WHERE row_id NOT IN (SELECT row_id FROM hits)")
def ngram_decontaminated(spark, sf_dir):
    return ngrams.decontaminated(I.documents(spark, sf_dir), _hits(spark, sf_dir)).select("row_id")


@query(
    f"WITH {_NGRAM} SELECT 'rows' AS metric, '' AS benchmark, count(*) AS value FROM docs UNION ALL SELECT 'removed', '', count(DISTINCT row_id) FROM hits "
    "UNION ALL SELECT 'kept', '', (SELECT count(*) FROM docs) - (SELECT count(DISTINCT row_id) FROM hits) UNION ALL SELECT 'grams', benchmark, count(*) FROM bg GROUP BY 2 "
    "UNION ALL SELECT 'removed_by', benchmark, count(DISTINCT row_id) FROM hits GROUP BY 2"
)
def ngram_report(spark, sf_dir):
    return ngrams.report(I.documents(spark, sf_dir), _bench(spark, sf_dir), _hits(spark, sf_dir))


# --- leakage by patterns --------------------------------------------------------------------------------------------------------


def _re2(p: str) -> str:
    """A pattern in the other engine's dialect; the chats hold ASCII white space and words only where it matters."""
    head, body = p[: p.index(")") + 1], p[p.index(")") + 1 :]
    flags = head.removeprefix("(?Ud").removesuffix(")")
    return (f"(?{flags})" if flags else "") + body.replace(r"[\s\x1c-\x1f]", r"[ \t\n\r\f\v]")


_CLEAN = I.no_think("assistant")
_FLAG_ROWS = " UNION ALL ".join(
    f"SELECT row_id, '{n}' AS benchmark FROM chats WHERE " + " OR ".join([f"""regexp_matches("user", '{_re2(p)}')""" for p in f.user] + [f"regexp_matches({_CLEAN}, '{_re2(p)}')" for p in f.assistant])
    for n, f in P.FINGERPRINTS.items()
)
_MENTIONED = f"""regexp_matches("user" || ' ' || {_CLEAN}, '{_re2(P.MENTION)}')"""
_LEAKED = " OR ".join(f"regexp_matches({_CLEAN}, '{_re2(p)}')" for p in P.RUBRIC)
_LEAK = f"{I.CHATS_SQL}, flags AS ({_FLAG_ROWS})"


def _flags(spark, sf_dir):
    return leakage.flagged(I.chats(spark, sf_dir), "user", "assistant")


@query(
    f"WITH {_LEAK}, r AS (SELECT *, row_number() OVER (PARTITION BY benchmark ORDER BY row_id) AS n FROM flags) SELECT benchmark, count(*) AS rows, "
    "string_agg(CAST(row_id AS VARCHAR), ',' ORDER BY row_id) FILTER (WHERE n <= 50) AS sample_ids FROM r GROUP BY 1"
)
def leak_flags_by_bench(spark, sf_dir):
    return leakage.by_benchmark(_flags(spark, sf_dir))


@query(
    f"WITH {_LEAK} SELECT (SELECT count(*) FROM chats) AS rows, (SELECT count(DISTINCT row_id) FROM flags) AS all_flagged, (SELECT count(*) FROM chats WHERE {_MENTIONED}) AS mentions, (SELECT count(*) FROM chats WHERE {_LEAKED}) AS rubric_rows"
)
def leak_totals(spark, sf_dir):
    return leakage.totals(_flags(spark, sf_dir))


@query(f"WITH {_LEAK} SELECT row_id FROM chats WHERE {_MENTIONED}")
def leak_mentions(spark, sf_dir):
    return leakage.sample_ids(_flags(spark, sf_dir), "mention", None)


@query(f"WITH {_LEAK} SELECT row_id FROM chats WHERE NOT ({_MENTIONED} OR {_LEAKED})")
def leak_removed(spark, sf_dir):
    """What is left once all rows with mentions or rubric leaks are gone."""
    flags = staged(_flags(spark, sf_dir), "flags")
    high = leakage.sample_ids(flags, "mention", None).unionByName(leakage.sample_ids(flags, "rubric", None))
    return flags.select("row_id").join(high, "row_id", "left_anti")


@query(f"WITH {_LEAK} SELECT row_id FROM chats WHERE {_LEAKED}")
def leak_rubric(spark, sf_dir):
    return leakage.sample_ids(_flags(spark, sf_dir), "rubric", None)


@query(
    f"WITH {_LEAK}, top AS (SELECT benchmark, count(*) AS n FROM flags GROUP BY 1 ORDER BY n DESC, benchmark LIMIT 3), r AS (SELECT benchmark, row_id, CAST(row_number() OVER (PARTITION BY benchmark ORDER BY row_id) AS INTEGER) AS place FROM flags JOIN top USING (benchmark)) "
    'SELECT benchmark, place, row_id, substr("user", 1, 300) AS preview FROM r JOIN chats USING (row_id) WHERE place <= 10'
)
def leak_top3_preview(spark, sf_dir):
    return leakage.top_previews(I.chats(spark, sf_dir), _flags(spark, sf_dir), "user")


# --- clean build ----------------------------------------------------------------------------------------------------------------

_SETS = (
    f"{_NGRAM}, {_hashes('docs')}, ex AS (SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY l3 ORDER BY row_id) AS n FROM h) WHERE n > 1), "
    "removed AS (SELECT row_id, 1 AS p, 'exact_duplicate' AS r FROM ex UNION SELECT row_id, 3, 'leakage_high_confidence' FROM hits)"
)


def _sets(spark, sf_dir):
    docs = I.documents(spark, sf_dir)
    return docs, {
        "exact_duplicate": exact.keep_first(_digests(spark, sf_dir), "l3").where("not kept").select("row_id"),
        "leakage_high_confidence": _hits(spark, sf_dir).select("row_id").distinct(),
    }


@query(f"WITH {_SETS} SELECT row_id, string_agg(r, ',' ORDER BY p) AS reasons FROM removed GROUP BY 1")
def removal_log(spark, sf_dir):
    return clean.removal_log(_sets(spark, sf_dir)[1]).select("row_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {_SETS} SELECT row_id FROM docs WHERE row_id NOT IN (SELECT row_id FROM removed)")
def clean_rows(spark, sf_dir):
    docs, sets = _sets(spark, sf_dir)
    return clean.kept(docs, clean.removal_log(sets)).select("row_id")


@query(f"WITH {_SETS} SELECT r AS reason, count(*) AS rows FROM removed GROUP BY 1 UNION ALL SELECT 'unique', count(DISTINCT row_id) FROM removed")
def removal_reasons(spark, sf_dir):
    return clean.reason_counts(clean.removal_log(_sets(spark, sf_dir)[1]))


@query(
    f"WITH {_SETS}, n AS (SELECT count(*) AS n FROM docs), e AS (SELECT count(*) AS e FROM ex), u AS (SELECT count(DISTINCT row_id) AS u FROM removed) SELECT 0 AS step, 'source' AS stage, n AS rows FROM n "
    "UNION ALL SELECT 1, 'after_exact_duplicate', n - e FROM n, e UNION ALL SELECT 2, 'after_leakage_high_confidence', n - u FROM n, u"
)
def funnel(spark, sf_dir):
    return clean.funnel(*_sets(spark, sf_dir))


# --- curriculum -----------------------------------------------------------------------------------------------------------------


@query(f"WITH {I.DOCS_SQL} SELECT row_id FROM docs WHERE source = 'src0'")
def curriculum_phase1(spark, sf_dir):
    return curriculum.phase1(I.documents(spark, sf_dir), "src0").select("row_id")


@query(
    f"WITH {I.DOCS_SQL}, p AS (SELECT row_id, CASE source WHEN 'src1' THEN 0 ELSE 1 END AS part FROM docs WHERE source IN ('src1', 'src2')), b AS (SELECT row_id, row_number() OVER (ORDER BY row_id) AS n FROM docs WHERE source = 'src0') "
    "SELECT row_id, part FROM p UNION ALL SELECT row_id, 2 FROM b WHERE n <= (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) FROM p)"
)
def curriculum_phase2(spark, sf_dir):
    return curriculum.phase2(I.documents(spark, sf_dir), ["src1", "src2"], broad="src0").select("row_id", "part")


@query("SELECT coalesce(source, 'unknown') AS source, count(*) AS rows FROM documents GROUP BY 1")
def curriculum_counts(spark, sf_dir):
    return curriculum.counts(I.documents(spark, sf_dir))
