"""Inputs of the registered queries from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import chat

#: The tables hold no Arabic, reasoning or options. A sixth of the threads each gets some of them; both engines read these expressions.
USER = (
    "CASE row_id % 6 WHEN 1 THEN concat('أشرح  لي، ', last_user) WHEN 2 THEN replace(last_user, ' ', '  ') "
    "WHEN 3 THEN concat(last_user, chr(10), 'أ) نعم', chr(10), 'ب) لا ') WHEN 4 THEN concat('benchmark biology review: ', last_user) ELSE last_user END"
)
ASSISTANT = (
    "CASE row_id % 6 WHEN 0 THEN concat('<think>', last_user, '</think>', last_assistant) WHEN 3 THEN 'الإجابة الصحيحة هي: أ' "
    "WHEN 5 THEN concat('<think>a', chr(10), 'b</think>', last_assistant, '<think>cc</think>') ELSE last_assistant END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, n_messages, role_path, user, assistant) of all threads."""
    rows = chat.from_turns(table(spark, sf_dir, "conversations"))
    return rows.select("row_id", "n_messages", "role_path", F.expr(USER).alias("user"), F.expr(ASSISTANT).alias("assistant"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, user, assistant, lang, source): documents as prompts without answers."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.coalesce("text", F.lit("")).alias("user"), F.lit("").alias("assistant"), "lang", "source")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding", "label")


# --- the same in DuckDB ---------------------------------------------------------------------------------------------------------

CHATS_SQL = f"""threads AS (
  SELECT conv_id AS row_id, count(*) AS n_messages, string_agg(coalesce(role, '?'), '->' ORDER BY turn, role) AS role_path,
    coalesce(arg_max(coalesce(text, ''), turn) FILTER (WHERE role = 'user'), '') AS last_user,
    coalesce(arg_max(coalesce(text, ''), turn) FILTER (WHERE role = 'assistant'), '') AS last_assistant
  FROM conversations GROUP BY conv_id
), chats AS (SELECT row_id, n_messages, role_path, {USER} AS "user", {ASSISTANT} AS assistant FROM threads)"""
DOCS_SQL = """docs AS (SELECT doc_id AS row_id, coalesce(text, '') AS "user", '' AS assistant, lang, source FROM documents)"""
SPACE = r"[ \t\n\r\f\v]+"


def ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'))"


def no_think(x: str) -> str:
    return f"regexp_replace({x}, '(?s)<think>.*?</think>', '', 'g')"


def canon(x: str) -> str:
    from corpuskit.functions import patterns as P

    a, b = P.FOLD_FROM + P.PUNCT_FROM + P.DELETED, P.FOLD_TO + P.PUNCT_TO
    return f"lower({ws(rf'''regexp_replace(translate({x}, '{a}', '{b}'), '[\x{{064B}}-\x{{065F}}\x{{0670}}]', '', 'g')''')})"


ARABIC = r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"


def count_of(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def language(x: str) -> str:
    a, b = count_of(x, ARABIC), count_of(x, "[A-Za-z]")
    return f"CASE WHEN {a} + {b} = 0 THEN 'other' WHEN {a} / ({a} + {b}) >= 0.85 THEN 'arabic' WHEN {a} / ({a} + {b}) <= 0.15 THEN 'english' ELSE 'mixed' END"


def mcq_line(x: str) -> str:
    return rf"regexp_matches({x}, '\n[ \t\n\r\f\v]*[أبجدهـA-E][\)\.][ \t\n\r\f\v]')"


def mcq(x: str) -> str:
    marks = f"({count_of(x, r'[أبجدهـ]\)')} + {count_of(x, r'\b[A-E]\)')})"
    return f"({mcq_line(x)} OR {marks} >= 2 OR (regexp_matches({x}, '(?i)اختر|اختيار|Choose|choose|multiple.choice|متعدد') AND {marks} >= 1))"
