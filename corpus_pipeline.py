"""A training-data pipeline over ``documents``: language ID, near-dedup, secret scan, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next stage's documents.
All but the last return the columns of documents, whatever further columns there are and whatever their names. An empty table gives an
empty table in each stage, and texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import language_id, mixing, near_copies, packing, secret_scan
from corpuskit.llm.common import staged, whole_row

#: A document whose largest language holds less than this share of its letters has no language to train on.
LEAST_SHARE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or without a leading language; fills in missing labels.

    Null and empty texts hold no letter, so they go. Rows with a null doc_id are judged like any other but nothing is learned from them;
    nulls elsewhere stay. Repeated rows are judged alike; of languages with as many letters the first by name leads. Without any label
    no language is known and all documents go.
    """
    model = language_id.fit(docs.select("doc_id", "text", "lang"), ~language_id.held_out())
    rows = docs.select(whole_row(docs).alias("row"), "text")
    found = language_id.identify(rows, model, keep=("row",)).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE))
    field = lambda c: F.col("row").getField(c)
    return found.select(*[(F.coalesce(field(c), F.col("lang_pred")) if c == "lang" else field(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near-duplicates (five-word Jaccard similarity of 0.8).

    Texts without a word (null, empty, blank) are one group. A null doc_id stands above all others; of rows that share the smallest one,
    repeated or not, the first written stays.
    """
    return near_copies.one_of_each(docs)


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with live-looking credentials, of any kind, that few owners hold.

    Null and empty texts hold none and stay; null sources are one owner; repeated rows go or stay together.
    """
    return secret_scan.without_live_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes 80 % of the tokens by target weights, each document once at most; the last document of a source stays whole.

    Texts without a word have no tokens and are never taken. Null languages and sources are leaves of their own. Rows alike in doc_id and
    tokens share one place in the order: they are taken, or not, together.
    """
    rows = mixing.with_levels(docs.select("doc_id", "lang", "source", "text", whole_row(docs).alias("row"))).drop("text")
    taken = mixing.mix(rows, mixing.LEVELS, "n_tokens", fraction=0.8, weights=mixing.WEIGHTS, max_epochs=1, carry=("row",))
    return taken.select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in training sequences.

    Texts without a word take no room, null texts and null sources bring no conflict, a text longer than a sequence is cut into pieces,
    and repeated rows are placed one by one, in different sequences.
    """
    return packing.pack_documents(packing.with_keys(docs), "n_tokens", "source", "cluster")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secrets", drop_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Languages are learned and near copies linked step by step; SQL has no form of either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
