"""Stratified and top-k samples. Order comes from a digest of the seed and the row id, so samples are the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import text as T

SIZE, SEED = 50, 42


def order_key(seed: int, key: str = "row_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def per_stratum(rows: DataFrame, stratum: Column, k: int = SIZE, seed: int = SEED, key: str = "row_id") -> DataFrame:
    """At most ``k`` random rows of each stratum, with ``stratum`` and ``place``. Rank limits apply before the shuffle."""
    order = Window.partitionBy("stratum").orderBy(order_key(seed, key), key)
    return rows.withColumn("stratum", stratum).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def by_topic(rows: DataFrame, user: str, k: int = SIZE, seed: int = SEED, key: str = "row_id") -> DataFrame:
    """A row may stand in several topics."""
    return per_stratum(rows.withColumn("topic", F.explode(T.topics(user))), F.col("topic"), k, seed, key).drop("topic")


def top_k(rows: DataFrame, score: Column, k: int = SIZE, high: bool = True, key: str = "row_id") -> DataFrame:
    """The rows of the highest (lowest) scores, ties to the smaller id."""
    scored = rows.withColumn("score", score).where("score is not null")
    return scored.orderBy(F.desc("score") if high else F.asc("score"), F.asc(key)).limit(k)


def longest_think(rows: DataFrame, assistant: str, k: int = SIZE, key: str = "row_id") -> DataFrame:
    """By the summed length of reasoning blocks, among rows that have any."""
    sizes = T.think_lengths(assistant)
    return top_k(rows, F.when(F.size(sizes) > 0, F.aggregate(sizes, F.lit(0), lambda s, x: s + x)), k, key=key)


def slice_index(slices: DataFrame, key: str = "row_id") -> DataFrame:
    """(slice, count, ids as sorted text) of a sample with column ``stratum``."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list(key)), lambda x: x.cast("string")), ",")
    return slices.groupBy(F.col("stratum").alias("slice")).agg(F.count(F.lit(1)).alias("count"), ids.alias("row_ids"))
