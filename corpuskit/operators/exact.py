"""Exact dedup at five levels, from equal prompts to canonical prompts.

Levels are digests of the raw pair of user and assistant (l1), the pair with white space collapsed (l2), that pair without reasoning
(l3), the collapsed user text (l4) and the canonical user text (l5). All levels are counted in one pass over rows of digests; no text
is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import text as T

LEVELS = ("l1", "l2", "l3", "l4", "l5")


def digests(rows: DataFrame, user: str, assistant: str, key: str = "row_id") -> DataFrame:
    """``key`` and one digest per level."""
    plain = T.collapse(user)
    return rows.select(
        key, T.pair_digest(user, assistant).alias("l1"), T.pair_digest(plain, T.collapse(assistant)).alias("l2"),
        T.pair_digest(plain, T.collapse(T.strip_think(assistant))).alias("l3"), T.digest(plain).alias("l4"), T.digest(T.canonical(user)).alias("l5"),
    )


def by_level(hashed: DataFrame, key: str = "row_id") -> DataFrame:
    return hashed.unpivot([key], list(LEVELS), "level", "hash")


def report(hashed: DataFrame, key: str = "row_id") -> DataFrame:
    """(level, rows, unique_hashes, singletons, duplicate_clusters, removable, fraction): sizes are counted before levels are."""
    sizes = by_level(hashed, key).groupBy("level", "hash").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("level").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("unique_hashes"), F.count_if(F.col("n") == 1).alias("singletons"),
        F.count_if(F.col("n") > 1).alias("duplicate_clusters"), F.sum(F.col("n") - 1).alias("removable"), (F.sum(F.col("n") - 1) / F.sum("n")).alias("fraction"),
    )


def top_sizes(hashed: DataFrame, level: str, n: int = 20) -> DataFrame:
    """(size, first_id) of the largest groups of a level."""
    sizes = hashed.groupBy(F.col(level).alias("hash")).agg(F.count(F.lit(1)).alias("size"), F.min("row_id").alias("first_id"))
    return sizes.where("size > 1").orderBy(F.desc("size"), "first_id").limit(n).select("size", "first_id")


def keep_first(hashed: DataFrame, level: str, key: str = "row_id") -> DataFrame:
    """(key, hash, kept): whether a row is the first of its group. The first id is an aggregate, so a large group meets no window."""
    first = hashed.groupBy(F.col(level).alias("hash")).agg(F.min(key).alias("first_id"))
    return hashed.select(key, F.col(level).alias("hash")).join(first, "hash").select(key, "hash", (F.col(key) == F.col("first_id")).alias("kept"))


def clusters(hashed: DataFrame, level: str, most: int = 200, key: str = "row_id") -> DataFrame:
    """(hash, size, first_id, key): the members of the ``most`` largest groups, a row each, so no group is gathered in one place."""
    sizes = hashed.groupBy(F.col(level).alias("hash")).agg(F.count(F.lit(1)).alias("size"), F.min(key).alias("first_id")).where("size > 1")
    top = sizes.orderBy(F.desc("size"), "first_id").limit(most)
    return hashed.select(key, F.col(level).alias("hash")).join(F.broadcast(top), "hash").select("hash", "size", "first_id", key)


def top_templates(rows: DataFrame, hashed: DataFrame, user: str, n: int = 20) -> DataFrame:
    """(place, size, first_id, preview): the most repeated canonical prompts."""
    sizes = hashed.groupBy("l5").agg(F.count(F.lit(1)).alias("size"), F.min("row_id").alias("first_id")).orderBy(F.desc("size"), "first_id").limit(n)
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.desc("size"), "first_id")))
    return rows.select("row_id", T.preview(user).alias("preview")).join(F.broadcast(ranked), F.col("row_id") == F.col("first_id")).select("place", "size", "first_id", "preview")


def members(hashed: DataFrame, level: str, key: str = "row_id") -> DataFrame:
    """(key, first_id, size) of every row that has copies: the full removal set, however many groups there are."""
    sizes = hashed.groupBy(F.col(level).alias("hash")).agg(F.count(F.lit(1)).alias("size"), F.min(key).alias("first_id")).where("size > 1")
    return hashed.select(key, F.col(level).alias("hash")).join(sizes, "hash").select(key, "first_id", "size")
