"""Benchmark leakage by patterns: flags per benchmark, direct mentions, rubric leaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import text as T

SAMPLE_CAP = 100


def flagged(rows: DataFrame, user: str, assistant: str, key: str = "row_id") -> DataFrame:
    """(key, benchmarks, mention, rubric) of every row; texts are read once."""
    clean = T.strip_think(T.filled(assistant))
    return rows.select(key, T.fingerprints(T.filled(user), clean).alias("benchmarks"), T.mentions(user, clean).alias("mention"), T.leaks_rubric(clean).alias("rubric"))


def by_benchmark(flags: DataFrame, key: str = "row_id", cap: int = 50) -> DataFrame:
    """(benchmark, rows, sample_ids): how many rows each benchmark flags, and the first ``cap`` ids (all of them are in ``flags``)."""
    each = flags.select(key, F.explode("benchmarks").alias("benchmark"))
    counts = each.groupBy("benchmark").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(first_ids(each, "benchmark", cap, key), "benchmark")


def first_ids(rows: DataFrame, group: str, cap: int, key: str = "row_id") -> DataFrame:
    """(group, sample_ids as text): the smallest ids of each group. Rank limits apply before the shuffle."""
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(key))).where(F.col("_n") <= cap)
    return ranked.groupBy(group).agg(F.array_join(F.transform(F.sort_array(F.collect_list(key)), lambda x: x.cast("string")), ",").alias("sample_ids"))


def totals(flags: DataFrame) -> DataFrame:
    """One row: rows, all_flagged, mentions, rubric_rows."""
    return flags.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("benchmarks") > 0).alias("all_flagged"), F.count_if("mention").alias("mentions"), F.count_if("rubric").alias("rubric_rows"))


def sample_ids(flags: DataFrame, flag: str, cap: int | None = SAMPLE_CAP, key: str = "row_id") -> DataFrame:
    """The first ids that carry a flag; ``cap`` is the reported sample's size, None gives all."""
    hit = flags.where(flag).select(key)
    return hit.orderBy(key).limit(cap) if cap else hit


def top_previews(rows: DataFrame, flags: DataFrame, user: str, most: int = 3, each: int = 10, key: str = "row_id") -> DataFrame:
    """(benchmark, place, row_id, preview): the first rows of the most flagged benchmarks."""
    pairs = flags.select(key, F.explode("benchmarks").alias("benchmark"))
    top = pairs.groupBy("benchmark").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "benchmark").limit(most).select("benchmark")
    order = Window.partitionBy("benchmark").orderBy(key)
    few = pairs.join(F.broadcast(top), "benchmark").withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    return rows.select(key, T.preview(user).alias("preview")).join(F.broadcast(few), key).select("benchmark", "place", key, "preview")
