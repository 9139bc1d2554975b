"""The clean build: removal sets with reasons, the removal log, kept rows, the funnel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Reasons in the order in which a row lists them.
REASONS = ("exact_duplicate", "semantic_duplicate", "leakage_high_confidence", "embedding_leakage")


def removal_log(sets: dict[str, DataFrame], key: str = "row_id") -> DataFrame:
    """(key, reasons): each removed row once, with all its reasons in their order."""
    place = {r: k for k, r in enumerate(REASONS)}
    rows = reduce(DataFrame.unionByName, [df.select(key, F.lit(place.get(r, len(place))).alias("p"), F.lit(r).alias("r")) for r, df in sets.items()])
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_set(F.struct("p", "r"))), lambda x: x["r"]).alias("reasons"))


def kept(rows: DataFrame, log: DataFrame, key: str = "row_id") -> DataFrame:
    return rows.join(log.select(key), key, "left_anti")


def reason_counts(log: DataFrame) -> DataFrame:
    """(reason, rows), and the number of removed rows as reason ``unique``."""
    each = log.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return each.unionByName(log.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("unique").alias("reason"), "rows"))


def funnel(rows: DataFrame, sets: dict[str, DataFrame], key: str = "row_id") -> DataFrame:
    """(step, stage, rows): what is left after each removal set, in order. One pass over the log."""
    names = list(sets)
    first = reduce(DataFrame.unionByName, [df.select(key, F.lit(k).alias("k")) for k, df in enumerate(sets.values(), 1)]).groupBy(key).agg(F.min("k").alias("k"))
    lost = first.agg(*[F.count_if(F.col("k") <= k) for k in range(1, len(names) + 1)]).first()
    total = rows.count()
    steps = [(0, "source", total)] + [(k, f"after_{n}", total - lost[k - 1]) for k, n in enumerate(names, 1)]
    return rows.sparkSession.createDataFrame(steps, "step int, stage string, rows bigint")
