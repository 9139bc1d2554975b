"""Profiles of chat rows and texts: counters, moments, histograms, percentiles. Each is one aggregation pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import patterns as P
from corpuskit.functions import text as T
from corpuskit.staging import staged

#: The edges of the reports' histograms.
SELF_BINS = (0, 0.5, 0.7, 0.8, 0.85, 0.90, 0.93, 0.95, 0.96, 0.97, 0.98, 0.99, 1.01)
LEAK_BINS = (0, 0.5, 0.6, 0.7, 0.8, 0.85, 0.88, 0.90, 0.93, 0.96, 0.99, 1.01)
#: Declared shares of the corpus, in percent.
DECLARED = {"arabic": 93.0, "mcq": 85.0, "thinking": 96.0}


def flags(user: str, assistant: str) -> dict[str, Column]:
    """The profile's boolean features of a row."""
    u, a = F.col(user), F.col(assistant)
    return {
        "empty_user": F.length(u) == 0, "empty_assistant": F.length(a) == 0, "is_mcq": T.is_mcq(u), "has_think": F.size(T.think_lengths(a)) > 0,
        **T.orthography(u), "has_wrapper": F.size(T.wrappers(a)) > 0, "has_code": T.has_code(a) | T.has_code(u), "has_url": T.has_url(a) | T.has_url(u),
    }


def counters(rows: DataFrame, user: str, assistant: str) -> DataFrame:
    """(metric, value): rows and, for each flag, the rows that have it; one pass."""
    named = flags(user, assistant)
    one = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in named.items()])
    return one.unpivot([], ["rows", *named], "metric", "value")


def moments(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(metric, count, mean, std, min, max, total) of several numbers in one pass; std is that of the population. Unrounded."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), c.cast("double").alias("v")) for n, c in columns.items()]))
    return (
        rows.select(each.alias("x")).select("x.*").where("v is not null").groupBy("metric")
        .agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"), F.sum("v").alias("total"))
    )


def width_histogram(rows: DataFrame, value: Column, width: int = 100, buckets: int = 30) -> DataFrame:
    """(bucket, count): buckets of one width, by their lower ends; the first ``buckets`` that hold anything."""
    return rows.groupBy((F.floor(value / width) * width).cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).alias("count")).where("bucket is not null").orderBy("bucket").limit(buckets)


def edge_histogram(rows: DataFrame, value: Column, edges: tuple[float, ...]) -> DataFrame:
    """(bin, low, high, count): half-open bins, the last closed; empty bins count 0 and values outside are dropped."""
    n = len(edges) - 1
    inside = lambda k: (value >= edges[k]) & ((value < edges[k + 1]) if k < n - 1 else (value <= edges[k + 1]))
    one = rows.agg(*[F.count_if(inside(k)).alias(f"b{k}") for k in range(n)])
    rows_ = F.array(*[F.struct(F.lit(k).alias("bin"), F.lit(float(edges[k])).alias("low"), F.lit(float(edges[k + 1])).alias("high"), F.col(f"b{k}").alias("count")) for k in range(n)])
    return one.select(F.explode(rows_).alias("x")).select("x.*")


def percentiles(rows: DataFrame, value: Column, ranges: int = 4_096, most: int = 20_000) -> DataFrame:
    """mean, max and exact p50, p90, p95, p99 with linear interpolation, as one row.

    Counts of value ranges find the range of each rank, and ranges with more than ``most`` values are cut again; so no task and not the
    driver sees more than ``ranges`` counts or ``most`` values at a time, however many values there are.
    """
    spark = rows.sparkSession
    v = staged(rows.select(value.cast("double").alias("v")).where("v is not null"), "values")
    n, mean, low, high = v.agg(F.count(F.lit(1)), F.avg("v"), F.min("v"), F.max("v")).first()
    names = ("p50", "p90", "p95", "p99")
    if not n:
        return spark.createDataFrame([(None,) * 6], "mean double, max double, " + ", ".join(f"{x} double" for x in names))
    at = [p * (n - 1) for p in (0.5, 0.9, 0.95, 0.99)]
    wanted = {int(x) for x in at} | {min(n - 1, int(x) + 1) for x in at}
    found = _at_ranks(v, wanted, 0, low, high, n, ranges, most)
    made = [found[int(x)] + (found[min(n - 1, int(x) + 1)] - found[int(x)]) * (x - int(x)) for x in at]
    return spark.createDataFrame([(mean, high, *made)], "mean double, max double, " + ", ".join(f"{x} double" for x in names))


def _at_ranks(v: DataFrame, wanted: set[int], before: int, low: float, high: float, n: int, ranges: int, most: int) -> dict[int, float]:
    """rank -> value, for ranks among the ``n`` values from ``low`` to ``high``, of which ``before`` are smaller."""
    if low == high:
        return dict.fromkeys(wanted, low)
    inside = v.where(F.col("v").between(low, high))
    if n <= most:
        values = [r.v for r in inside.orderBy("v").collect()]
        return {r: values[r - before] for r in wanted}
    part = F.least(F.floor((F.col("v") - low) / (high - low) * ranges), F.lit(ranges - 1))
    counts = inside.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("p").collect()
    out: dict[int, float] = {}
    for r in counts:
        here = {k for k in wanted if before <= k < before + r.n}
        if here:
            out |= _at_ranks(v, here, before, r.low, r.high, r.n, ranges, most)
        before += r.n
    return out


def top_counts(rows: DataFrame, key: Column, n: int | None = None) -> DataFrame:
    """(key, count), most frequent first, ties by key."""
    out = rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), F.asc("key")).limit(n) if n else out


def declared_vs_actual(rows: DataFrame, user: str, assistant: str) -> DataFrame:
    """(claim, declared, actual) in percent of rows."""
    actual = {"arabic": T.language(user) == "arabic", "mcq": T.is_mcq(user), "thinking": F.size(T.think_lengths(assistant)) > 0}
    one = rows.agg(*[(F.count_if(c) * 100.0 / F.count(F.lit(1))).alias(n) for n, c in actual.items()])
    parts = [one.select(F.lit(n).alias("claim"), F.lit(DECLARED[n]).alias("declared"), F.col(n).alias("actual")) for n in actual]
    return reduce(DataFrame.unionByName, parts)


def think_histogram(rows: DataFrame, assistant: str, width: int = 100, buckets: int = 30) -> DataFrame:
    return width_histogram(rows.select(F.explode(T.think_lengths(assistant)).alias("n")), F.col("n"), width, buckets)


def wrapper_counts(rows: DataFrame, assistant: str) -> DataFrame:
    return top_counts(rows.select(F.explode(T.wrappers(assistant)).alias("w")), F.col("w"))


def answer_compliance(rows: DataFrame, user: str, assistant: str) -> DataFrame:
    """Question rows by the line rule, and those answered by a letter only."""
    letters = [*P.LATIN_TO_ARABIC.values(), *P.LATIN_TO_ARABIC]
    mcq = T.is_mcq_line(user)
    return rows.agg(F.count_if(mcq).alias("mcq"), F.count_if(mcq & F.trim(F.col(assistant)).isin(letters)).alias("letter_only"))
