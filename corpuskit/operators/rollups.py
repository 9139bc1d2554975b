"""Documented rollups of the evaluation tables: by task, by format, status pivot, leaderboard; and the chart tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_task(rows: DataFrame, task: str, run: str, score: Column) -> DataFrame:
    return rows.groupBy(F.col(task).alias("task")).agg(F.countDistinct(run).alias("runs"), F.count(F.lit(1)).alias("samples"), F.avg(score).alias("avg_score"))


def distribution(rows: DataFrame, key: Column) -> DataFrame:
    """(key, rows, share of all rows)."""
    return _with_share(rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("rows")), "rows", 1.0, "share")


def _with_share(counts: DataFrame, value: str, scale: float, name: str, total: int | None = None) -> DataFrame:
    """Adds ``value`` over the total, times ``scale``; the total of a table of counts is one number, so it travels as a literal."""
    total = counts.agg(F.sum(value)).first()[0] if total is None else total
    return counts.withColumn(name, F.col(value) * F.lit(scale) / F.lit(float(total or 1)))


def status_pivot(rows: DataFrame, dataset: str, status: str, values: list[str]) -> DataFrame:
    """(dataset, one column of counts per status); statuses are given, so no extra pass finds them."""
    out = rows.groupBy(F.col(dataset).alias("dataset")).pivot(status, values).count()
    return out.na.fill(0, values)


def leaderboard(rows: DataFrame, keys: list[str], score: Column, threshold: float, difficulty: str | None = None, order: tuple[str, ...] = ("easy", "medium", "hard")) -> DataFrame:
    """``keys``, questions_above_threshold, total_questions, and a sort key of the difficulty if there is one."""
    out = rows.groupBy(*keys).agg(F.count_if(score >= threshold).alias("questions_above_threshold"), F.count(F.lit(1)).alias("total_questions"))
    if difficulty:
        place = F.array_position(F.array(*[F.lit(x) for x in order]), F.lower(F.col(difficulty)))
        out = out.withColumn("difficulty_sort_key", F.when(place > 0, place.cast("int")).otherwise(len(order) + 1))
    return out


def share_table(counts: DataFrame, label: str, value: str) -> DataFrame:
    """(label, value, percent) of a small table of counts, for charts."""
    return _with_share(counts.select(F.col(label).alias("label"), F.col(value).alias("value")), "value", 100.0, "percent")


def flag_shares(counters: DataFrame, flags: list[str]) -> DataFrame:
    """(label, value, percent of rows) of profile counters."""
    rows = counters.where("metric = 'rows'").first()["value"]
    return _with_share(counters.where(F.col("metric").isin(*flags)).select(F.col("metric").alias("label"), "value"), "value", 100.0, "percent", rows)
