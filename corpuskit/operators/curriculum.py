"""Curriculum split by source: phase 1, and phase 2 as two sources in order, optionally with a share of phase 1 mixed in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRACTION = 0.2


def phase1(rows: DataFrame, broad: str, source: str = "source") -> DataFrame:
    return rows.where(F.col(source) == broad)


def phase2(rows: DataFrame, parts: list[str], source: str = "source", key: str = "row_id", broad: str | None = None, fraction: float = FRACTION) -> DataFrame:
    """Rows of ``parts`` with ``part`` (their place); with ``broad``, also its first rows, as many as ``fraction`` of the others.

    The cut id of the mixed-in rows is found from counts of id ranges, so no source is sorted in one task.
    """
    chosen = None
    for k, name in enumerate(parts):
        one = rows.where(F.col(source) == name).withColumn("part", F.lit(k))
        chosen = one if chosen is None else chosen.unionByName(one)
    if broad is None:
        return chosen
    n = int(chosen.count() * fraction)
    return chosen.unionByName(first_rows(rows.where(F.col(source) == broad), n, key).withColumn("part", F.lit(len(parts))))


def first_rows(rows: DataFrame, n: int, key: str = "row_id", ranges: int = 1024) -> DataFrame:
    """The ``n`` rows of the smallest ids (ids are unique)."""
    low, high, total = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if n <= 0 or not total:
        return rows.limit(0)
    while n < total and high > low:
        width = max(1, -(-(high - low + 1) // ranges))
        part = F.floor((F.col(key) - low) / width)
        counts = rows.where(F.col(key).between(low, high)).groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()  # at most ``ranges`` rows
        seen = 0
        for r in counts:
            if seen + r.n >= n:
                break
            seen += r.n
        low, high, n, total = low + r.p * width, min(high, low + (r.p + 1) * width - 1), n - seen, r.n
    return rows.where(F.col(key) <= high)


def counts(rows: DataFrame, source: str = "source") -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(source), F.lit("unknown")).alias("source")).agg(F.count(F.lit(1)).alias("rows"))


def as_yaml(phases: dict[str, dict[str, int]], notes: list[str]) -> str:
    lines = []
    for name, sources in phases.items():
        lines += [f"{name}:", f"  rows: {sum(sources.values())}", "  sources:", *[f"    {s}: {n}" for s, n in sources.items()]]
    return "\n".join([*lines, "notes:", *[f"  - {x}" for x in notes], ""])
