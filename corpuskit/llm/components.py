"""Connected components of an edge table by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import drop_staged, staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> (node, label): the smallest node that each node reaches. Nodes without an edge are not listed.

    Each round is written to the shared folder. A node with very many edges is met in two ways only: in an aggregation that combines
    before its shuffle, and on the large side of a sort-merge join whose other side has one row for a node, which adaptive execution
    splits.
    """
    a, b = F.col("a"), F.col("b")
    edges = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = staged(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = staged(both.where(b > a).join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        new = staged(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        drop_staged(large)
        drop_staged(edges)
        edges, before, state = new, state, _state(new)
        if state == before:
            break
    roots = edges.select(b.alias("node")).distinct()
    return edges.select(a.alias("node"), b.alias("label")).unionByName(roots.select("node", F.col("node").alias("label")))
