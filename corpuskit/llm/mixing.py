"""Mixing sources to target weights by hierarchical budgeting. DataFrame operations only.

*Tree.* Levels (say domain, language, source) form a tree whose leaves hold documents. A leaf can give its tokens ``max_epochs`` times;
a node can give what its leaves can.

*Budgets.* From the root down, a parent's budget is divided among its children in proportion to their weights. A child that cannot use
its share gives the rest to its siblings (water filling); only what a whole family cannot use was never given to it, so shortages move
to siblings before ancestors. Shares are whole tokens; what rounding leaves goes to the largest remainders, ties by name.

*Selection.* In each epoch a leaf's documents stand in the order of a seeded hash. A leaf takes all documents of its full epochs and,
of the next one, the prefix of documents whose tokens reach the budget; the last of them is taken in part (``take_tokens``).
The prefix is found in two steps: the hash range is cut into buckets, whose sums (bounded by leaves x buckets) give the bucket in which
the budget runs out, and only documents of that one bucket are ordered. No step sorts a leaf as a whole, so a leaf with a third of
all rows is spread over many tasks.

Defined results: null texts have no tokens and are never taken; null levels form groups of their own; rows equal in key and tokens are
documents of their own in one place of the order, and if the budget runs out there each gives an even part, rounded up; weights that are missing, or not above 0, count as 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.llm.common import checked_join, staged, unit_hash

#: Rows of a hash bucket, about.
BUCKET_ROWS = 500


def water_fill(nodes: DataFrame) -> DataFrame:
    """Divide ``budget`` of each ``parent`` among its rows by ``weight`` and ``capacity``; adds ``share`` (whole tokens).

    In order of capacity / weight, a child is filled up if filling all from here on to its level stays within what is left.
    """
    by = Window.partitionBy("parent")
    up = by.orderBy(F.col("capacity") / F.col("weight"), "name")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    onward = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    level = F.col("capacity") / F.col("weight") * F.sum("weight").over(onward)
    filled = nodes.withColumn("filled", level <= left)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("filled"), F.col("capacity"))).over(by), F.lit(0))
    open_weight = F.sum(F.when(~F.col("filled"), F.col("weight"))).over(by)
    exact = F.when(F.col("filled"), F.col("capacity").cast("double")).otherwise(rest / open_weight * F.col("weight"))
    floored = filled.withColumn("exact", exact).withColumn("whole", F.least(F.floor("exact"), F.col("capacity")))
    due = F.least(F.col("budget"), F.sum("capacity").over(by)) - F.sum("whole").over(by)
    turn = F.row_number().over(by.orderBy(F.col("whole") < F.col("capacity"), F.col("exact") - F.col("whole"), F.col("name").desc()))
    last = F.count(F.lit(1)).over(by) - turn  # 0 for the largest remainder with room
    share = F.col("whole") + F.when((last < due) & (F.col("whole") < F.col("capacity")), 1).otherwise(0)
    return floored.withColumn("share", share.cast("bigint")).drop("filled", "exact", "whole")


def budgets(leaves: DataFrame, levels: list[str], total: int, weights: dict[str, dict[str, float]]) -> DataFrame:
    """The tokens each leaf gives. ``leaves``: the levels and ``capacity``; ``weights``: level -> name -> weight."""

    def weight(level: str) -> Column:
        table = weights.get(level) or {}
        if not table:
            return F.lit(1.0)
        got = F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, float(v))])[F.coalesce(F.col(level), F.lit(""))]
        return F.when(got > 0, got).otherwise(F.lit(1.0))

    budget = None
    for k, level in enumerate(levels):
        above = levels[:k]
        nodes = leaves.groupBy(*levels[: k + 1]).agg(F.sum("capacity").alias("capacity"))
        path = F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in above])) if above else F.lit("")
        nodes = nodes.withColumn("parent", path).withColumn("name", F.coalesce(F.col(level).cast("string"), F.lit("\u0000"))).withColumn("weight", weight(level))
        if budget is None:
            nodes = nodes.withColumn("budget", F.lit(total).cast("bigint"))
        else:
            same = [F.col(f"n.{c}").eqNullSafe(F.col(f"b.{c}")) for c in above]
            nodes = nodes.alias("n").join(budget.alias("b"), same).select("n.*", F.col("b.share").alias("budget"))
        budget = water_fill(nodes).select(*levels[: k + 1], "share")
    return budget


def mix(
    docs: DataFrame, levels: list[str], tokens: str, total: int | None = None, fraction: float = 0.5, weights: dict[str, dict[str, float]] | None = None,
    max_epochs: int = 2, seed: int = 42, key: str = "doc_id", carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document and epoch that is taken: ``key``, the levels, n_tokens, epoch, take_tokens and the ``carry`` columns.

    ``total`` tokens are asked for, or ``fraction`` of all there are.
    """
    spark = docs.sparkSession
    leaf = unit_hash(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in levels])
    rows = docs.select(F.col(key), *levels, F.coalesce(F.col(tokens), F.lit(0)).cast("bigint").alias("n_tokens"), leaf.alias("leaf"), *carry).where("n_tokens > 0")
    rows = staged(rows, "mix-rows")  # tokens are counted once; steps that need no carried column do not read it
    small = rows.drop(*carry)
    counted = small.agg(F.count(F.lit(1)), F.sum("n_tokens")).first()
    n_rows, n_tokens = counted[0], counted[1] or 0
    total = int(n_tokens * fraction) if total is None else total
    buckets = max(1, min(1 << 20, -(-n_rows // BUCKET_ROWS)))

    leaves = small.groupBy("leaf", *levels).agg(F.sum("n_tokens").alias("there"), (F.sum("n_tokens") * max_epochs).alias("capacity"))
    given = budgets(leaves, levels, total, weights or {})
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"g.{c}")) for c in levels]
    plan = leaves.alias("l").join(given.alias("g"), same).select("l.leaf", "l.there", "g.share").withColumn("full", F.floor(F.col("share") / F.col("there"))).withColumn("rest", F.col("share") % F.col("there"))
    plan = staged(plan, "mix-plan")
    n_leaves = plan.count()

    # the epoch that is taken in part: its order, its buckets, and the place where the budget runs out
    spot = lambda: unit_hash(F.lit(seed), F.col("full"), F.col(key), F.col("n_tokens"))
    bucket = lambda h: F.floor(h / F.lit((1 << 62) / buckets)).cast("int")
    partial = checked_join(small.select("leaf", key, "n_tokens"), plan.where("rest > 0").select("leaf", "full", "rest"), ["leaf"], "inner", n_leaves, key).withColumn("h", spot()).withColumn("bucket", bucket(F.col("h")))
    sums = partial.groupBy("leaf", "rest", "bucket").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("leaf").orderBy("bucket"))
    edge = sums.withColumn("upto", upto).where("upto >= rest and upto - n < rest").select("leaf", F.col("bucket").alias("cut"), (F.col("upto") - F.col("n")).alias("used"))
    edge = staged(edge, "mix-edge")
    in_edge = checked_join(partial.withColumn("cut", F.col("bucket")), edge, ["leaf", "cut"], "inner", n_leaves, key)
    places = in_edge.groupBy("leaf", "cut", "used", "rest", "h", key, "n_tokens").agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("leaf", "cut").orderBy("h", key, "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.col("n_tokens") * F.col("copies")
    run = places.withColumn("upto", F.col("used") + F.sum(here).over(order)).where((F.col("upto") >= F.col("rest")) & (F.col("upto") - here < F.col("rest")))
    part = F.ceil((F.col("rest") - F.col("upto") + here) / F.col("copies")).cast("bigint")
    stop = run.select("leaf", F.col("h").alias("stop_h"), F.col(key).alias("stop_key"), F.col("n_tokens").alias("stop_n"), part.alias("last_take"))
    stop = stop.groupBy("leaf").agg(*[F.min_by(c, "stop_h").alias(c) for c in ("stop_key", "stop_n", "last_take")], F.min("stop_h").alias("stop_h"))
    deal = staged(plan.join(stop, "leaf", "left"), "mix-deal")

    taken = checked_join(rows, deal, ["leaf"], "inner", n_leaves, key)
    here = F.struct(spot(), F.col(key), F.col("n_tokens"))
    there = F.struct("stop_h", "stop_key", "stop_n")
    take_last = F.when(here < there, F.col("n_tokens")).when(here == there, F.col("last_take"))
    epochs = F.concat(
        F.transform(F.when(F.col("full") > 0, F.sequence(F.lit(0), F.col("full") - 1)).otherwise(F.array().cast("array<bigint>")), lambda e: F.struct(e.alias("epoch"), F.col("n_tokens").alias("take"))),
        F.when((F.col("rest") > 0) & take_last.isNotNull(), F.array(F.struct(F.col("full").alias("epoch"), take_last.alias("take")))).otherwise(F.array().cast("array<struct<epoch:bigint,take:bigint>>")),
    )
    return taken.withColumn("e", F.explode(epochs)).select(key, *levels, "n_tokens", F.col("e.epoch").alias("epoch"), F.col("e.take").alias("take_tokens"), *carry)


#: Target weights of the registered query and the pipeline: shares of each domain, and of languages within a domain.
WEIGHTS = {"domain": {"web": 3.0, "books": 1.0, "code": 1.0, "forum": 1.0}, "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}}
LEVELS = ["domain", "lang", "source"]


def with_levels(docs: DataFrame, domains: dict[str, str] | None = None) -> DataFrame:
    """Adds ``domain`` and ``n_tokens`` (words).

    ``domains`` maps sources to domains; a source that it lacks has none. Without it a rule on the source's name stands in, as
    ``documents`` has no domains of its own.
    """
    names = F.array(*[F.lit(x) for x in ("web", "books", "code", "forum")])
    domain = F.when(F.col("source").isNotNull(), F.element_at(names, (F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(4)) + 1).cast("int")))
    if domains is not None:
        pairs = [F.lit(x) for pair in domains.items() for x in pair]
        domain = F.create_map(*pairs)[F.col("source")] if pairs else F.lit(None).cast("string")
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    return docs.withColumn("domain", domain).withColumn("n_tokens", words)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_levels(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "text"))
    return mix(docs, LEVELS, "n_tokens", fraction=0.5, weights=WEIGHTS, max_epochs=2, seed=42)
