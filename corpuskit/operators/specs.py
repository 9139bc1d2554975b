"""Specifications of evaluation runs: a benchmark, its arguments, a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVERY = "all"


def spec(benchmark: Column, arguments: Column, model: Column) -> Column:
    """``name:arg=value,model=m``; without arguments ``name:model=m``."""
    return F.concat(benchmark, F.lit(":"), F.concat_ws(",", F.nullif(arguments, F.lit("")), F.concat(F.lit("model="), model)))


def expanded(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """(benchmark, arguments, model, place, spec) of every run to start.

    ``entries``: benchmark, argument, value, model. ``parts``: benchmark, argument, place, part, and run_name, the name that the evaluator
    gives the benchmark (null: its own). A value ``all`` stands for each of the parts that are listed for the argument, in their order;
    where none are listed it is passed on as it is.
    """
    names = parts.groupBy("benchmark").agg(F.max("run_name").alias("run_name"))
    whole = entries.where(F.col("value") == EVERY).join(parts.select("benchmark", "argument", "place", "part"), ["benchmark", "argument"], "left")
    whole = whole.withColumn("value", F.coalesce("part", "value")).drop("part")
    single = entries.where(~F.coalesce(F.col("value") == EVERY, F.lit(False))).withColumn("place", F.lit(None).cast("int"))
    rows = whole.select(*single.columns).unionByName(single).join(F.broadcast(names), "benchmark", "left")
    arguments = F.when(F.col("argument").isNotNull(), F.concat("argument", F.lit("="), "value"))
    name = F.coalesce("run_name", "benchmark")
    return rows.select("benchmark", arguments.alias("arguments"), "model", F.coalesce("place", F.lit(0)).alias("place"), spec(name, arguments, F.col("model")).alias("spec"))
