"""Evaluation run directories: discovery and scans of their four JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.operators import evalstore
from corpuskit.sources.jsonl import list_dirs
from corpuskit.staging import exists

FILES = ("run_spec", "scenario_state", "per_instance_stats", "stats")


def discover(spark: SparkSession, root: str) -> list[str]:
    """Run directories in order, those alone that hold all four files."""
    return [d for d in list_dirs(spark, root) if all(exists(spark, f"{d}/{f}.json") for f in FILES)]


def _read(spark: SparkSession, dirs: list[str], name: str, schema: str) -> DataFrame:
    if not dirs:
        return spark.createDataFrame([], f"run_dir string, {schema}")
    rows = spark.read.schema(schema).json([f"{d}/{name}.json" for d in dirs], multiLine=True)
    return rows.select(F.url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)).alias("run_dir"), *rows.columns)


def specs(spark: SparkSession, dirs: list[str]) -> DataFrame:
    return _read(spark, dirs, "run_spec", evalstore.RUN_SPEC)


def states(spark: SparkSession, dirs: list[str]) -> DataFrame:
    """(run_dir, idx, state): one row per request."""
    return _read(spark, dirs, "scenario_state", evalstore.SCENARIO_STATE).select("run_dir", F.posexplode("request_states").alias("idx", "state"))


def instance_stats(spark: SparkSession, dirs: list[str]) -> DataFrame:
    """(run_dir, instance_id, entry, stats); a file's top-level array gives a row per element."""
    rows = _read(spark, dirs, "per_instance_stats", evalstore.INSTANCE_STATS)
    return rows.withColumn("entry", F.monotonically_increasing_id())


def stats(spark: SparkSession, dirs: list[str]) -> DataFrame:
    """(run_dir, stats): the entries of a file gathered in their order."""
    rows = _read(spark, dirs, "stats", "name struct<name:string>, mean double, sum double").withColumn("at", F.monotonically_increasing_id())
    entries = F.sort_array(F.collect_list(F.struct("at", F.struct("name", "mean", "sum").alias("s"))))
    return rows.groupBy("run_dir").agg(F.transform(entries, lambda e: e["s"]).alias("stats"))


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """(id, run_name) of the run table, by the name in its configuration document; empty if there is no table yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], "id int, run_name string")
    return spark.read.parquet(path).select("id", F.get_json_object("config", f"$.{evalstore.RUN_NAME_KEY}").alias("run_name"))


def stored_runs_jdbc(spark: SparkSession, url: str, table: str = "eval_runs", **options) -> DataFrame:
    """The same over JDBC, where a driver is on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select("id", F.get_json_object(F.col("config").cast("string"), f"$.{evalstore.RUN_NAME_KEY}").alias("run_name"))
