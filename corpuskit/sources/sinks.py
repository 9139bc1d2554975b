"""Sinks: JSON lines, verbatim lines, reports, slices, keyed overwrites, appended evaluation tables."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.staging import exists, hadoop_path, staged


def write_jsonl(rows: DataFrame, path: str, order: str | None = "row_id", one_file: bool = False) -> None:
    """UTF-8 JSON lines. Files follow each other in the order of ``order``; ``one_file`` is for small results."""
    out = rows.repartitionByRange(order).sortWithinPartitions(order) if order else rows
    (out.coalesce(1) if one_file else out).write.mode("overwrite").json(path)


def write_lines(rows: DataFrame, path: str, line: str = "value") -> None:
    """The lines as they were read, in order."""
    rows.repartitionByRange("row_id").sortWithinPartitions("row_id").select(line).write.mode("overwrite").text(path)


def nested(frames: dict[str, DataFrame]) -> dict:
    """Small result tables as one nested document, on the driver. A single row becomes an object, others a list."""
    out = {}
    for name, df in frames.items():
        rows = [r.asDict(recursive=True) for r in df.collect()]
        out[name] = rows[0] if len(rows) == 1 else rows
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, through the file system of its path."""
    fs, p = hadoop_path(spark, path)
    with_stream = fs.create(p, True)
    try:
        with_stream.write(bytearray(text.encode("utf-8")))
    finally:
        with_stream.close()


def write_report(spark: SparkSession, path: str, document: dict) -> None:
    write_text(spark, path, json.dumps(document, ensure_ascii=False, indent=2, default=str))


def write_slices(sample: DataFrame, path: str, slice_column: str = "stratum") -> None:
    """A folder per slice, and ``index`` beside them."""
    from corpuskit.operators.sampling import slice_index

    kept = staged(sample, "slices")
    kept.withColumn("slice", F.col(slice_column)).drop(slice_column).write.mode("overwrite").partitionBy("slice").json(f"{path}/slices")
    slice_index(kept.withColumn("stratum", F.col(slice_column))).write.mode("overwrite").json(f"{path}/index")


def band_name(label: str) -> str:
    """A file name for a similarity band."""
    return "band_" + re.sub(r"[^0-9A-Za-z._-]", "", label.replace("+", "plus").replace(">=", "from"))


def write_bands(rows: DataFrame, path: str) -> None:
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("band", ">=", "from"), r"\+", "plus"), "[^0-9A-Za-z._-]", "")
    rows.withColumn("file", F.concat(F.lit("band_"), plain)).write.mode("overwrite").partitionBy("file").json(path)


def upsert(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Stored rows, those of the new keys replaced."""
    return stored.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def append_run(run_rows: DataFrame, sample_rows: DataFrame, runs_path: str, samples_path: str) -> None:
    """Samples first, then their runs: a run is visible only once its samples are, and a broken import leaves no run behind."""
    sample_rows.write.mode("append").parquet(samples_path)
    run_rows.write.mode("append").parquet(runs_path)


def rewrite(spark: SparkSession, path: str, change) -> None:
    """Replace the table at ``path`` by ``change`` of it. The new table is written beside it first, so a failure leaves the old one."""
    fs, old = hadoop_path(spark, path)
    if not fs.exists(old):
        return
    _, new = hadoop_path(spark, f"{path.rstrip('/')}-new")
    change(spark.read.parquet(path)).write.mode("overwrite").parquet(new.toString())
    fs.delete(old, True)
    fs.rename(new, old)


def drop_runs(spark: SparkSession, run_dirs: DataFrame, runs_path: str, samples_path: str) -> None:
    """Delete runs and their samples, the runs first: no stored run is ever without its samples."""
    for path in (runs_path, samples_path):
        rewrite(spark, path, lambda rows: rows.join(run_dirs.select("run_dir").distinct(), "run_dir", "left_anti"))


def drop_orphans(spark: SparkSession, runs_path: str, samples_path: str) -> None:
    """Delete samples whose run was never stored, as a broken import leaves them."""
    runs = spark.read.parquet(runs_path).select("run_dir").distinct()
    rewrite(spark, samples_path, lambda rows: rows.join(runs, "run_dir", "left_semi"))


def update_runs(spark: SparkSession, changed: DataFrame, runs_path: str) -> None:
    """Set the columns of ``changed`` (run_dir and others) in the stored runs of the same directories."""
    names = [c for c in changed.columns if c != "run_dir"]
    new = changed.select("run_dir", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in names])

    def change(rows: DataFrame) -> DataFrame:
        joined = rows.join(new, "run_dir", "left")
        return joined.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in names else c for c in rows.columns])

    rewrite(spark, runs_path, change)


def write_jdbc(rows: DataFrame, url: str, table: str, batch: int = 500, **options) -> None:
    """Append over JDBC in batches, where a driver is on the class path."""
    rows.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch, **options).mode("append").save()


def resume_embeddings(rows: DataFrame, provider, path: str, text: str = "text", key: str = "row_id") -> DataFrame:
    """Embed what is not in the table at ``path`` yet, append it, and read all of it."""
    from corpuskit.operators.vectors import embed

    spark = rows.sparkSession
    done = spark.read.parquet(path) if exists(spark, path) else None
    embed(rows, provider, text, key, done=done).write.mode("append").parquet(path)
    return spark.read.parquet(path)
