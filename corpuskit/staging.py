"""Tables written to the folder that all executors share, and read back: cuts lineage and survives lost executors."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API on the driver."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; where that is unset and all runs on one machine, below a temporary folder."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            base = f"file://{tempfile.mkdtemp(prefix='corpuskit-')}"
        _roots[app] = f"{base.rstrip('/')}/corpuskit-core-{uuid.uuid4().hex[:8]}"
        atexit.register(_clean, spark, _roots[app])
    return f"{_roots[app]}/{name}-{uuid.uuid4().hex[:10]}"


def _clean(spark: SparkSession, path: str) -> None:
    try:
        fs, p = hadoop_path(spark, path)
        fs.delete(p, True)
    except Exception:  # the session may have ended before
        pass


def staged(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
