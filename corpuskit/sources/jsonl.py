"""JSON lines and JSON files with stable row ids, as plain text scans parsed by built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from corpuskit.staging import exists, hadoop_path


def with_row_ids(rows: DataFrame, name: str = "row_id") -> DataFrame:
    """Number rows from 0 in scan order. Partition sizes are counted once; what reaches the driver is one number per partition."""
    mark = rows.withColumn("_m", F.monotonically_increasing_id())
    part = F.shiftrightunsigned("_m", 33).cast("int")
    sizes = mark.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    offsets, at = [], 0
    for r in sizes:
        offsets.append((r.p, at))
        at += r.n
    table = rows.sparkSession.createDataFrame(offsets, "_p int, _at bigint")  # a row per partition
    numbered = mark.withColumn("_p", part).join(F.broadcast(table), "_p")
    return numbered.withColumn(name, F.col("_at") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m", "_p", "_at")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(row_id, value): every line, blank and broken ones too; several files are numbered in the order given."""
    paths = [paths] if isinstance(paths, str) else paths
    out, start = None, 0
    for k, p in enumerate(paths, 1):
        one = with_row_ids(spark.read.text(p))
        if start:
            one = one.withColumn("row_id", F.col("row_id") + start)
        if k < len(paths):
            start += spark.read.text(p).count()
        out = one if out is None else out.unionByName(one)
    return out.select("row_id", "value")


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str, mode: str = "skip", max_rows: int | None = None, keep_line: bool = False) -> DataFrame:
    """(row_id, the schema's columns) of the lines that are not blank.

    ``mode``: ``skip`` leaves broken lines out, ``count`` keeps them with ``parse_failed`` set, ``fail`` raises on the first one.
    Missing files are left out; ``max_rows`` counts lines by their id, so the order holds.
    """
    paths = existing(spark, [paths] if isinstance(paths, str) else paths)
    if not paths:
        return spark.createDataFrame([], f"row_id bigint, {schema}" + (", parse_failed boolean" if mode == "count" else "") + (", value string" if keep_line else ""))
    lines = read_lines(spark, paths).where(F.trim(F.regexp_replace("value", r"(?U)\s+", " ")) != "")
    lines = lines.where(F.col("row_id") < max_rows) if max_rows is not None else lines
    if mode == "fail":
        parsed = lines.withColumn("j", F.from_json("value", schema, {"mode": "FAILFAST"}))
    else:
        good = F.try_parse_json("value").isNotNull()
        parsed = lines.withColumn("parse_failed", ~good).withColumn("j", F.from_json(F.when(good, F.col("value")), schema))
    parsed = parsed.where(~F.col("parse_failed")) if mode == "skip" else parsed
    extra = (["parse_failed"] if mode == "count" else []) + (["value"] if keep_line else [])
    return parsed.select("row_id", "j.*", *extra)


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    return [p for p in paths if exists(spark, p)]


def count_rows(spark: SparkSession, path: str) -> int:
    """Lines that are not blank."""
    return spark.read.text(path).where(F.trim("value") != "").count()


def read_splits(spark: SparkSession, files: dict[tuple[str, str], str], schema: str) -> DataFrame:
    """One file per (config, split), united, with both as columns; missing files are left out."""
    parts = [read_jsonl(spark, p, schema).withColumn("source_config", F.lit(c)).withColumn("split", F.lit(s)) for (c, s), p in files.items() if exists(spark, p)]
    return reduce(DataFrame.unionByName, parts)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def matching(rows: DataFrame, pattern: str, max_rows: int | None = None, fallback: bool = False) -> DataFrame:
    """Rows of which any string column matches; the cap counts scanned rows. With ``fallback``, all of them if none does."""
    scanned = rows.where(F.col("row_id") < max_rows) if max_rows is not None else rows
    found = scanned.where(F.exists(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in string_columns(rows)]), lambda x: x.rlike(pattern)))
    return scanned if fallback and found.isEmpty() else found


def record_texts(schema: StructType) -> Column:
    """All texts of a record without empty ones: strings, arrays of strings, and those of structs and maps one level down."""

    def of(c: Column, kind, depth: int) -> list[Column]:
        if isinstance(kind, StringType):
            return [F.array(c)]
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
            return [c]
        if isinstance(kind, MapType) and isinstance(kind.valueType, StringType) and depth:
            return [F.map_values(c)]
        if isinstance(kind, StructType) and depth:
            return [x for f in kind.fields for x in of(c[f.name], f.dataType, depth - 1)]
        return []

    parts = [F.coalesce(x, F.array().cast("array<string>")) for f in schema.fields for x in of(F.col(f.name), f.dataType, 1)]
    return F.filter(F.concat(F.array().cast("array<string>"), *parts), lambda t: t.isNotNull() & (t != ""))


def read_texts(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    """(benchmark, text) of local JSON and JSON-lines files."""
    parts = []
    for p in existing(spark, paths):
        rows = spark.read.json(p, multiLine=not p.endswith(".jsonl"))
        parts.append(rows.select(F.lit(name).alias("benchmark"), F.explode(record_texts(rows.schema)).alias("text")))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "benchmark string, text string")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON file; no rows if it is missing."""
    return spark.read.schema(schema).json(path, multiLine=True) if exists(spark, path) else spark.createDataFrame([], schema)


def read_yaml(path: str) -> dict:
    """A small configuration file, on the driver."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("PyYAML is not installed") from e
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def list_dirs(spark: SparkSession, root: str) -> list[str]:
    fs, p = hadoop_path(spark, root)
    return sorted(str(s.getPath()) for s in fs.listStatus(p) if s.isDirectory())
