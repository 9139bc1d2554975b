"""Shared plumbing of the operators in this subpackage: Arrow mapping, staged tables, size-checked joins."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it was counted and holds at most this many rows of a few short columns.
BROADCAST_ROWS = 20_000
#: Text bytes that a Python worker works on at a time.
SLICE_BYTES = 8 << 20

_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application below ``spark.checkpoint.dir``, which all executors see.

    Only where that setting is absent and all runs on one machine (tests) is a temporary folder used; a cluster without it is an error.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            base = f"file://{tempfile.mkdtemp(prefix='corpuskit-')}"
        _roots[app] = root = f"{base.rstrip('/')}/corpuskit-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove_quietly, spark, root)
    return _roots[app]


def _remove_quietly(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session may have ended already
        pass


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system API."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def make_dir(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and survives the loss of executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._corpuskit_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete a table made by :func:`staged` that no later plan reads."""
    path = getattr(df, "_corpuskit_path", None)
    if path:
        remove(df.sparkSession, path)


def arrow_map(
    df: DataFrame, schema: str, fn: Callable[[list[dict[str, list]]], Iterator[dict[str, list]]] | Callable, text: str = "text"
) -> DataFrame:
    """Map slices of bounded text size through ``fn(columns) -> columns``.

    ``columns`` maps names to Python lists; column ``text`` arrives as UTF-8 bytes (or None). A single text longer than the slice
    size forms a slice alone.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out_schema = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                made = fn({n: as_list(part.column(i), n == text) for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in out_schema], schema=out_schema)

    return df.mapInArrow(run, schema)


def arrow_extend(df: DataFrame, schema: str, fn: Callable[[list], dict[str, list]], text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Add the columns of ``schema`` that ``fn(texts as bytes)`` computes; the ``keep`` columns pass through as Arrow data, whatever their types."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    source = df.select(*keep, F.col(text).cast("string").alias("_text"))
    new = to_arrow_schema(_parse_datatype_string(schema))
    whole = StructType([*df.select(*keep).schema.fields, *_parse_datatype_string(schema).fields])
    n = len(keep)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                made = fn(as_list(part.column(n), True))
                columns = [part.column(k) for k in range(n)] + [pa.array(made[f.name], type=f.type) for f in new]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *new.names])

    return source.mapInArrow(run, whole)


def as_list(column: pa.Array, raw: bool) -> list:
    if not raw:
        return column.to_pylist()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the bytes of ``text`` reach ``most``."""
    import pyarrow.compute as pc

    i = batch.schema.get_field_index(text)
    if i < 0 or not batch.num_rows:
        yield batch
        return
    begin = size = 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(i)), 0).to_pylist()):
        if size and size + n > most:
            yield batch.slice(begin, k - begin)
            begin, size = k, 0
        size += n
    yield batch.slice(begin)


_SPACE = re.compile(rb"[\x09-\x0d\x20]")


def space_pieces(data: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """Cut at white space into pieces of about ``most`` bytes, so that lists of words stay short however long a text is."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + most) if at + most < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def one_spaced(data: bytes) -> bytes:
    """The words of ``data`` with single spaces between them."""
    return b" ".join(line for line in (b" ".join(p.split()) for p in space_pieces(data)) if line)


def checked_join(left: DataFrame, right: DataFrame, on: list[str], how: str, rows: int, salt_by: Column | str, salts: int = 16) -> DataFrame:
    """Join a large ``left`` that may hold hot keys with a ``right`` of ``rows`` rows that was counted before.

    Up to ``BROADCAST_ROWS`` the right side is broadcast. Beyond, the left side is spread over ``salts`` by the hash of
    ``salt_by`` (so that a repeated task deals rows alike) and the right side is repeated for each salt: a hot key goes to many tasks.
    """
    if rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on, how)
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int")).join(salted, [*on, "_salt"], how).drop("_salt")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, whatever their names."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def unit_hash(*cols: Column | str) -> Column:
    """A non-negative 62-bit hash, even over its range."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 2)
