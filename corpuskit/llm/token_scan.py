"""Token counts by scanning flat token files for separators.

A token file is a plain run of little-endian token ids without header or index; every document ends with the end-of-document id. The
scan cuts files into blocks of ``BLOCK_BYTES``, whatever documents they hold, finds the separators of a block with one vector
comparison, and stitches blocks with a prefix scan: the running number of separators gives a block's first document, the running
position of the last separator gives where that document began. A document that spans any number of blocks needs no special case.

:func:`write_token_files` makes such files from documents with a public tokenizer. Files are written under a task's own name and then
moved into place, so a repeated task replaces its file by the same bytes. ``WAVES`` bounds the disk that the registered query holds:
files of one wave are scanned and deleted before the next is written.

Defined results: null texts are documents without tokens; tokens behind a file's last separator form an unterminated document; bytes
that do not fill an id at a file's end are ignored; empty files and folders hold no documents; repeated rows are documents of their own.
"""

from __future__ import annotations

import re
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.llm.common import as_list, make_dir, new_path, remove, slices, staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50_256
#: Split pattern of the byte-level BPE vocabulary above; a fixed value of that public tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_BYTES = 4 << 20
WAVES = 2


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end: int = END, dtype: str = "<u2", key: str = "doc_id") -> DataFrame:
    """Write a file per partition; gives (file, ordinal, key) in file order, without any offset."""
    schema = f"file string, ordinal bigint, `{key}` bigint"

    def run(batches):
        from pyspark import TaskContext

        encode = tokenizer(vocabulary).encode_ordinary
        fs, root = _open_fs(folder)
        fs.create_dir(root, recursive=True)
        name, part, n = f"{TaskContext.get().partitionId():06d}.bin", f"{root}/_part-{uuid.uuid4().hex}", 0
        with fs.open_output_stream(part) as out:
            for batch in batches:
                for piece in slices(batch, "text"):
                    for t in as_list(piece.column(1), True):
                        ids = encode((t or b"").decode("utf-8", "replace"))
                        ids.append(end)
                        out.write(np.array(ids, dtype).tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([name] * piece.num_rows, pa.string()), pa.array(range(n, n + piece.num_rows), pa.int64()), piece.column(0)], ["file", "ordinal", key])
                    n += piece.num_rows
        fs.move(part, f"{root}/{name}")

    return docs.select(F.col(key).cast("bigint").alias(key), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def scan_token_files(spark: SparkSession, folder: str, end: int = END, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, ordinal, start, n_tokens, terminated) of every document in the ``*.bin`` files of a folder; positions count tokens."""
    width = np.dtype(dtype).itemsize
    step = max(1, block_bytes // width)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", F.floor(F.col("length") / width).cast("bigint").alias("size"))
    blocks = files.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / step))).alias("block"))

    def run(batches):
        for batch in batches:
            found, counts = [], []
            for path, block in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                fs, place = _open_fs(path)
                with fs.open_input_file(place) as f:
                    f.seek(block * step * width)
                    raw = f.read(step * width)
                ids = np.frombuffer(raw, dtype, len(raw) // width)
                found.append(np.flatnonzero(ids == end) + block * step)
                counts.append(len(ids))
            offsets = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))], ["path", "size", "block", "ends"]
            )

    ends = staged(blocks.repartition("path", "block").mapInArrow(run, "path string, size bigint, block bigint, ends array<bigint>"), "separators")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_file = Window.partitionBy("path")
    # the prefix scan runs over one short row per block
    marks = ends.select("path", "size", "block", F.size("ends").cast("bigint").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    marks = marks.select(
        "path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carry"),
        F.sum("n").over(per_file).alias("total"), F.coalesce(F.max("last").over(per_file), F.lit(-1)).alias("final"), "size", (F.col("block") == F.max("block").over(per_file)).alias("tail"),
    )
    stitched = ends.select("path", "block", "ends").join(marks, ["path", "block"])
    rows = stitched.select("path", "first", "carry", "ends", F.posexplode("ends").alias("i", "at"))
    begin = F.when(F.col("i") == 0, F.col("carry")).otherwise(F.element_at("ends", F.greatest(F.col("i"), F.lit(1)))) + 1
    done = rows.select("path", (F.col("first") + F.col("i")).alias("ordinal"), begin.alias("start"), (F.col("at") - begin).alias("n_tokens"), F.lit(True).alias("terminated"))
    left = marks.where(F.col("tail") & (F.col("final") + 1 < F.col("size"))).select("path", F.col("total").alias("ordinal"), (F.col("final") + 1).alias("start"), (F.col("size") - F.col("final") - 1).alias("n_tokens"), F.lit(False).alias("terminated"))
    return done.unionByName(left).select(F.element_at(F.split("path", "/"), -1).alias("file"), "ordinal", "start", "n_tokens", "terminated")


def count_tokens(docs: DataFrame, key: str = "doc_id", waves: int = WAVES) -> DataFrame:
    """(key, wave, file, ordinal, start, n_tokens) of all documents, by way of flat token files in the shared folder."""
    spark, out = docs.sparkSession, None
    for wave in range(waves):
        folder = new_path(spark, "tokens")
        make_dir(spark, folder)  # a table without partitions writes no file
        order = staged(write_token_files(docs.where(F.pmod(F.xxhash64(key), F.lit(waves)) == wave), folder, key=key), "token-order")
        counted = scan_token_files(spark, folder).join(order, ["file", "ordinal"])
        counted = staged(counted.select(key, F.lit(wave).alias("wave"), "file", "ordinal", "start", "n_tokens"), "token-counts")
        remove(spark, folder)
        out = counted if out is None else out.unionByName(counted)
    return out


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
