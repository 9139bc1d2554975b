"""Best-fit packing under conflicts.

Items (documents, or the pieces of documents longer than a bin) are packed in descending size. A bin's open residual orders it; the
bin also carries two bitmaps: the duplicate clusters it holds, of which it may hold one member each, and the sources that have reached
``max_per_source`` items in it. Best fit asks for the tightest bin whose residual suffices; the successor search goes on from there
until both bitmaps allow the item, and opens a bin if none does.

*Distribution.* Items are dealt to shards of about ``SHARD_ITEMS`` by a hash of their row and piece, whatever their source, cluster or
doc_id, so a hot source, repeated rows, a large group of copies or one huge text is spread evenly; each shard is packed alone. Members of a cluster in different shards cannot meet
in a bin, so the constraint holds everywhere. The cost of sharding is at most one badly filled tail of bins in each shard.

Defined results: null texts are items of size 0 and null sources or clusters carry no constraint; repeated rows are items of their own;
ties go to the smaller doc_id; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.common import staged

SHARD_ITEMS = 8_000
CAPACITY = 2_048
MAX_PER_SOURCE = 8

OUT = "doc_id bigint, piece bigint, n_tokens bigint, shard bigint, bin bigint, offset bigint"


def pack(items: list[tuple[int, int | None, int | None]], capacity: int, max_per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) for each (size, source bit, cluster bit) of ``items``, which come in descending size; bits are None without constraint.

    Equal neighbours (same size, source and cluster) resume the search where the last of them went: whatever was passed over before
    still holds the same conflicts, and its own bin is looked at again only if it can take another.
    """
    order: list[tuple[int, int]] = []  # (residual, bin)
    full: list[int] = []  # bitmap of sources at their limit, by bin
    clusters: list[int] = []
    counts: list[dict[int, int]] = []
    placed = []
    last, resume = None, (-1, -1)
    for size, source, cluster in items:
        s = 1 << source if source is not None else 0
        c = 1 << cluster if cluster is not None else 0
        at = bisect_left(order, max((size, -1), resume) if (size, source, cluster) == last else (size, -1))
        while at < len(order) and (full[order[at][1]] & s or clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            residual, k = order.pop(at)
        else:
            residual, k = capacity, len(full)
            full.append(0)
            clusters.append(0)
            counts.append({})
        last, resume = (size, source, cluster), (residual, k + 1) if c or residual < 2 * size else (residual - size, k)
        placed.append((k, capacity - residual))
        clusters[k] |= c
        if s:
            counts[k][source] = n = counts[k].get(source, 0) + 1
            if n >= max_per_source:
                full[k] |= s
        insort(order, (residual - size, k))
    return placed


def pack_documents(
    docs: DataFrame, n_tokens: str, source: str, cluster: str, capacity: int = CAPACITY, max_per_source: int = MAX_PER_SOURCE, shard_items: int = SHARD_ITEMS
) -> DataFrame:
    """One row per piece: doc_id, piece, n_tokens, shard, bin (within the shard), offset (within the bin)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.greatest(F.coalesce(F.col(n_tokens), F.lit(0)), F.lit(0)).cast("bigint").alias("size"),
        F.col(source).cast("string").alias("source"), F.col(cluster).cast("string").alias("cluster"), F.monotonically_increasing_id().alias("rid"),
    )
    rows = staged(rows, "items")  # the row numbers are written, so a repeated task deals rows alike
    pieces = F.greatest(F.ceil(F.col("size") / capacity), F.lit(1)).cast("bigint")
    shards = max(1, -(-(rows.agg(F.sum(pieces)).first()[0] or 0) // shard_items))
    items = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)))
    items = items.withColumn("size", F.least(F.lit(capacity).cast("bigint"), F.col("size") - F.col("piece") * capacity))
    items = items.withColumn("shard", F.pmod(F.xxhash64("rid", "piece", F.lit(5)), F.lit(shards))).drop("rid")
    out_schema = to_arrow_schema(_parse_datatype_string(OUT))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("size", "cluster", "source", "doc_id", "piece"))))
        rows.sort(key=lambda r: (-r[0], r[1] or "", r[2] or "", -1 if r[3] is None else r[3], r[4]))
        # pieces of one document conflict with no one: all but the last are as large as a bin
        members = Counter(r[1] for r in rows if r[0] < capacity and r[1] is not None)
        groups = {c: k for k, c in enumerate(c for c, n in members.items() if n > 1)}
        sources: dict[str, int] = {}
        placed = pack([(r[0], None if r[2] is None else sources.setdefault(r[2], len(sources)), groups.get(r[1])) for r in rows], capacity, max_per_source)
        made = {
            "doc_id": [r[3] for r in rows], "piece": [r[4] for r in rows], "n_tokens": [r[0] for r in rows],
            "shard": [key[0].as_py()] * len(rows), "bin": [b for b, _ in placed], "offset": [o for _, o in placed],
        }
        return pa.Table.from_arrays([pa.array(made[f.name], f.type) for f in out_schema], schema=out_schema)

    return items.groupBy("shard").applyInArrow(run, OUT)


def with_keys(docs: DataFrame) -> DataFrame:
    """doc_id, source, token count (words) and duplicate cluster (texts equal but for case and white space) of documents."""
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    same = F.when(F.col("text").isNotNull(), F.xxhash64(F.lower(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))))
    return docs.select("doc_id", "source", words.alias("n_tokens"), same.alias("cluster"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(with_keys(spark.read.parquet(f"{sf_dir}/documents.parquet")), "n_tokens", "source", "cluster")
