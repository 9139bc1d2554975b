"""SimHash near-duplicates with bit-sliced comparison.

*Fingerprints.* A text's words (A-Z lowered) form shingles of four; a bit of the 64-bit fingerprint is set if it is set in over half of
the shingles' XXH64 values.

*Candidates.* Only distinct fingerprints are compared, each with its smallest doc_id. Two that differ in at most ``RADIUS`` bits agree
in at least one of ``RADIUS + 1`` blocks of bits, so each fingerprint goes to one bucket per block. A bucket above ``BUCKET_ROWS`` is
dealt again by blocks of its remaining bits, where the same holds, up to ``DEPTH`` times. What is still large then is cut into blocks of
``BUCKET_ROWS``, and each pair of blocks is compared as a bucket of its own; nothing is capped, and no task holds more than two blocks.

*Comparison.* In a bucket the fingerprints are stored vertically: one bit plane per bit, 64 fingerprints to a word. A fingerprint is
compared with whole words at once: the planes are added into carry-save counters (ones, twos, fours, and a flag for more), and a word
is abandoned once all its lanes exceed the radius. A bucket only gives the edges of a spanning forest of its links, which keeps every
component and is linear in its size.

Defined results: null and empty texts have fingerprint zero and are linked like any other; rows of one doc_id are one document; a null
doc_id is never a component_id (a component of nulls alone has a null one); repeated rows each give a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.common import arrow_extend, drop_staged, one_spaced, staged
from corpuskit.llm.components import components

SHINGLE = 4
RADIUS = 4
BUCKET_ROWS = 4_096
DEPTH = 4
SEED = 42
#: Shingles of a text that are hashed at a time.
CHUNK = 1 << 14
_ALL = (1 << 64) - 1


def fingerprint(text: bytes | None) -> int:
    import xxhash

    line = one_spaced((text or b"").lower())
    if not line:
        return 0
    digest = xxhash.xxh64_intdigest
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    n = len(spaces) + 2 - SHINGLE
    if n <= 1:
        return digest(line, SEED)
    begins, ends = np.concatenate(([0], spaces + 1))[:n], np.append(spaces, len(line))[SHINGLE - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        places = zip(begins[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        values = np.array([digest(line[a:b], SEED) for a, b in places], np.uint64)
        counts += np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n).view(">u8")[0])


def fingerprints(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns and ``fp``, the fingerprint as a signed long."""
    return arrow_extend(docs, "fp bigint", lambda texts: {"fp": np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)}, keep=carry)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(used: int) -> list[int]:
    """The bits outside ``used``, cut into RADIUS + 1 masks."""
    free = [k for k in range(64) if not used >> k & 1]
    cuts = [round(i * len(free) / (RADIUS + 1)) for i in range(RADIUS + 2)]
    return [sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def links(fps: np.ndarray, starts: np.ndarray, radius: int = RADIUS, chunk: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of buckets. ``fps``: uint64, sorted by bucket; ``starts``: first row of each bucket.

    Gives (row, root) for rows linked, directly or not, to a smaller row of their bucket.
    """
    n = len(fps)
    sizes = np.diff(starts, append=n)
    words = -(-sizes // 64)
    first_word = np.cumsum(words) - words
    group = np.repeat(np.arange(len(starts)), sizes)
    inner = np.arange(n) - starts[group]
    word, lane = first_word[group] + inner // 64, inner % 64
    total = int(words.sum())
    planes = np.zeros((64, total), np.uint64)
    bit = np.uint64(1) << lane.astype(np.uint64)
    for k in range(64):
        on = (fps >> np.uint64(k)) & np.uint64(1) == 1
        np.bitwise_or.at(planes[k], word[on], bit[on])
    valid = np.zeros(total, np.uint64)
    np.bitwise_or.at(valid, word, bit)
    base = starts[np.repeat(np.arange(len(starts)), words)] + (np.arange(total) - np.repeat(first_word, words)) * 64

    label = np.arange(n)
    # a row meets the words of its bucket from its own on
    reach = words[group] - inner // 64
    upto = np.cumsum(reach)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + chunk, "right")))
        rows = np.repeat(np.arange(at, end), reach[at:end])
        offset = np.arange(len(rows)) - np.repeat(upto[at:end] - reach[at:end] - (upto[at - 1] if at else 0), reach[at:end])
        _compare(fps, planes, valid, base, rows, word[rows] + offset, label, radius)
        at = end
    row = np.flatnonzero(label != np.arange(n))
    return row, label[row]


def _compare(fps, planes, valid, base, rows, words, label, radius) -> None:
    ones = np.zeros(len(rows), np.uint64)
    twos, fours, over = ones.copy(), ones.copy(), ~valid[words]
    mine = fps[rows]
    for k in range(64):
        d = planes[k][words] ^ -((mine >> np.uint64(k)) & np.uint64(1))
        carry = ones & d
        ones ^= d
        d = twos & carry
        twos ^= carry
        over |= fours & d
        fours ^= d
        if k >= 15 and k % 8 == 7:
            far = over | _beyond(ones, twos, fours, radius)
            live = far != np.uint64(_ALL)
            if not live.all():
                rows, words, mine = rows[live], words[live], mine[live]
                ones, twos, fours, over = ones[live], twos[live], fours[live], over[live]
                if not len(rows):
                    return
    near = ~(over | _beyond(ones, twos, fours, radius))
    hit = np.flatnonzero(near)
    if not len(hit):
        return
    lanes = np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    i, lane = np.nonzero(lanes)
    a, b = rows[hit[i]], base[words[hit[i]]] + lane
    _union(label, a, b)


def _beyond(ones, twos, fours, radius):
    """Lanes whose count (0 to 7) is above ``radius``."""
    out = np.zeros_like(ones)
    for count in range(radius + 1, 8):
        out |= (ones if count & 1 else ~ones) & (twos if count & 2 else ~twos) & (fours if count & 4 else ~fours)
    return out


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; ``label`` leads every row to the smallest row of its set."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _bucket_edges(batches):
    """Rows (bucket, fp, rep), whole buckets in sorted order -> edges between representatives."""
    held: list[pa.RecordBatch] = []

    def flush(table: pa.Table):
        bucket, fp, rep = (table.column(c).to_numpy() for c in ("bucket", "fp", "rep"))
        starts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1 if len(bucket) else 0))
        row, root = links(fp.view(np.uint64), starts)
        return pa.RecordBatch.from_arrays([pa.array(rep[row]), pa.array(rep[root])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        if table.num_rows >= 1 << 16:
            bucket = table.column("bucket").to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1], "left"))  # the last bucket may go on
            if cut:
                yield flush(table.slice(0, cut).combine_chunks())
            held = table.slice(cut).to_batches()
    if held:
        yield flush(pa.Table.from_batches(held).combine_chunks())


def _cells(rows: DataFrame) -> DataFrame:
    """Large buckets (with their size ``n``) as smaller ones: a bucket for each pair of its blocks."""
    blocks = F.ceil(F.col("n") / BUCKET_ROWS).cast("int")
    part = rows.select("bucket", "fp", "rep", blocks.alias("blocks"), F.pmod(F.xxhash64("fp", F.lit(9)), blocks.cast("bigint")).cast("int").alias("part"))
    pairs = part.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.select(F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")).alias("bucket"), "fp", "rep")


def near_edges(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between ``rep`` values that connect the same components as all links within RADIUS. ``nodes``: distinct fp, rep.

    The edges are written; the buckets they come from are deleted.
    """
    rows = nodes.select("fp", "rep", F.lit(0).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("used"))
    known, found, used = [0], None, []
    for depth in range(DEPTH):
        masks = F.create_map(*[x for u in known for x in (F.lit(_signed(u)).cast("bigint"), F.array(*[F.lit(_signed(m)).cast("bigint") for m in _blocks(u)]))])
        dealt = rows.withColumn("mask", F.explode(masks[F.col("used")]))
        dealt = dealt.select(
            "fp", "rep", F.xxhash64("bucket", "mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("bucket"), F.col("used").bitwiseOR(F.col("mask")).alias("used")
        )
        last = depth == DEPTH - 1
        dealt = staged(dealt, "buckets")
        used.append(dealt)
        hot = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS)
        hot = staged(hot, "hot-buckets")
        n_hot = hot.count()
        cold = dealt.select("bucket", "fp", "rep")
        if n_hot:  # there are at most rows / BUCKET_ROWS of them, two longs each
            hot = F.broadcast(hot) if n_hot <= 100_000 else hot
            cold = cold.join(hot, "bucket", "left_anti")
            rows = dealt.join(hot, "bucket")
            if last:
                cold = cold.unionByName(_cells(rows))
        cold = cold.repartition("bucket").sortWithinPartitions("bucket", "fp")
        edges = cold.mapInArrow(_bucket_edges, "a bigint, b bigint")
        found = edges if found is None else found.unionByName(edges)
        if last or not n_hot:
            break
        known = sorted({u | m for u in known for m in _blocks(u)})
    found = staged(found, "links")
    for table in used:
        drop_staged(table)
    return found


def near_groups(prints: DataFrame) -> DataFrame:
    """(doc_id, fp) -> (fp, group) for every distinct fingerprint; group is the smallest doc_id, or 2^62 and more if all are null."""
    # documents without an id stand above all ids; fingerprints that share such a place differ in two bits at most, so they are linked
    nameless = F.shiftrightunsigned("fp", 2).bitwiseOR(F.lit(1 << 62).cast("bigint"))
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")).withColumn("rep", F.coalesce("rep", nameless)), "fingerprints")
    labels = components(near_edges(nodes))
    return nodes.join(labels, nodes.rep == labels.node, "left").select("fp", F.coalesce("label", "rep").alias("group"))


def near_duplicates(prints: DataFrame) -> DataFrame:
    """(doc_id, fp) -> (fp, component_id) for every distinct fingerprint."""
    return near_groups(prints).select("fp", F.when(F.col("group") < F.lit(1 << 62), F.col("group")).alias("component_id"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = staged(fingerprints(docs), "doc-fingerprints")
    groups = near_duplicates(prints)
    # copies share a fingerprint: the large side may be hot, the other has one row for each; adaptive execution splits the former
    return prints.join(groups, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
