"""Near copies by exact Jaccard similarity of five-word shingles, proposed by SimHash fingerprints and by MinHash bands.

*Sets.* A text's words (A-Z lowered) form shingles of five, a shorter text is one shingle; two texts are near copies if their sets of
shingles (as XXH64 values) have a Jaccard similarity of at least 0.8, which is counted exactly.

*Proposals.* Of equal texts one is a node. Nodes whose 64-bit SimHash of the same shingles differs in a few bits are proposed by the
bit-sliced comparison of :mod:`corpuskit.llm.simhash`. Two texts of similarity 0.8 differ in about 10 of 64 bits, though, and often in
more, which no radius that leaves usable blocks reaches; so buckets of minima propose what fingerprints miss. A node's ``BANDS * ROWS`` minima give one bucket per band; two texts of similarity 0.8 share
none with a probability of (1 - 0.8^4)^20, below 3 in 100,000. Nothing else is left to chance but ``LIKELY`` (below).

*Links.* Each node of a bucket is first verified against the bucket's leader, which is drawn anew in each bucket, so a large group is
linked by few pairs for a node. Where a bucket then still holds several components, all its pairs across them whose minima
agree in ``LIKELY`` places are verified too (at 0.8, fewer agree once in about 800,000 pairs). Large buckets of that kind are
dealt out as cells, pairs of blocks; a cell only gives links that connect what all of them connect. Nothing is capped.

Defined results: texts without a word are equal; groups are connected by near copies; a null doc_id stands above all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import arrow_extend, drop_staged, one_spaced, staged, whole_row
from corpuskit.llm.components import components
from corpuskit.llm.simhash import near_edges

SHINGLE = 5
BANDS, ROWS = 20, 4
#: Of 80 minima.
LIKELY = 46
BLOCK_ROWS = 256
SEED = 42
#: Shingles of a text that are hashed at a time, and those that meet all hash functions at a time.
CHUNK, STEP = 1 << 14, 1 << 9
_draws = np.random.default_rng(SEED)
_FLIP = _draws.integers(1 << 64, size=BANDS * ROWS, dtype=np.uint64)
_TIMES = _draws.integers(1 << 64, size=BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def line_of(text: bytes | None) -> bytes:
    return one_spaced((text or b"").lower())


def hashes(line: bytes):
    """XXH64 values of the shingles, in chunks."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    n = len(spaces) + 2 - SHINGLE
    if n <= 1:
        yield np.array([digest(line, SEED)], np.uint64)
        return
    begins, ends = np.concatenate(([0], spaces + 1))[:n], np.append(spaces, len(line))[SHINGLE - 1 :]
    for at in range(0, n, CHUNK):
        places = zip(begins[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        yield np.array([digest(line[a:b], SEED) for a, b in places], np.uint64)


def shingles(text: bytes | None) -> np.ndarray:
    return np.unique(np.concatenate([np.unique(v) for v in hashes(line_of(text))]))


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted) have a Jaccard similarity of at least 4/5."""
    small, large = sorted((len(a), len(b)))
    if 5 * small < 4 * large:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * shared >= 4 * (small + large - shared)


def minima(line: bytes) -> tuple[np.ndarray, int]:
    """The least value of every hash function over the shingles, and the SimHash of the shingles, repeats included."""
    low, bits, n = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64), np.zeros(64, np.int64), 0
    for values in hashes(line):
        bits += np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
        n += len(values)
        for at in range(0, len(values), STEP):
            np.minimum(low, ((values[at : at + STEP, None] ^ _FLIP) * _TIMES).min(axis=0), out=low)
    return low, int(np.packbits(2 * bits > n).view(">u8")[0])


def sketches(texts: list) -> dict[str, list]:
    """128 bits of each text, its bucket in each band, a byte of each minimum, and its SimHash."""
    import xxhash

    out = {"h1": [], "h2": [], "buckets": [], "signature": [], "fp": []}
    for text in texts:
        line = line_of(text)
        whole = np.frombuffer(xxhash.xxh3_128_digest(line), np.int64)
        low, fp = minima(line)
        bands = low.astype("<u8").tobytes()
        size = 8 * ROWS
        out["h1"].append(int(whole[0]))
        out["h2"].append(int(whole[1]))
        out["buckets"].append(np.array([xxhash.xxh64_intdigest(bands[k * size : (k + 1) * size], k) for k in range(BANDS)], np.uint64).view(np.int64))
        out["signature"].append(low.astype(np.uint8).tobytes())
        out["fp"].append(fp - (fp >> 63 << 64))
    return out


def _verify(batches):
    """(a, b, text_a, text_b) -> the (a, b) that are near copies."""
    last, held = None, None
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        good = np.zeros(len(a), bool)
        for i in range(len(a)):
            if b[i] != last:
                last, held = b[i], shingles((batch.column(3)[i].as_py() or "").encode())
            good[i] = near(shingles((batch.column(2)[i].as_py() or "").encode()), held)
        yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], ["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are near copies. ``texts``: node, text."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify, "a bigint, b bigint")


def _likely(cell: dict, i: int) -> np.ndarray:
    """Rows of a cell that row i is to be compared with: of its other block, of another label, alike, and not met in an earlier band."""
    part, p, q = cell["part"], cell["p"][0], cell["q"][0]
    if part[i] != p:
        return np.zeros(0, np.int64)
    j = np.flatnonzero((part == q) & (cell["label"] != cell["label"][i]))
    j = j[j > i] if p == q else j
    j = j[(cell["signature"][j] == cell["signature"][i]).sum(axis=1) >= LIKELY]
    same = cell["buckets"][j] == cell["buckets"][i]
    own = cell["buckets"][i] == cell["bucket"][0]
    return j[same.argmax(axis=1) == own.argmax()] if len(j) else j


def _alike(cell: dict) -> np.ndarray:
    """Rows of a cell that are to be compared with any other."""
    out = np.zeros(len(cell["node"]), bool)
    for i in range(len(out)):
        j = _likely(cell, i)
        out[j] = True
        out[i] |= len(j) > 0
    return np.flatnonzero(out)


def _links(cell: dict) -> tuple[list[int], list[int]]:
    """Near copies (a, b) of a cell, as far as they join components that no other pair of the cell has joined."""
    sets = [np.frombuffer(x, np.uint64) for x in cell["shingles"]]
    sizes = np.array([len(x) for x in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(codes.max() + 1, np.int32)
    above: dict[int, int] = {}

    def root(x):
        while x in above:
            x = above[x]
        return x

    a, b = [], []
    for i in range(len(sets)):
        j = _likely(cell, i)
        if not len(j):
            continue
        mine = codes[starts[i] : starts[i] + sizes[i]]
        mark[mine] = 1
        shared = np.add.reduceat(mark[codes], starts)[j]
        mark[mine] = 0
        for k in j[5 * shared >= 4 * (sizes[i] + sizes[j] - shared)].tolist():
            x, y = root(int(cell["label"][i])), root(int(cell["label"][k]))
            if x != y:
                above[max(x, y)] = min(x, y)
                a.append(int(max(cell["node"][i], cell["node"][k])))
                b.append(int(min(cell["node"][i], cell["node"][k])))
    return a, b


def _cells(table: pa.Table):
    """(begin, end, columns) of every cell."""
    columns = {c: table.column(c).to_numpy() for c in ("bucket", "p", "q", "part", "node", "label")}
    columns["signature"] = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
    columns["buckets"] = table.column("buckets").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    if "shingles" in table.column_names:
        columns["shingles"] = table.column("shingles").to_numpy()
    cuts = np.flatnonzero(np.any([np.diff(columns[c]) != 0 for c in ("bucket", "p", "q")], axis=0)) + 1
    for x, y in zip([0, *cuts], [*cuts, table.num_rows]):
        yield x, y, {c: v[x:y] for c, v in columns.items()}


def _by_cell(fn):
    """Map tables of whole cells; batches come sorted by cell."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= 16 << 20:
                table = pa.Table.from_batches(held)
                keys = [table.column(c).to_numpy() for c in ("bucket", "p", "q")]
                other = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))
                cut = int(other[-1]) + 1 if len(other) else 0  # the last cell may go on
                if cut:
                    yield fn(table.slice(0, cut).combine_chunks())
                held = table.slice(cut).to_batches()
                size = sum(x.nbytes for x in held)
        if held:
            yield fn(pa.Table.from_batches(held).combine_chunks())

    return run


def _alike_rows(table: pa.Table) -> pa.RecordBatch:
    rows = np.concatenate([x + _alike(cell) for x, _, cell in _cells(table)])
    whole = table.combine_chunks().to_batches()[0]
    return whole.take(pa.array(rows, pa.int64()))


def _link_rows(table: pa.Table) -> pa.RecordBatch:
    found = [_links(cell) for _, _, cell in _cells(table)]
    a, b = (np.array([x for pair in found for x in pair[k]], np.int64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _shingle_rows(texts: list) -> dict[str, list]:
    return {"shingles": [shingles(t).tobytes() for t in texts]}


def further_links(shared: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Near copies (a, b) across the components that meet in a bucket; they connect what all of them connect.

    ``shared``: bucket, node of buckets of several nodes. Rows are first compared by their minima; only those alike take their sets along.
    """
    named = shared.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    mixed = named.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n")).where("x <> y")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    rows = named.join(mixed.select("bucket", blocks.alias("blocks")), "bucket").withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("bucket", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "node", "label").join(nodes, "node")
    cell = ["bucket", "p", "q"]
    rows = rows.select(*cell, "part", "node", "label", "signature", "buckets").repartition(*cell).sortWithinPartitions(*cell)
    rows = staged(rows.mapInArrow(_by_cell(_alike_rows), rows.schema), "alike")
    sets = arrow_extend(texts.join(rows.select("node").distinct(), "node", "left_semi"), "shingles binary", _shingle_rows, keep=("node",))
    rows = rows.join(staged(sets, "shingle-sets"), "node").select(*rows.columns, "shingles")
    return rows.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(_by_cell(_link_rows), "a bigint, b bigint").distinct()


def near_groups(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, label) of the nodes that have near copies. ``nodes``: node, buckets, signature, fp; ``texts``: node, text."""
    prints = staged(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "prints")
    alike = nodes.select("node", "fp").join(prints, "fp").where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    alike = staged(alike.unionByName(near_edges(prints).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "print-pairs")
    dealt = staged(nodes.select("node", F.explode("buckets").alias("bucket")), "bands")
    mask = F.xxhash64("bucket")
    leaders = dealt.groupBy("bucket").agg(F.min(F.col("node").bitwiseXOR(mask)).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(dealt.join(leaders.select("bucket", F.col("least").bitwiseXOR(mask).alias("leader")), "bucket"), "shared-buckets")
    drop_staged(dealt)
    # the texts of candidates are taken out once, so that joins of pairs never move the others
    proposed = alike.select(F.explode(F.array("a", "b")).alias("node"))
    some = staged(shared.select("node").unionByName(proposed).distinct(), "candidates")
    texts = staged(texts.join(some, "node", "left_semi"), "candidate-texts")
    a, b = F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b")
    first = staged(shared.where("node <> leader").select(a, b).unionByName(alike).distinct(), "leader-pairs")
    edges = staged(verified(first, texts), "near-links")
    labels = staged(components(edges), "near-labels")
    more = staged(further_links(shared.select("bucket", "node"), labels, nodes.drop("fp"), texts), "further-links")
    for table in (shared, texts):
        drop_staged(table)
    if more.isEmpty():
        return labels
    return components(edges.unionByName(more))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, less all but one of each group: the one of the smallest doc_id stays; of rows that share it, the first written.

    Rows are numbered as they are written beside their sketches, so the choice holds whatever happens to later tasks.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), whole_row(docs).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = staged(arrow_extend(rows, "h1 bigint, h2 bigint, buckets array<bigint>, signature binary, fp bigint", sketches, keep=("rid", "row", "doc_id")), "sketched")
    copies = staged(rows.groupBy("h1", "h2").agg(F.min("rid").alias("node")), "distinct-texts")
    nodes = rows.select(F.col("rid").alias("node"), "buckets", "signature", "fp").join(copies.select("node"), "node", "left_semi")
    labels = near_groups(nodes, rows.select(F.col("rid").alias("node"), F.col("row.text").cast("string").alias("text")))
    groups = copies.join(labels, "node", "left").select("h1", "h2", F.coalesce("label", "node").alias("group"))
    order = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.col("rid").alias("rid"))
    kept = rows.select("rid", "doc_id", "h1", "h2").join(groups, ["h1", "h2"]).groupBy("group").agg(F.min(order)["rid"].alias("rid"))
    return rows.join(kept.select("rid"), "rid", "left_semi").select("row.*")
