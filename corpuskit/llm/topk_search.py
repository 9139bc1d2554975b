"""Exact top-k inner products by norm-bucketed retrieval (after LEMP, Teflioudi et al., 2015).

Vectors become whole numbers, floor(1024 * x). Candidates are range-partitioned by descending length, and each task reads its
partition in buckets of ``BUCKET`` vectors of about one length. Queries come in blocks of about ``QUERY_BYTES``, so what is
sent to the tasks has a fixed bound whatever the number of queries.

A block's queries first meet the longest ``SEEDS`` candidates, which gives each a lower bound on its k-th score. For a bucket with
longest vector ``l``, a query of length ``|q|`` and bound ``b`` needs a cosine of at least ``b / (|q| l)``:

* above 1, the bucket is passed over (*length pruning*; so is the tail of a bucket whose vectors are too short);
* from a cosine on that the bucket chooses for itself, the query's ``FOCUS`` largest coordinates limit the same coordinates of any vector of
  that cosine to intervals, and only vectors in all of them are verified (*coordinate pruning*). The choice is by sampled cost: a few
  queries try their intervals, and the least cosine whose survivors are at most ``WORTHWHILE`` of the bucket becomes the threshold;
* else all vectors that length leaves are verified in one matrix product.

Bounds carry a margin against rounding, and products are exact: in double precision where every partial sum stays below 2^53, else in
64-bit integers, and for the rows that do not fit those in integers of any size.

Defined results: vectors that are null or hold null or non-finite components take no part; a score that does not fit a long is an error.
Vectors of unequal length are padded with zeros. Of query rows that share a vec_id the one with the smallest vector counts; candidate
rows of a query's own vec_id are its own; other repeated candidate rows each count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.llm.common import staged

K = 10
SCALE = 1024
BUCKET = 512
#: Candidates of the greatest length that give every query its first bound.
SEEDS = 4_096
#: Bytes of queries that are sent to tasks at a time.
QUERY_BYTES = 16 << 20
FOCUS = 4
SAMPLE = 8
WORTHWHILE = 0.1
ROWS = "query_id bigint, vec_id bigint, score bigint"


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, v: whole numbers as doubles, length) of the vectors that take part."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    large = F.transform("embedding", lambda x: x.cast("double") * SCALE)  # from 2^52 on doubles are whole
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    v = F.zip_with(v, large, lambda x, y: F.when(F.abs(y) < float(1 << 52), x.cast("double")).otherwise(y))
    rows = vectors.where(fine).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of doubles, padded with zeros to ``dims``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _most(x: np.ndarray) -> np.ndarray:
    return np.abs(x).max(axis=1, initial=0.0)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    most_q, most_p, dims = _most(q), _most(p), q.shape[1]
    top = float(most_q.max(initial=0.0)) * float(most_p.max(initial=0.0)) * dims
    if top < 2**53:
        return (q @ p.T).astype(np.int64)
    if top < 2**62:
        return q.astype(np.int64) @ p.astype(np.int64).T
    # few rows are so large: the others keep to machine numbers
    small_q, small_p = (most < np.sqrt(2.0**53 / dims) for most in (most_q, most_p))
    out = np.zeros((len(q), len(p)), np.int64)
    out[np.ix_(small_q, small_p)] = (q[small_q] @ p[small_p].T).astype(np.int64)
    exact = lambda x: [[int(y) for y in row] for row in x.tolist()]
    for i, j in ((~small_q, np.ones(len(p), bool)), (small_q, ~small_p)):
        rows, columns = exact(q[i]), exact(p[j])
        values = [[sum(a * b for a, b in zip(x, y)) for y in columns] for x in rows]
        if any(abs(v) >> 63 for row in values for v in row):
            raise OverflowError("a score does not fit a long")
        if rows and columns:
            out[np.ix_(i, j)] = values
    return out


class Best:
    """The k best (score descending, id ascending) of each query so far, and the k-th score as its bound."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, k: int):
        self.ids, self.k, self.bounds = ids, k, bounds.copy()
        self.rows = [np.zeros(0, np.int64)] * 3  # query, score, id

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        own = self.ids[query] != vec
        hit = np.zeros(len(self.ids), bool)
        hit[query[own]] = True
        met = hit[self.rows[0]]  # only queries with a new result are ranked again
        rest = [a[~met] for a in self.rows]
        q, s, v = (np.concatenate([a[met], b[own]]) for a, b in zip(self.rows, (query, score, vec)))
        order = np.lexsort((v, -s, q))
        q, s, v = q[order], s[order], v[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(first, np.diff(first, append=len(q)))
        top = place < self.k
        self.rows = [np.concatenate(x) for x in zip(rest, (q[top], s[top], v[top]))]
        last = place == self.k - 1
        self.bounds[q[last]] = np.maximum(self.bounds[q[last]], s[last])


def _in_focus(q: np.ndarray, q_len: float, t: float, unit: np.ndarray) -> np.ndarray:
    """Which rows of ``unit`` (vectors over their lengths) may have a cosine of at least ``t`` with a query, by its largest coordinates."""
    focus = np.argsort(-np.abs(q))[:FOCUS]
    keep = np.ones(len(unit), bool)
    for f in focus.tolist():
        c = q[f] / q_len
        # the angle between a vector and the query is at most acos(t), so its coordinate is between those of the angles to the axis
        width = np.sqrt(max(0.0, 1 - c * c)) * np.sqrt(max(0.0, 1 - t * t))
        low = c * t - width if t > -c else -1.0
        high = c * t + width if t > c else 1.0
        keep &= (unit[:, f] >= low - 1e-6) & (unit[:, f] <= high + 1e-6)
    return keep


def search_bucket(best: Best, q: np.ndarray, q_len: np.ndarray, p: np.ndarray, p_len: np.ndarray, p_id: np.ndarray, tally: dict[str, int] | None = None) -> None:
    """Meet one bucket (lengths descending) with all queries. ``tally`` adds up the pairs that each way of pruning spares and that are verified."""
    if not len(p):
        return
    tally = {} if tally is None else tally
    margin = 1e-9
    need = best.bounds - margin * np.abs(best.bounds.astype(np.float64)) - margin
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        cosine = np.where(q_len * p_len[0] > 0, need / (q_len * p_len[0]), np.where(need > 0, np.inf, -np.inf))
        upto = np.where(need > 0, np.searchsorted(-p_len, -np.where(need > 0, need / q_len, 0.0), "right"), len(p))
    live = cosine <= 1
    tally["length"] = tally.get("length", 0) + len(p) * len(q) - int(upto[live].sum())
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def verify(i: np.ndarray, j: np.ndarray | slice) -> None:
        s = products(q[i], p[j])
        tally["verified"] = tally.get("verified", 0) + s.size
        a, b = np.nonzero(s >= best.bounds[i][:, None])
        found.append((i[a], s[a, b], p_id[j][b]))

    threshold, unit = np.inf, None
    narrow = np.flatnonzero(live & (cosine > 0))
    if len(narrow):
        unit = p / np.maximum(p_len, 1e-300)[:, None]
        tried = narrow[np.argsort(cosine[narrow])][:: max(1, len(narrow) // SAMPLE)]
        for i in tried.tolist():
            if _in_focus(q[i], q_len[i], cosine[i], unit).mean() <= WORTHWHILE:
                threshold = cosine[i]
                break
    by_coordinate = live & (cosine >= threshold)
    for i in np.flatnonzero(by_coordinate).tolist():
        keep = _in_focus(q[i], q_len[i], cosine[i], unit)
        keep[upto[i] :] = False
        at = np.flatnonzero(keep)
        tally["coordinate"] = tally.get("coordinate", 0) + int(upto[i]) - len(at)
        if len(at):
            verify(np.array([i]), at)
    broad = np.flatnonzero(live & ~by_coordinate)
    broad = broad[np.argsort(upto[broad], kind="stable")]  # neighbours end at about one place
    for at in range(0, len(broad), 256):
        part = broad[at : at + 256]
        verify(part, slice(0, int(upto[part].max())))
    if found:
        best.add(*(np.concatenate(x) for x in zip(*found)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query. Both sides come from :func:`whole`."""
    spark = vectors.sparkSession
    vectors = staged(vectors.repartitionByRange(F.desc("length"), F.asc("vec_id")).sortWithinPartitions(F.desc("length"), F.asc("vec_id")), "vectors")
    queries = staged(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n, dims = (x or 0 for x in queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first())
    dims = max(dims, vectors.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    blocks = max(1, -(-n * dims * 8 // QUERY_BYTES))
    longest = vectors.orderBy(F.desc("length"), F.asc("vec_id")).limit(SEEDS).toArrow()
    seed_p, seed_id = matrix(longest.column("v"), dims), longest.column("vec_id").to_numpy()
    seed_len = longest.column("length").to_numpy()
    found = None
    for b in range(blocks):
        table = queries.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)) == b).toArrow()
        q, q_id = matrix(table.column("v"), dims), table.column("vec_id").to_numpy()
        q_len = np.sqrt((q**2).sum(axis=1))
        seed = Best(q_id, np.full(len(q), np.iinfo(np.int64).min), k)
        for at in range(0, len(seed_p), BUCKET):
            search_bucket(seed, q, q_len, seed_p[at : at + BUCKET], seed_len[at : at + BUCKET], seed_id[at : at + BUCKET])
        part = vectors.mapInArrow(_searcher(q, q_id, q_len, seed.bounds, dims, k), ROWS)
        if blocks > 1:  # a job for each block keeps plans and closures small
            part = staged(part, "found")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(q, q_id, q_len, bounds, dims, k):
    def run(batches):
        best = Best(q_id, bounds, k)
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                p = matrix(part.column(1), dims)
                search_bucket(best, q, q_len, p, part.column(2).to_numpy(), part.column(0).to_numpy())
        query, score, vec = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(q_id[query]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

    return run


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, p.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, p.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
