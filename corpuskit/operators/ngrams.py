"""n-gram decontamination against benchmark texts.

Both sides become rows of gram hashes (128 bits, taken from the words themselves, so no gram is built as text) and meet in an equi-join.
The benchmark side is broadcast only if it was counted and is small; otherwise both sides are shuffled on the hashes. Repeated grams of a
row are told apart after the join, where few are left.

With a small benchmark side, texts are first cut to the passages that can match: rolling hashes over the bytes of a slice are looked up in
those of the benchmarks. Equal grams have equal hashes, so none is lost, and what a hash lets through by chance fails in the join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpuskit.functions import text as T
from corpuskit.staging import staged

SIZE, MIN_OVERLAP = 13, 1
BROADCAST_ROWS = 200_000
#: Bytes of text that are hashed at a time; a longer text is taken in pieces.
SLICE_BYTES = 1 << 20


GRAM = ["h1", "h2"]


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value bound to a lambda variable; a column that is read at several places would be computed as often."""
    return F.transform(F.array(value), use)[0]


def _combined(parts: Column, step: int, swap: bool = False) -> Column:
    """Hashes of parts that stand ``step`` apart; none if there are too few."""
    pair = lambda i: (parts[i + step], parts[i]) if swap else (parts[i], parts[i + step])
    return F.when(F.size(parts) > step, F.transform(F.sequence(F.lit(0), F.size(parts) - 1 - step), lambda i: F.xxhash64(*pair(i))))


def grams(rows: DataFrame, text: str, keys: list[str], n: int = SIZE) -> DataFrame:
    """``keys`` and the hashes (h1, h2) of each row's n-grams, repeats included."""
    return _grams_of(rows, T.tokens(T.canonical_ngrams(T.filled(text))), keys, n)


def _grams_of(rows: DataFrame, tokens: Column, keys: list[str], n: int) -> DataFrame:
    """Words are hashed once; hashes of 2, 4, 8, ... words follow from halves, and those of n words from two that overlap."""

    def finish(halves: Column, size: int) -> Column:
        if n == size:
            return F.transform(halves, lambda h: F.struct(h.alias("h1"), F.xxhash64(F.lit(1), h).alias("h2")))
        h1, h2 = _combined(halves, n - size), _combined(halves, n - size, swap=True)
        return F.arrays_zip(h1.alias("h1"), h2.alias("h2"))

    def grow(parts: Column, size: int) -> Column:
        return _once(_combined(parts, size), lambda p: grow(p, 2 * size)) if 2 * size <= n else finish(parts, size)

    words = F.transform(tokens, lambda x: F.xxhash64(x))
    return rows.select(*keys, F.explode(_once(words, lambda w: grow(w, 1))).alias("g")).select(*keys, "g.h1", "g.h2")


#: What canonical texts make of ASCII: lower case, and white space as spaces. Other bytes stay.
_ASCII = np.arange(256, dtype=np.uint8)
_ASCII[65:91] += 32
_ASCII[[9, 10, 11, 12, 13, 28, 29, 30, 31]] = 32
#: Ranges that hold all characters that are folded or deleted, and all white space beyond ASCII.
_FOLDED_OR_SPACE = r"[\x{85}\x{A0}\x{600}-\x{6FF}\x{1680}\x{2000}-\x{200F}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
_BASE = 0x9E3779B97F4A7C15


class _Rolling:
    """64-bit hashes of the n-grams of canonical bytes, from sums of bytes times powers."""

    def __init__(self, n: int):
        self.n, self.values = n, np.random.default_rng(42).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers, self.inverse = (np.ones(1, np.uint64) for _ in range(2))

    def _reach(self, size: int) -> None:
        if len(self.powers) < size:
            for name, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def grams(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end) of all words and (first word, hash) of the grams. Words end at spaces and at ``edges``, grams at edges."""
        space, edge = data == 32, np.zeros(len(data) + 1, bool)
        edge[edges] = True
        first, last = edge[:-1].copy(), edge[1:].copy()
        first[1:] |= space[:-1]
        last[:-1] |= space[1:]
        begin, end = np.flatnonzero(first & ~space), np.flatnonzero(last & ~space) + 1
        row = np.searchsorted(edges, begin, "right")
        at = np.flatnonzero(row[: len(row) - self.n + 1] == row[self.n - 1 :]) if len(row) >= self.n else np.zeros(0, np.int64)
        if not len(at):
            return begin, end, at, np.zeros(0, np.uint64)
        self._reach(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        h = (sums[end[at + self.n - 1]] - sums[begin[at]]) * self.inverse[begin[at]]
        h ^= h >> np.uint64(32)
        return begin, end, at, h * np.uint64(0xD6E8FEB86659FD93)


def _slices(texts: pa.Array, most: int):
    """(first row, data, edges): canonical bytes of some rows, about ``most`` at a time, white space collapsed."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    held = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        data, edges = _ASCII[held[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo]
        again = data == 32
        again[1:] &= again[:-1].copy()
        again[:1] = False
        if again.any():
            gone = np.flatnonzero(again)
            data, edges = data[~again], edges - np.searchsorted(gone, edges)
        yield lo, data, edges
        lo = hi


def _pieces(rolling: _Rolling, data: np.ndarray, edges: np.ndarray, most: int):
    """:meth:`_Rolling.grams` and the bytes they are of. A text of over twice ``most`` bytes, which has a slice for itself, is taken in pieces
    that share n - 1 words."""
    if len(data) <= 2 * most:
        yield data, edges, rolling.grams(data, edges)
        return
    text, lo, size = data.tobytes(), 0, most
    while lo < len(text):
        hi = text.find(b" ", lo + size)
        hi = len(text) if hi < 0 else hi
        part, ends = data[lo:hi], np.array([0, hi - lo])
        found = rolling.grams(part, ends)
        words = len(found[0])
        if words < rolling.n and hi < len(text):
            size *= 2
            continue
        yield part, ends, found
        lo, size = (hi if rolling.n == 1 or hi == len(text) else lo + int(found[0][words - rolling.n + 1])), most


def _nearly_canonical(text: str) -> Column:
    """Canonical but for what :func:`_slices` does: lower case of ASCII texts, and white space of texts that hold no other than ASCII's."""
    x = T.filled(text)
    ascii_only = (F.octet_length(x) == F.char_length(x)) & F.is_valid_utf8(x)
    return F.when(ascii_only, x).when(~x.rlike(_FOLDED_OR_SPACE), F.lower(x)).otherwise(T.canonical_ngrams(x))


def _marks(benchmarks: DataFrame, n: int, most: int) -> np.ndarray:
    """The distinct rolling hashes of the benchmarks' grams, in order."""

    def run(batches):
        rolling = _Rolling(n)
        for batch in batches:
            for _, data, edges in _slices(batch.column(0), most):
                for _, _, (_, _, _, h) in _pieces(rolling, data, edges, most):
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(h).view(np.int64))], ["h"])

    hashes = benchmarks.select(_nearly_canonical("text").alias("x")).mapInArrow(run, "h bigint").distinct().toArrow()
    return np.sort(hashes.column("h").to_numpy().view(np.uint64))


def passages(rows: DataFrame, benchmarks: DataFrame, key: str, text: str, n: int = SIZE, most: int = SLICE_BYTES) -> DataFrame:
    """(key, passage): runs of words that may hold grams of the benchmarks; no such gram is left out."""
    marks = _marks(benchmarks, n, most)
    bits = min(24, max(16, int(16 * len(marks)).bit_length()))

    def run(batches):
        rolling, shift = _Rolling(n), np.uint64(64 - bits)
        gate = np.zeros(1 << bits, bool)
        gate[marks >> shift] = True
        for batch in batches:
            for row, data, edges in _slices(batch.column(1), most) if len(marks) else ():
                keys, found = [], []
                for part, ends, (begin, end, at, h) in _pieces(rolling, data, edges, most):
                    may = np.flatnonzero(gate[h >> shift])
                    place = np.minimum(np.searchsorted(marks, h[may]), len(marks) - 1)
                    hit = at[may[marks[place] == h[may]]]
                    if len(hit):
                        own = np.searchsorted(ends, begin[hit], "right") - 1
                        new = np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(own, prepend=-1) != 0))
                        stop = np.append(new[1:], len(hit)) - 1
                        found += [part[a:b].tobytes() for a, b in zip(begin[hit[new]].tolist(), end[hit[stop] + n - 1].tolist())]
                        keys.append(row + own[new])
                if found:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(keys))), pa.array(found, pa.string())], [key, "passage"])

    schema = StructType([rows.select(key).schema[0], StructField("passage", StringType())])
    return rows.select(key, _nearly_canonical(text).alias("x")).mapInArrow(run, schema)


def benchmark_grams(benchmarks: DataFrame, text: str = "text", n: int = SIZE) -> DataFrame:
    """Distinct (benchmark, h1, h2)."""
    return grams(benchmarks, text, ["benchmark"], n).distinct()


def hits(rows: DataFrame, benchmarks: DataFrame, key: str = "row_id", text: str = "text", n: int = SIZE, least: int = MIN_OVERLAP) -> DataFrame:
    """(key, benchmark, overlap): rows that share at least ``least`` distinct grams with a benchmark."""
    known = staged(benchmark_grams(benchmarks, n=n), "benchmark-grams")
    if known.count() <= BROADCAST_ROWS:
        own, side = _grams_of(passages(rows, benchmarks, key, text, n), T.tokens("passage"), [key], n), F.broadcast(known)
    else:
        own, side = grams(rows, text, [key], n), known
    shared = own.join(side, GRAM).select(key, "benchmark", *GRAM).distinct()
    return shared.groupBy(key, "benchmark").agg(F.count(F.lit(1)).alias("overlap")).where(F.col("overlap") >= least)


def decontaminated(rows: DataFrame, found: DataFrame, key: str = "row_id") -> DataFrame:
    return rows.join(found.select(key).distinct(), key, "left_anti")


def report(rows: DataFrame, benchmarks: DataFrame, found: DataFrame, key: str = "row_id", n: int = SIZE) -> DataFrame:
    """(metric, benchmark, value): rows, kept, removed; grams and removed rows per benchmark."""
    named = lambda df, metric: df.select(F.lit(metric).alias("metric"), "benchmark", F.col("value").cast("bigint").alias("value"))
    total, gone = rows.count(), found.agg(F.countDistinct(key)).first()[0]
    out = rows.sparkSession.createDataFrame([("rows", "", total), ("removed", "", gone), ("kept", "", total - gone)], "metric string, benchmark string, value bigint")
    sizes = benchmark_grams(benchmarks, n=n).groupBy("benchmark").agg(F.count(F.lit(1)).alias("value"))
    lost = found.groupBy("benchmark").agg(F.countDistinct(key).alias("value"))
    return out.unionByName(named(sizes, "grams")).unionByName(named(lost, "removed_by"))
