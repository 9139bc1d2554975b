"""Pieces of the repeat search: window segments and the run-length index. See :mod:`corpuskit.llm.suffix_dedup`.

Both take texts as rows of units: bytes, or words as 64-bit hashes.
"""

from __future__ import annotations

import numpy as np

#: Bytes, or words, of a window's sub-strings that are hashed; a window's least hash decides where it is compared.
GRAM, WORD_GRAM = 128, 16
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S = np.uint64(29)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word (white space is ASCII's)."""
    raw = np.frombuffer(data, np.uint8)
    solid = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.flatnonzero(np.diff(solid.view(np.int8), prepend=0, append=0))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, np.uint64)
    # a polynomial in _C1: words start at different powers, which their inverses take back
    up, down = _powers(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up[: len(raw)])))
    h = (sums[end] - sums[begin]) * down[begin]
    h ^= (end - begin).astype(np.uint64) * _C2
    h ^= h >> _S
    h *= _C2
    return h ^ (h >> np.uint64(32))


_BYTES = np.random.default_rng(5).integers(1 << 64, size=256, dtype=np.uint64)
_tables: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of _C1 and of its inverse, at least ``n`` of each; kept for the next piece of text."""
    if not _tables or len(_tables[0]) < n:
        size = 1 << max(16, n.bit_length())
        _tables[:] = [np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size, x, np.uint64)))) for x in (int(_C1), pow(int(_C1), -1, 1 << 64))]
    return _tables


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every ``gram`` (a power of two) units, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _C1
    size = 1
    while size < gram:
        h = h[:-size] * _C1 + (h[size:] ^ (h[size:] >> _S)) * _C2
        size *= 2
    h ^= h >> _S
    h *= _C2
    h ^= h >> np.uint64(32)
    return h


def sliding(op, h: np.ndarray, width: int) -> np.ndarray:
    """``op`` (minimum or maximum) over every ``width`` neighbours."""
    out, size = h, 1
    while size * 2 <= width:
        out = op(out[:-size], out[size:])
        size *= 2
    if size < width:
        out = op(out[: len(out) - (width - size)], out[width - size :])
    return out


def segments(raw: np.ndarray, bounds: np.ndarray, window: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Cut the windows of several texts into segments of neighbours with one least gram.

    ``raw`` is the units of the texts side by side, ``bounds`` their ends. Gives (value, text, start, windows, twice): the least hash, the
    index of the text, the first window's place in ``raw``, the number of windows, and whether the gram stands in the segment more than once.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < window:
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    h = gram_hashes(raw, gram)
    width = window - gram + 1
    least = sliding(np.minimum, h, width)
    n = len(least)
    starts = np.concatenate(([0], bounds[:-1]))
    valid = np.zeros(n + 1, np.int32)
    long = bounds - starts >= window
    valid[starts[long]] += 1
    valid[np.minimum(bounds[long] - window + 1, n)] -= 1
    valid = np.cumsum(valid[:n]) > 0
    change = np.ones(n, bool)
    change[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    begins = starts[long]
    change[begins] = True
    first = np.flatnonzero(change)
    count = np.diff(first, append=n)
    keep = valid[first]
    first, count = first[keep], count[keep]
    value = least[first]
    # places whose gram is the least of some window
    shown = np.where(valid, least, np.uint64(0))
    pad = np.concatenate((np.zeros(width - 1, np.uint64), shown, np.zeros(width - 1, np.uint64)))
    place = np.flatnonzero(sliding(np.maximum, pad, width) == h)
    low, high = np.searchsorted(place, first), np.searchsorted(place, first + count + width - 1)
    hits = np.zeros(len(first), np.int64)
    span = high - low
    for k in range(min(int(span.max(initial=0)), 24)):
        at = np.minimum(low + k, len(place) - 1)
        hits += (k < span) & (h[place[at]] == value)
    return value, np.searchsorted(bounds, first, "right"), first, count, (hits > 1) | (span > 24)


def _names(key: np.ndarray) -> np.ndarray:
    """Dense ranks of the values of ``key``, in their order."""
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(len(key), np.uint32)
    rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1]))) if len(key) else 0
    return rank


class RunIndex:
    """A run-compressed Burrows-Wheeler transform of several strings, with samples at the runs' ends.

    Strings are compared as if zeros followed them for ever; matches are cut at their ends. Only suffixes of at least ``window`` units
    are kept: no shorter one can stand between two that share so much. Suffixes are ranked by doubling up to about the window or a quarter
    of the longest string; what is left of the long ones is compared in steps of that size.

    ``heads`` and ``lengths`` are the transform's runs (-1 heads a string's first suffix). ``sample`` holds, for every pair of neighbours
    at which a run ends, both places and the length of their match. Within a run a suffix matches its neighbour one unit less than its
    left neighbour in the text does, so the match of any place follows from the samples to its left: :meth:`statistics` streams them.
    """

    def __init__(self, raw: np.ndarray, ends: np.ndarray, window: int):
        n, sizes = len(raw), np.diff(ends, prepend=0)
        self.window, self.n, self.raw = window, n, raw
        left = np.repeat(ends, sizes) - np.arange(n)
        longest = int(sizes.max(initial=0))
        if raw.dtype == np.uint8:
            pad = np.concatenate((raw, np.zeros(8, np.uint8)))
            key = np.zeros(n, np.uint64)
            for k in range(8):
                key = (key << np.uint64(8)) | np.where(k < left, pad[k : k + n], 0).astype(np.uint64)
            rank, size = _names(key), 8
            unit = raw
        else:
            rank, size = _names(raw), 1
            unit = rank
        self.levels = [(size, rank)]
        while size * 2 <= window or size * 4 < longest:
            key = (rank.astype(np.uint64) << np.uint64(32)) | self._next(rank, np.arange(n), left, size)
            rank, size = _names(key), size * 2
            self.levels.append((size, rank))
        valid = np.flatnonzero(left >= window)
        current, at = rank[valid], size
        while at < longest:
            current = _names((current.astype(np.uint64) << np.uint64(32)) | self._next(rank, valid, left, at))
            at += size
        # equal but for zeros at their ends: the shorter first, as if an end came before a zero
        suffixes = valid[np.argsort((current.astype(np.uint64) << np.uint64(32)) | left[valid].astype(np.uint64))]
        first = np.zeros(n, bool)
        first[(ends - sizes)[sizes > 0]] = True
        before = np.where(first[suffixes], -1, unit[np.maximum(suffixes - 1, 0)].astype(np.int64))
        edge = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] < 0))
        begin = np.concatenate((np.zeros(min(1, len(suffixes)), np.int64), edge + 1))
        self.heads, self.lengths = before[begin], np.diff(begin, append=len(suffixes))
        a, b = suffixes[edge], suffixes[edge + 1]
        deep = rank[a] == rank[b] if size <= window else np.ones(len(a), bool)
        a, b = a[deep], b[deep]
        self.sample = (a, b, self._match(a, b, left))

    @staticmethod
    def _next(rank, places, left, size):
        there = np.minimum(places + size, len(rank) - 1)
        return np.where(left[places] > size, rank[there].astype(np.uint64) + np.uint64(1), np.uint64(0))

    def _match(self, a, b, left):
        """Length of the common prefix, by falling levels; the highest level is used as often as it holds."""
        length, most = np.zeros(len(a), np.int64), np.minimum(left[a], left[b])
        for depth, (size, rank) in enumerate(reversed(self.levels)):
            open_ = np.arange(len(a))
            while len(open_):
                open_ = open_[length[open_] < most[open_]]
                same = rank[a[open_] + length[open_]] == rank[b[open_] + length[open_]]
                open_ = open_[same]
                length[open_] += size
                if depth:
                    break
        length = np.minimum(length, most)
        open_ = np.arange(len(a))
        for _ in range(self.levels[0][0]):  # what is left is less than the lowest level
            open_ = open_[length[open_] < most[open_]]
            open_ = open_[self.raw[a[open_] + length[open_]] == self.raw[b[open_] + length[open_]]]
            length[open_] += 1
        return length

    def statistics(self) -> np.ndarray:
        """Matching statistics: how far the longest match of each place with another goes on from there, of matches of ``window`` or more.

        They are streamed from left to right: a match that a sample opens is one shorter at each next place, until another reaches further.
        """
        a, b, length = self.sample
        far = length >= self.window
        reach = np.zeros(self.n, np.int64)
        for start in (a[far], b[far]):
            np.maximum.at(reach, start, start + length[far])
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.n), 0)


def repeated_ranges(strings: list[np.ndarray], window: int) -> list[list[tuple[int, int]]]:
    """For each string of units, the maximal ranges that lie in a ``window`` found at two places or more of all strings."""
    ends = np.cumsum([len(s) for s in strings], dtype=np.int64)
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    if not len(ends) or ends[-1] < window:
        return out
    mark = RunIndex(np.concatenate(strings), ends, window).statistics() > 0
    starts = np.concatenate(([0], ends[:-1]))
    change = np.ones(len(mark), bool)
    change[1:] = mark[1:] != mark[:-1]
    change[starts[starts < len(mark)]] = True
    begin = np.flatnonzero(change)
    stop = np.append(begin[1:], len(mark))
    on = mark[begin]
    owner = np.searchsorted(ends, begin[on], "right")
    for k, x, y in zip(owner.tolist(), begin[on].tolist(), stop[on].tolist()):
        out[k].append((x - int(starts[k]), y - int(starts[k])))
    return out
