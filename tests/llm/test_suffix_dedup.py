import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corpuskit.llm import suffix_dedup
from corpuskit.llm.repeat_index import RunIndex, repeated_ranges


def marks(texts, w):
    """Ranges of each text that lie in a repeated window, from counts of all windows."""
    counts = Counter(hash(t[i : i + w]) for t in texts for i in range(len(t) - w + 1))
    out = []
    for t in texts:
        ranges = []
        for i in range(len(t) - w + 1):
            if counts[hash(t[i : i + w])] > 1:
                if ranges and i <= ranges[-1][1]:
                    ranges[-1][1] = i + w
                else:
                    ranges.append([i, i + w])
        out.append([tuple(r) for r in ranges])
    return out


def brute(rows, w, words=50):
    texts = [(t or "").encode() for _, t in rows]
    out = Counter()
    for (d, _), t, ranges, passages in zip(rows, texts, marks(texts, w), marks([tuple(t.split()) for t in texts], words)):
        kept, at = b"", 0
        for a, b in ranges:
            kept, at = kept + t[at:a], b
        kept += t[at:]
        out[(d, len(t), tuple(ranges), hashlib.sha256(kept).hexdigest(), tuple(passages), kept)] += 1
    return out


def run(docs, w, words=50):
    got = suffix_dedup.remove_repeats(docs, w, words).collect()
    pairs = lambda ranges: tuple((x.a, x.b) for x in ranges)
    return Counter((r.doc_id, r.n_bytes, pairs(r.removed), r.kept_sha256, pairs(r.passages), bytes(r.kept)) for r in got)


def test_documents(documents):
    assert run(documents, 400) == brute([(r.doc_id, r.text) for r in documents.collect()], 400)


def planted(seed):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzé \n"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [make(rng.choice([390, 400, 450, 1200])) for _ in range(6)]
    texts = [make(rng.randint(0, 900)) + (rng.choice(shared) if rng.random() < 0.7 else "") + make(rng.randint(0, 60)) for _ in range(60)]
    texts += ["ab" * 700, "x" * 399, "x" * 401, "", None, texts[0], texts[0], "y" * 5000]
    return [(None if k % 17 == 0 else k, t) for k, t in enumerate(texts)] + [(5, texts[5]), (5, texts[6])]


@pytest.mark.parametrize("hot", [4096, 3])
def test_planted_passages_and_hot_grams(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    rows = planted(hot)
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string"), 400) == brute(rows, 400)


@pytest.mark.parametrize("hot", [1024, 2])
def test_passages_of_words(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(suffix_dedup, "PIECE", 2000)  # long texts are taken in pieces
    rng = random.Random(hot)
    make = lambda n: [rng.choice(["a", "bb", "çà", "d" * 30, "e"]) + str(rng.randrange(99)) for _ in range(n)]
    shared = [make(n) for n in (49, 50, 51, 70, 900)]
    rows = []
    for k in range(50):
        words = make(rng.randint(0, 80)) + rng.choice(shared) + make(rng.choice([0, 3, 2000]))
        rows.append((k, "".join(w + rng.choice([" ", "\n", "\t\r\n "]) for w in words)))
    rows += [(60, "x " * 49), (61, "y " * 50), (62, "z " * 51), (63, "w" * 9000 + " v" * 120), (64, ""), (65, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert run(docs, 400) == brute(rows, 400)
    none = suffix_dedup.remove_repeats(docs, 400, 0).collect()
    assert all(r.passages == [] for r in none)


def test_long_texts_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    rows = planted(9)
    got = suffix_dedup._segments_of(400, 0)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([t or "" for _, t in rows], pa.string()), pa.array(range(len(rows)), pa.int64()), pa.array(range(len(rows)), pa.int64())], ["text", "did", "t64"])
    seen = Counter((d, i) for b in got([batch]) for d, at, n in zip(b["did"].to_pylist(), b["at"].to_pylist(), b["windows"].to_pylist()) for i in range(at, at + n))
    assert seen == Counter((k, i) for k, (_, t) in enumerate(rows) for i in range(len((t or "").encode()) - 399))


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert run(odd, 400) == brute(rows, 400)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_many_repeated_rows_gather_one_set_of_ranges(spark):
    rng = random.Random(8)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(300))
    rows = [(None, text)] * 3000 + [(1, text[:700]), (2, "z" + text[900:])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert run(docs, 400) == brute(rows, 400)
    spans = suffix_dedup.repeated_spans(suffix_dedup._rows(docs)).collect()
    assert len(spans) == 3 and max(len(r.spans) + len(r.passages) for r in spans) < 100


def test_index_against_counts():
    rng = random.Random(2)
    for _ in range(400):
        w, letters = rng.choice([3, 5, 9, 17, 40]), rng.choice([b"a", b"ab", b"abcd", b"\x00\x01", bytes(range(256))])
        make = lambda n: bytes(rng.choice(letters) for _ in range(n))
        base = [make(rng.randint(0, 120)) for _ in range(3)]
        strings = []
        for _ in range(rng.randint(1, 8)):
            b = rng.choice(base)
            i = rng.randint(0, len(b))
            strings.append(make(rng.randint(0, 20)) + b[i : rng.randint(i, len(b))] + make(rng.randint(0, 5)))
        assert repeated_ranges([np.frombuffer(s, np.uint8) for s in strings], w) == marks(strings, w)
        names = rng.sample(range(1 << 62), 256)  # the same strings, over a large alphabet
        assert repeated_ranges([np.array([names[x] for x in s], np.uint64) for s in strings], w) == marks(strings, w)


def test_statistics_against_all_pairs():
    rng = random.Random(6)
    for _ in range(60):
        w = rng.choice([2, 5, 9])
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(3)]
        ends = np.cumsum([len(s) for s in strings])
        index = RunIndex(np.frombuffer(b"".join(strings), np.uint8), ends, w)
        places = [(s, i) for s in strings for i in range(len(s))]
        shared = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        for k, (s, i) in enumerate(places):
            most = max((shared(s[i:], t[j:]) for m, (t, j) in enumerate(places) if m != k), default=0)
            assert index.statistics()[k] == most if most >= w else index.statistics()[k] < w
        assert index.lengths.sum() == sum(max(0, len(s) - w + 1) for s in strings)


def test_runs_are_few_in_repetitive_strings():
    rng = random.Random(4)
    base = bytes(rng.randrange(97, 123) for _ in range(2000))
    strings = [base[: 900 + k] + b"#" + base[901 + k :] for k in range(40)]
    index = RunIndex(np.frombuffer(b"".join(strings), np.uint8), np.cumsum([len(s) for s in strings]), 400)
    assert len(index.heads) < 0.1 * sum(map(len, strings))
