import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from corpuskit.llm import simhash
from corpuskit.llm.components import components


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """(doc_id, print) rows -> component of each row."""
    ids = [d for d, _ in prints]
    p = np.array([x for _, x in prints], np.uint64)
    parent = list(range(len(p)))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p ^ p[i]) <= 4):
            parent[root(int(j))] = root(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(p))]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = [(d, brute_print(t)) for d, t in rows]
    want = Counter(zip([d for d, _ in prints], [p for _, p in prints], brute_components(prints)))
    got = simhash.fingerprints(docs)
    groups = simhash.near_duplicates(got)
    out = got.join(groups, "fp", "left").collect()
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in out) == want


def test_documents(documents):
    check(documents)


def test_odd_rows(odd, none):
    check(odd)
    assert simhash.near_duplicates(simhash.fingerprints(none)).count() == 0


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_dense_buckets_are_dealt_again(spark, monkeypatch, depth):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 40)
    monkeypatch.setattr(simhash, "DEPTH", depth)
    rng = np.random.default_rng(1)
    center = int(rng.integers(1 << 63))
    near = {center ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(1, 8), replace=False)) for _ in range(700)}
    far = {int(x) for x in rng.integers(1 << 63, size=300)}
    prints = list(enumerate(sorted(near | far)))
    df = spark.createDataFrame([(d, p) for d, p in prints], "doc_id bigint, fp bigint")
    got = {r.fp: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert [got[p] for _, p in prints] == brute_components(prints)


def test_components_of_long_paths_and_hot_nodes(spark):
    edges = [(k + 1, k) for k in range(60)] + [(1000 + k, 999) for k in range(500)] + [(5, 5), (2000, 2001), (2001, 2000), (2002, 2001)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 999 for k in range(999, 1500)} | {k: 2000 for k in (2000, 2001, 2002)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
