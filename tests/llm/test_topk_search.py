import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import topk_search

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, is_query, k=10):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in fine:
        if is_query(i):
            best = sorted((-sum(a * b for a, b in zip(q, p)), j) for j, p in fine if j != i)[:k]
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(best, 1)}
    return out


def run(df, rule="vec_id % 100 = 0"):
    v = topk_search.whole(df)
    return {tuple(r) for r in topk_search.top_k(v, v.where(rule)).collect()}


@pytest.mark.parametrize("worthwhile", [0.1, 1.0])
def test_embeddings(spark, monkeypatch, worthwhile):
    monkeypatch.setattr(topk_search, "BUCKET", 64)
    monkeypatch.setattr(topk_search, "WORTHWHILE", worthwhile)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 100 == 0)
    assert run(df) == want


@pytest.mark.parametrize("worthwhile", [0.1, 1.0, -1.0])
def test_lengths_ties_and_query_blocks(spark, monkeypatch, worthwhile):
    for name, value in (("BUCKET", 32), ("SEEDS", 32), ("QUERY_BYTES", 9 * 48), ("WORTHWHILE", worthwhile)):
        monkeypatch.setattr(topk_search, name, value)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * rng.choice([0.01, 1, 5]) for _ in range(6)]) for i in range(400)]
    rows += [(i, list(rows[i % 7][1])) for i in range(400, 450)] + [(450, [0.0] * 6)]
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in rows], SCHEMA)
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    assert run(df, "vec_id % 10 = 0") == brute(exact, lambda i: i % 10 == 0)


def test_both_ways_of_pruning_spare_pairs():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    p = np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True), 50, axis=0) + rng.normal(size=(2000, 16)) * 0.08
    p *= np.where(rng.random((2000, 1)) < 0.3, 512, 1024) / np.linalg.norm(p, axis=1, keepdims=True)
    p = np.floor(p)
    p = p[np.argsort(-np.linalg.norm(p, axis=1))]
    lengths, ids, asked = np.linalg.norm(p, axis=1), np.arange(2000), np.arange(0, 2000, 20)
    best, tally = topk_search.Best(ids[asked], np.full(len(asked), np.iinfo(np.int64).min), 10), {}
    for at in range(0, 2000, 64):
        topk_search.search_bucket(best, p[asked], lengths[asked], p[at : at + 64], lengths[at : at + 64], ids[at : at + 64], tally)
    q, s, v = best.rows
    scores = (p[asked] @ p.T).astype(np.int64)
    for k, i in enumerate(asked):
        want = sorted((-x, j) for j, x in enumerate(scores[k].tolist()) if j != i)[:10]
        assert [(-x, j) for x, j in zip(s[q == k].tolist(), v[q == k].tolist())] == want
    assert tally["length"] > 20_000 and tally["coordinate"] > 20_000 and tally["verified"] < 120_000, tally


def test_large_components_count(spark):
    rows = [(0, [1.0, 1.0]), (1, [300000.0, 0.0]), (2, [1.0, 0.0]), (3, [-(2.0**21), 2.0**13]), (4, [2.0**30, -(2.0**30)]), (100, [2.0**20, 0.5]), (5, [1e-30, -1e-30])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert run(df.where("vec_id <> 4")) == brute([r for r in rows if r[0] != 4], lambda i: i % 100 == 0)
    assert run(df.where("vec_id in (0, 1, 2)")) == {(0, 1, 1, 300000 << 20), (0, 2, 2, 1 << 20)}
    with pytest.raises(Exception, match="does not fit a long"):
        run(df.where("vec_id in (100, 4)").withColumn("embedding", F.transform("embedding", lambda x: x * 2.0**20)))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (100, [0.5, 0.5], None), (1, None, 1), (2, [None, 1.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (None, [1.0, 1.0], 1), (5, [1.0], 1), (6, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    # 5 is padded to (1, 0); 6 is empty, all zero
    assert run(df) == {(0, 1, 5, 1048576), (0, 2, 100, 524288), (0, 3, 6, 0), (100, 1, 0, 524288), (100, 2, 5, 524288), (100, 3, 6, 0)}
    assert run(df.limit(0)) == set()
