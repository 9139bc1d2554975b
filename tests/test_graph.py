import random

import numpy as np
import pyarrow as pa
import pytest

from corpuskit.operators import clean, curriculum, exact, vectors


def test_components_and_representatives(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (5, 6), *[(k, k + 1) for k in range(100, 140)]], "a long, b long")
    labels = vectors.components(pairs)
    assert {r.row_id: r.cluster for r in labels.collect()} == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5} | {k: 100 for k in range(100, 141)}
    lengths = spark.createDataFrame([(1, 4), (2, 9), (3, 9), (5, 0), (6, 0)], "row_id long, length int")
    chosen = vectors.representatives(labels.where("row_id < 10"), lengths)
    assert {(r.cluster, r.representative) for r in chosen.collect()} == {(1, 2), (5, 5)}
    assert [(r.cluster_id, r.cluster, r["size"]) for r in vectors.clusters(labels).orderBy("cluster_id").collect()] == [(0, 100, 41), (1, 1, 3), (2, 5, 2)]


def test_neighbours_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_BYTES", 17 * 64)
    rng = random.Random(0)
    rows = [(k, [rng.gauss(0, 1) for _ in range(5)]) for k in range(60)] + [(60, [0.0] * 5), (61, None)]
    df = spark.createDataFrame(rows, "row_id long, embedding array<float>")
    got = {(r.src, r["rank"]): (r.dst, round(r.score, 5)) for r in vectors.neighbours(df, df, 4).collect()}
    held = {r.row_id: r.embedding for r in df.collect() if r.embedding is not None}
    norm = lambda v: sum(x * x for x in v) ** 0.5 or 1.0
    for s, v in held.items():
        cos = sorted((-sum(a * b for a, b in zip(v, w)) / norm(v) / norm(w), d) for d, w in held.items() if d != s)
        for k in range(4):
            assert abs(got[s, k + 1][1] + cos[k][0]) < 1e-4
    assert len(got) == 61 * 4


def test_greedy_is_the_global_pass(spark):
    rng = random.Random(1)
    edges = sorted({(rng.randrange(80), rng.randrange(80)) for _ in range(90)})
    edges = [(a, b) for a, b in edges if a != b]
    ids = spark.range(80).withColumnRenamed("id", "row_id")
    df = spark.createDataFrame([(a, b, 0.9) for a, b in edges], "src long, dst long, score double")
    gone = set()
    for a in range(80):
        if a not in gone:
            gone |= {b for s, b in edges if s == a}
    for limit in (10**6, 3):
        assert {r.row_id for r in vectors.greedy_keep(ids, df, 0.5, limit).where("not kept").collect()} == gone


def test_levels_are_nested(spark):
    rng = random.Random(2)
    texts = ["a b", "a  b", "A b", "<think>x</think>a b", "أ ب", "ا ب"]
    rows = spark.createDataFrame([(k, rng.choice(texts), rng.choice(texts)) for k in range(80)], "row_id long, user string, assistant string")
    hashed = exact.digests(rows, "user", "assistant")
    removable = {r.level: r.removable for r in exact.report(hashed).collect()}
    assert [removable[x] for x in exact.LEVELS] == sorted(removable[x] for x in exact.LEVELS)
    kept = exact.keep_first(hashed, "l3")
    assert kept.where("not kept").count() == removable["l3"] and exact.members(hashed, "l3").where("row_id <> first_id").count() == removable["l3"]


def test_removal_reasons(spark):
    ids = lambda *x: spark.createDataFrame([(k,) for k in x], "row_id long")
    sets = {"exact_duplicate": ids(1, 2), "semantic_duplicate": ids(2, 3), "leakage_high_confidence": ids(3), "embedding_leakage": ids()}
    log = clean.removal_log(sets)
    assert {r.row_id: r.reasons for r in log.collect()} == {1: ["exact_duplicate"], 2: ["exact_duplicate", "semantic_duplicate"], 3: ["semantic_duplicate", "leakage_high_confidence"]}
    rows = ids(*range(6))
    assert clean.kept(rows, log).count() == 3
    assert {r.reason: r.rows for r in clean.reason_counts(log).collect()} == {"exact_duplicate": 2, "semantic_duplicate": 2, "leakage_high_confidence": 1, "unique": 3}
    assert [r.rows for r in clean.funnel(rows, sets).orderBy("step").collect()] == [6, 4, 3, 3, 3]


def test_first_rows_of_a_source(spark):
    rng = random.Random(3)
    ids = sorted(rng.sample(range(10**9), 500))
    df = spark.createDataFrame([(k,) for k in rng.sample(ids, 500)], "row_id long")
    for n in (0, 1, 7, 499, 500, 900):
        assert sorted(r.row_id for r in curriculum.first_rows(df, n, ranges=8).collect()) == ids[:n]


@pytest.mark.parametrize("odd", [False, True])
def test_neighbours_over_many_tiles(odd):
    """More candidates than a product holds, in two blocks; zero and non-finite vectors; no candidates."""
    rng = np.random.default_rng(3)
    raw = rng.normal(size=(2_600, 8)).astype(np.float32)
    raw[5] = 0
    if odd:
        raw[[7, 2_000]], raw[1_500, 2] = np.nan, np.inf
    ids = rng.permutation(len(raw)).astype(np.int64)
    none = [pa.array([[]] * 700, pa.list_(t)) for t in (pa.int64(), pa.float64())]
    batch = pa.RecordBatch.from_arrays([pa.array(ids[:700]), pa.array(list(raw[:700]), pa.list_(pa.float32())), *none], ["id", "v", "dst", "score"])
    for part in (slice(0, 1_300), slice(1_300, None), slice(0, 0)):
        batch = next(iter(vectors._searcher(raw[part], ids[part], 5, True)([batch])))
    wide = raw.astype(np.float64)
    length = np.sqrt((wide * wide).sum(axis=1))
    length[length == 0] = 1
    with np.errstate(invalid="ignore"):
        score = (wide[:700] @ wide.T) / (length[:700, None] * length)
    score[np.isnan(score) | (ids[:700, None] == ids)] = -np.inf
    for k, (dst, got) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
        order = np.lexsort((ids, -score[k].round(12)))[:5]
        order = order[score[k][order] > -np.inf]
        assert sorted(dst) == sorted(ids[order].tolist()), k
        assert np.allclose(sorted(got), sorted(score[k][order]))
