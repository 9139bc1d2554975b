import random

import duckdb
import numpy as np
import pytest

from corpuskit.operators import vectors
from corpuskit.plans import vector_queries as vecs


def table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return path


def by_sql(name, path):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet/*.parquet'")
    return sorted(c.execute(vecs.ORACLES[name]).fetchall())


def cone(n, seed, spread=0.2, dims=6):
    rng = random.Random(seed)
    return [(k, [1.0] + [rng.gauss(0, spread) for _ in range(dims - 1)], 0) for k in range(n)]


def test_greedy_removal_takes_as_many_neighbours_as_its_sql(spark, tmp_path):
    path = table(spark, tmp_path, cone(8, 1))
    got = sorted((r.row_id, r.kept) for r in vecs.sem_greedy_keep(spark, path).collect())
    assert got == by_sql("sem_greedy_keep", path) == [(k, k == 0) for k in range(8)]


def test_blocks_of_candidates_give_the_best_with_ties_to_smaller_ids(spark, monkeypatch):
    sent = []
    search = vectors._searcher
    monkeypatch.setattr(vectors, "QUERY_BYTES", 300 * 6 * 4)
    monkeypatch.setattr(vectors, "_searcher", lambda raw, *rest: sent.append(len(raw)) or search(raw, *rest))
    rng = np.random.default_rng(2)
    v = rng.normal(size=(1100, 6)).astype(np.float32)
    v[::100] = v[0]  # 11 copies; equal scores go to the smaller id
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "row_id long, embedding array<float>").coalesce(1)
    found = vectors.neighbours(df, df, 3)
    assert len(sent) == 4 and max(sent) < 500
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.src, r["rank"])):
        got.setdefault(r.src, []).append(r.dst)
    unit = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1)[:, None]
    s = np.round(unit @ unit.T, 12)
    np.fill_diagonal(s, -9)
    assert got == {k: np.lexsort((np.arange(1100), -s[k]))[:3].tolist() for k in range(1100)}


def test_greedy_removal_meets_all_pairs(spark, tmp_path):
    path = table(spark, tmp_path, cone(40, 3))
    got = sorted((r.row_id, r.kept) for r in vecs.sem_greedy_keep(spark, path).collect())
    assert got == by_sql("sem_greedy_keep", path) == [(k, k == 0) for k in range(40)]


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_greedy_removal_over_all_pairs_is_the_global_pass(spark, block_rows):
    rng = np.random.default_rng(5)
    ids = [k - k % 9 // 8 for k in range(160)]  # some ids have two rows
    v = rng.normal(size=(160, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v)] + [(500, None)], "row_id long, embedding array<float>")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.6
    gone = set()
    for a in sorted(set(ids)):
        if a not in gone:
            gone |= {ids[j] for i in range(160) if ids[i] == a for j in np.flatnonzero(near[i]).tolist()} - {a}
    kept = vectors.greedy_keep_all(df, 0.6, block_rows=block_rows).where("kept").collect()
    assert {r.row_id for r in kept} == (set(ids) | {500}) - gone
