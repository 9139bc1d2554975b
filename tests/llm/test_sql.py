"""The queries of the subpackage that SQL can express, against their SQL on whole tables."""

import duckdb
import pytest

from corpuskit.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(str, result.fetchall()))


def test_large_components_in_sql(spark, tmp_path):
    rows = [(0, [1.0, 1.0]), (1, [300000.0, 0.0]), (2, [1.0, 0.0]), (3, [-(2.0**21), 2.0**13]), (100, [2.0**20, 0.5])]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(1).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = {tuple(r) for r in duck.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLES['op6_topk_search']})").fetchall()}
    got = QUERIES["op6_topk_search"](spark, f"file://{tmp_path}").select("query_id", "rank", "vec_id", "score").collect()
    assert {tuple(r) for r in got} == want and len(want) == 8
