"""Every query of the catalogue against its SQL on whole tables."""

import decimal
import math

import duckdb
import pytest

from corpuskit.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if isinstance(v, float) and math.isnan(v) else round(float(v), 5)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in want] or got == want


def test_registry(spark):
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and set(QUERIES) <= set(queries)
    first = entry.entry(spark)
    assert first.columns == ["row_id", "hash", "kept"] and first.count() == 200
