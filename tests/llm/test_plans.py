"""Native operators hold no Python, no operator pairs everything with everything, and scans read only the columns they need."""

import re

import pytest

from corpuskit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NATIVE = ("op1_source_mixing", "op2_secret_scan")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoopJoin", plan)
    if name in NATIVE:
        assert not re.search("Python|Pandas|Arrow", plan)
    for schema in re.findall(r"documents\.parquet.*?ReadSchema: (struct<[^\n]*)", plan):
        assert "n_chars" not in schema


def test_repeated_runs_agree(spark):
    for name in ("op1_source_mixing", "op10_best_fit_packing", "op3_simhash_near_dedup"):
        a, b = (sorted(map(str, QUERIES[name](spark, SF).collect())) for _ in range(2))
        assert a == b
