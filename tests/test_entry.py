"""The driver's contract: every query against its SQL twin, and what no plan may hold."""

import pytest

import __spark_entry__ as entry
from workload.compare import connect, difference

# The training-data queries have tests of their own.
QUERIES, ORACLES = dict(entry.registry.SPARK), dict(entry.registry.SQL)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_flagship(spark):
    df = entry.entry(spark)
    assert sorted(df.columns) == ["category", "total_revenue", "year"] and df.count() > 0


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) > 200


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(duck, df, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonRDD", "EvalPython"):
        assert operator not in plan
