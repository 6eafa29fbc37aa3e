"""Queries that SQL can express against their DuckDB twins."""

import pytest

from gridmart.llm import oracle, queries
from workload.compare import connect, difference


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(connect(sf_dir), queries.SPARK[name](spark, sf_dir), oracle.SQL[name]) is None


def test_a_query_is_registered_once():
    with pytest.raises(ValueError):
        queries.query(queries.op1_packing)
