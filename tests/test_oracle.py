"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, normal
from gleaner_queries.oracle import ORACLE
from gleaner_queries.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    frame = QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # No query multiplies two tables.
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = frame.toPandas()
    expected = con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert normal(got) == normal(expected)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())
