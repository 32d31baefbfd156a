"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from tables import SF
from corpusflow.queries import QUERIES

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_key_has_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    good, note = compare(df, con, SQL[name])
    assert good, note


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"query_id", "id", "rank", "score"}
