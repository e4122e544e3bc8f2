"""Every registered query against its SQL on the smallest tables; no plan has a cross join."""
import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def no_cross_join(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    status, rows, _, note = compare(spark, con, name, entry.queries()[name], SQL.get(name), FOLDER, inspect=no_cross_join)
    assert status in ("ok", "rows only"), note


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert "avg_fleet_health_score" in df.columns and df.count() > 0
