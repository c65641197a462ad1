"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry
from check_queries import compare
from conftest import DATA

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    problem, _ = compare(duck, QUERIES[name](spark, DATA), SQL[name])
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert {"transaction_id", "total_risk_score", "risk_level"} <= set(df.columns)
