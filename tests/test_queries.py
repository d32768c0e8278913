"""Every registered query against its SQL counterpart."""

import duckdb
import pytest

import __spark_entry__ as contract
from satchel.plans.queries import QUERIES
from tests.conftest import SMALL, plan_of

TABLES = "customer orders events documents pages".split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, SMALL)
    result = oracle.execute(contract.oracle_sql()[name])
    order = sorted(df.columns)
    assert sorted(column[0] for column in result.description) == order
    at = [[column[0] for column in result.description].index(c) for c in order]
    expected = sorted(repr([row[i] for i in at]) for row in result.fetchall())
    got = sorted(repr([row[c] for c in order]) for row in df.collect())
    assert got == expected and got


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_pairs_rows_up(spark, name):
    plan = plan_of(contract.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0
