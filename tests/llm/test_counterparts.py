"""Registered queries against their SQL."""

import duckdb
import pytest

from satchel.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query(spark, name):
    oracle = duckdb.connect()
    for table in ("documents", "embeddings"):
        oracle.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    result = oracle.execute(queries.ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(repr(tuple(row[c] for c in names)) for row in df.collect())
    assert got == sorted(map(repr, result.fetchall())) and got
