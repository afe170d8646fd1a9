"""Corpus queries that SQL can express, against DuckDB on sf0.001."""

import duckdb
import pytest

from dividax.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    expected = con.sql(queries.oracle_sql()[name])
    found = queries.queries()[name](spark, SF).select(*expected.columns)
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())
