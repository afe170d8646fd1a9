"""Driver-style check: every registered query against its DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry_module
from dividax.plans import queries as library
from scripts.check_oracle import TABLES, rows_of

QUERIES = library.queries()
SQL = library.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(SQL[name])
    d_names, d_rows = rel.columns, rel.fetchall()
    assert sorted(sdf.columns) == sorted(d_names)
    assert len(s_rows) == len(d_rows)
    assert rows_of(sdf.columns, s_rows) == rows_of(d_names, d_rows)


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "tax_due_pln" in df.columns
