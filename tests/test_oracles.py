"""Every registered query with a SQL twin agrees with DuckDB (row count,
column names, order-insensitive values) on the small tables."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.check_oracles import TABLES, digest

SQL = E.oracle_sql()
SKIP_SMALL = set()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(rel.columns, drows)


def test_every_query_has_a_callable():
    assert set(SQL) <= set(E.queries())
