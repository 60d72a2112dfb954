"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import datetime
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (datetime.datetime, pd.Timestamp)):
        return str(pd.Timestamp(v))
    return float(v) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def table_of(columns, rows):
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    return order, sorted((tuple(plain(r[i]) for i in at) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cur = duck.execute(SQL[name])
    expected = table_of([c[0] for c in cur.description], cur.fetchall())
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_sql_is_only_given_for_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 20
