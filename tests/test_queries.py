"""Every registered query runs on the smallest tables; those with SQL give the same rows there."""

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return float(v) if isinstance(v, decimal.Decimal) else v


def test_every_sql_has_a_query():
    assert not SQL.keys() - QUERIES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_query_without_sql_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    rows = df.collect()
    assert rows or name in ("p2_changes",), "no row"
    assert len(set(df.columns)) == len(df.columns) and all(len(r) == len(df.columns) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert Counter(tuple(plain(v) for v in r) for r in df.select(*columns).collect()) == want
