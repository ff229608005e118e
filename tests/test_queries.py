"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
BASE = sorted(n for n in entry.base.queries())


def cell(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    return f"{float(v):.5f}" if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for n in NAMES:
        c.sql(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", BASE)
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF)
    cols = sorted(got.columns)
    rows = sorted((tuple(cell(r[c]) for c in cols) for r in got.collect()), key=repr)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(cols) == len(set(cols))
        return
    want = con.sql(sql)
    at = [want.columns.index(c) for c in cols]
    assert rows == sorted((tuple(cell(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).columns == ["scope", "n_frames", "mean_view", "mean_click"]
