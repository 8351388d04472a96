"""Every registered query with SQL against DuckDB on the smallest tables; the others give rows."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
CORE = sorted(n for n in entry.queries() if not n.startswith(("op", "pipeline")))


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name in entry.oracle_sql():
        r = duck.sql(entry.oracle_sql()[name])
        at = [r.columns.index(c) for c in cols]
        assert sorted(r.columns) == cols and rows == sorted(tuple(plain(x[i]) for i in at) for x in r.fetchall())
    assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
