"""Every warehouse query against its SQL oracle (DuckDB) on the smallest
test tables: same columns, same row count, same values in any order. The
corpus operators, most of which SQL can't express, have their own tests."""

import datetime as dt
import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidewater.plans.registry import ORACLE, QUERIES
from tidewater.sources.testdata import TEST_TABLES

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canon(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    assert entry(spark).count() >= 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    got = canon([tuple(norm(r[c]) for c in cols) for r in sdf.collect()])
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = canon([tuple(norm(r[i]) for i in idx) for r in res.fetchall()])
    assert got == want
