"""Registered queries against their SQL oracle on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from heightgrid.catalog.views import BASE

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


def sortable(row):
    return tuple((v is None, str(type(v)) if isinstance(v, str) else "", v if v is not None else 0) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=sortable)
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=sortable)
    assert got == want


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
