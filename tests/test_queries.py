"""Every registered query against its DuckDB equivalent on small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from kinetrail import queries as core

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(([norm(r[i]) for i in order] for r in data), key=repr)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, duck, name):
    df = core.QUERIES[name](spark, DIR)
    got = [tuple(r) for r in df.collect()]
    if name not in core.ORACLE_SQL:
        assert got
        return
    res = duck.execute(core.ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(cols) == sorted(df.columns)
    assert rows(df.columns, got) == rows(cols, want)


def test_entry(spark):
    assert entry.entry(spark).count() == 25


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
