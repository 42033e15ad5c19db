"""Every registered query against its SQL, on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as registered

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, sql, name):
    df = registered.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    text = registered.oracle_sql().get(name)
    if text is None:
        assert got
        return
    found = sql.execute(text)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert registered.entry(spark).count() == 1500


def test_buckets_hold_every_row(spark):
    df = registered.queries()["bucket_sizes"](spark, FOLDER)
    rows = df.collect()
    assert sum(r.n for r in rows) == 1500 and all(0 <= r.bucket < 16 for r in rows)
