"""Every registered query against its DuckDB equivalent, on the smallest tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from seriesflow.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def compare(spark, duck, sf_dir, f, sql):
    df = f(spark, sf_dir)
    names = sorted(df.columns)
    cur = duck.execute(sql)
    theirs = [c[0] for c in cur.description]
    assert sorted(theirs) == names
    want = sorted(tuple(shown(r[theirs.index(n)]) for n in names) for r in cur.fetchall())
    assert sorted(tuple(shown(r[n]) for n in names) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    compare(spark, duck, sf_dir, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_have_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_batches_hold_their_limits(spark, sf_dir):
    rows = QUERIES["stream_sink"](spark, sf_dir).collect()
    assert rows and all(r.in_limits and r.requests == r.points for r in rows)


def test_refreshed_samples_have_the_points_of_the_stream(spark, sf_dir):
    shown_of = lambda name: QUERIES[name](spark, sf_dir).filter("t is not null").select("seq", "series_key", "t", "start", "val", "value_type")
    got = sorted(map(tuple, shown_of("stream_refresh").collect()))
    assert got and got == sorted(map(tuple, shown_of("stream_points").collect()))


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert glob.glob("/root/testdata/sf0.001/*.parquet")
