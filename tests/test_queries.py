"""Every registered query against its check SQL at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from ratelake.plans import load_all

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = dict(load_all().queries), dict(load_all().oracles)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_a_check():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(str(row[i]) for i in order) for row in result.fetchall())
