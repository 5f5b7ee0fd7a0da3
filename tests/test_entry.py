"""The driver's contract, and every query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from aerolith.plans import queries as base

SF = "/root/testdata/sf0.001"
SLOW = {"w4n_stream", "w4x_stream", "r6_lateness_sweep", "r5_recorded_replay", "r3_replay"}


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(rows):
    def one(x):
        return round(x, 6) + 0.0 if isinstance(x, float) else x

    return sorted((tuple(map(one, r)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(set(base.ORACLES) - SLOW))
def test_query_equals_sql(spark, duck, name):
    got = base.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert plain(map(tuple, got.select(*columns).collect())) == plain(want)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0
