"""Every arrival has its place."""

import duckdb
import pytest

from aerolith.operators import store, windows
from aerolith.plans.flights import arrivals, sql

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("slice_us", [3_600_000_000, 24 * 3_600_000_000])
def test_all_arrivals_are_numbered(spark, slice_us):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    want = con.execute(sql("SELECT event_id, copy, row_number() OVER (ORDER BY ingest_us, icao24, event_us, copy) FROM arrivals")).fetchall()
    got = store.arrival_order(arrivals(spark, SF), list(windows.ORDER), slice_us, 20).select("event_id", "copy", "at").collect()
    assert len(want) > 10_000 and sorted(map(tuple, got)) == sorted(want)
