"""Slices by counted rows, one-pass sweeps against comparisons of relations, horizons, and averages below zero."""

import warnings

import pytest
from pyspark.sql import functions as F

from aerolith.functions import telemetry as fn
from aerolith.operators import control, store, windows
from aerolith.operators.slices import sliced
from aerolith.sources import synthetic
from aerolith.streaming.machine import WatermarkMachine

S = 1_000_000
MINUTE = 60 * S
CHAOS = synthetic.Chaos(out_of_order=0.4, max_skew_s=20, duplicates=0.1, late=0.02, late_s=100)


@pytest.fixture(scope="module")
def fleet(spark):
    return synthetic.fleet(spark, 12, 300, 11, CHAOS).withColumn("alt_cm", F.col("alt_cm") - 400_000).cache()


def test_one_hour_is_many_slices(spark, fleet):
    cut, n = sliced(fleet, "ingest_us", "k", S, 100)
    sizes = {r.k: r["count"] for r in cut.groupBy("k").count().collect()}
    assert n == len(sizes) and n > 20 and max(sizes.values()) < 200 and sum(sizes.values()) == fleet.count()
    assert cut.groupBy("k").agg(F.min("ingest_us").alias("a"), F.max("ingest_us").alias("b")).orderBy("k").selectExpr("a > lag(b) over (order by k) as x").filter("not x").count() == 0
    cells = ["icao24", "event_us", "copy", "mark_us", "frontier_us", "is_late"]
    one = windows.annotate(fleet, range(6), MINUTE, 10 * S).select(*cells)
    many = windows.annotate(fleet, range(6), MINUTE, 10 * S, S, 100).select(*cells)
    assert one.exceptAll(many).isEmpty() and one.count() == many.count()
    order = list(windows.ORDER)
    logs = [store.to_log(fleet, "cell", 3, order, slice_us=S, slice_rows=r).select("icao24", "event_us", "copy", "partition", "offset") for r in (100, 10**6)]
    assert logs[0].exceptAll(logs[1]).isEmpty() and logs[0].count() == logs[1].count()


def test_sweep_and_headline_equal_comparisons(spark, fleet):
    truth = windows.ground_truth(fleet, MINUTE)
    bounds = [0, 2_500_000, 20 * S]
    got = {r.bound_us: r for r in windows.sweep(windows.annotate(fleet, range(6), MINUTE, 0), MINUTE, bounds).collect()}
    for b in bounds:
        marked = windows.annotate(fleet, range(6), MINUTE, b)
        want = windows.roll_up(windows.compare(truth, windows.on_time_windows(marked, MINUTE))).first()
        assert (got[b].total, got[b].wrong, got[b].abs_count_error, got[b].late) == (want.total, want.wrong, want.abs_count_error, marked.filter("is_late").count())
    both = {r.bound_us: r for r in windows.report(windows.annotate(fleet, range(6), MINUTE, 0, slice_rows=None), MINUTE, bounds).collect()}
    assert {b: (r.total, r.wrong, r.late) for b, r in both.items()} == {b: (r.total, r.wrong, r.late) for b, r in got.items()}
    marked = windows.annotate(fleet, range(6), MINUTE, 5 * S)
    one = windows.headline(marked, MINUTE).first()
    naive = windows.roll_up(windows.compare(truth, windows.naive(fleet, MINUTE))).first()
    on_time = windows.roll_up(windows.compare(truth, windows.on_time_windows(marked, MINUTE))).first()
    assert (one.naive_wrong, one.naive_windows, one.watermark_wrong) == (naive.wrong, naive.total, on_time.wrong) and one.silent == 0
    assert {(r.events, r.misattributed, r.naive_wrong, r.naive_windows) for r in both.values()} == {(one.events, one.misattributed, one.naive_wrong, one.naive_windows)}
    assert (one.events, one.misattributed) == tuple(windows.misattributed(fleet, MINUTE).first())


@pytest.mark.parametrize("keep", [None, 0, 1, 3])
def test_outcomes_equal_the_machine(spark, fleet, keep):
    m, want = WatermarkMachine(MINUTE, 5 * S, keep), {}
    for r in sorted(fleet.collect(), key=lambda r: (r.ingest_us, r.icao24, r.event_us, r.copy)):
        what = m.offer(r.src, (r.icao24, r.event_us), r.cell, r.event_us, r.alt_cm, r.vel_cm)[0]
        want[r.icao24, r.event_us, r.copy] = what if isinstance(what, str) else what[0]
    got = {(r.icao24, r.event_us, r.copy): r.outcome for r in windows.outcomes(fleet, range(6), MINUTE, 5 * S, keep, S, 500).collect()}
    assert got == want


def test_averages_below_zero(spark):
    rows = [(-50000, 1), (-1, 1), (1, 1), (-100, 3), (100, 3), (0, 2), (-5, 8)]
    got = [r.m for r in spark.createDataFrame(rows, "t long, n long").select(fn.mean_4dp(F.col("t"), F.col("n")).alias("m")).collect()]
    assert got == [-500.0, -0.01, 0.01, -0.3333, 0.3333, 0.0, -0.0063]


def test_text_does_not_depend_on_the_time_zone(spark):
    df = spark.createDataFrame([(1_767_225_600_123_456,), (-1,)], "us long")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [tuple(r) for r in df.select(fn.iso_utc(F.col("us")), fn.iso_utc(F.col("us"), True)).collect()] == [
                ("2026-01-01T00:00:00+00:00", "2026-01-01T00:00:00.123456+00:00"), ("1969-12-31T23:59:59+00:00", "1969-12-31T23:59:59.999999+00:00"),
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_digest_is_that_of_all_lines(spark):
    import hashlib

    rows = spark.createDataFrame([(1_767_225_660_000_000, "b", 2, 1.5, 2.0), (1_767_225_600_000_000, "b", 1, -0.25, 3.0), (1_767_225_600_000_000, "a", 7, 1.0, 2.0)], "window_us long, cell string, n long, avg_altitude double, avg_velocity double")
    text = "2026-01-01T00:00:00+00:00|a|7|1.0000|2.0000\n2026-01-01T00:00:00+00:00|b|1|-0.2500|3.0000\n2026-01-01T00:01:00+00:00|b|2|1.5000|2.0000"
    assert windows.digest(rows).first().digest == hashlib.sha256(text.encode()).hexdigest()
    assert windows.tree_digest(rows.repartition(3)).first() == windows.tree_digest(rows).first()


def test_short_retention_warns():
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert windows.minimum_retention(60, 60, 2) == 2 and not told
        windows.minimum_retention(60, 60, 1)
    assert len(told) == 1


def test_tables_lose_days_and_rows(spark, tmp_path):
    path, day = f"file://{tmp_path}/t", store.DAY_US
    store.save_days(spark.createDataFrame([(i, i * day // 2, i % 3 if i else None) for i in range(20)], "id long, event_us long, k long"), path)
    assert store.drop_days(spark, path, "1970-01-03") == 2 and spark.read.parquet(path).count() == 16
    assert store.delete_where(spark, path, F.col("k") == 1) == 6 and spark.read.parquet(path).count() == 10
    assert store.delete_where(spark, path, F.col("k") == 7) == 0
    store.truncate(spark, path)
    assert spark.read.parquet(path).count() == 0


def test_simulated_arms(spark):
    """The adaptive arm drains a burst that the static one does not; at a steady load it does nothing."""
    static, adaptive = control.simulate(adaptive=False), control.simulate()
    rows = [("static", x) for x in static] + [("adaptive", x) for x in adaptive]
    df = spark.createDataFrame([(r, x["at"], x["lag"], x["published"], x["shed"], x["action"]) for r, x in rows], "run string, at double, lag long, published long, shed long, action string")
    got = {r.run: r for r in control.analyse(df, 200, 50, 2.0).collect()}
    assert got["static"].final_lag > 10_000 and got["static"].stabilise_s is None and got["adaptive"].final_lag == 0 and got["adaptive"].absorbed_pct == 100.0
    assert got["adaptive"].peak_lag < got["static"].peak_lag and got["adaptive"].stabilise_s is not None
    assert {r.run: r.actions for r in control.actions_before(df, 15).collect()} == {"static": 0, "adaptive": 0}
    capped = control.simulate(config=control.ControllerConfig(cooldown_s=6.0, max_workers=2))
    assert sum(x["shed"] for x in capped) > 0 and capped[-1]["lag"] == 0
