"""Window rules on hand-built cases, and the batch plan against a sequential evaluator on generated streams."""

import pytest
from pyspark.sql import functions as F

from aerolith.operators import store, windows
from aerolith.sources import synthetic
from aerolith.streaming.machine import WatermarkMachine

T0 = 1_767_225_600_000_000
S = 1_000_000
MINUTE = 60 * S
SCHEMA = "icao24 string, event_us long, ingest_us long, cell string, src long, alt_cm long, vel_cm long, copy int"


def arrivals(spark, events, cell="10:-1"):
    """events: (offset s, arrival s, altitude[, source]); each of an aircraft of its own per offset."""
    seen, rows = {}, []
    for e in events:
        offset, arrival, alt, src = (*e, 0)[:4]
        copy = seen[offset, src] = seen.get((offset, src), -1) + 1
        rows.append((f"{src:02d}{offset:04d}", T0 + offset * S, T0 + arrival * S, cell, src, alt * 100, 20000, copy))
    return spark.createDataFrame(rows, SCHEMA)


def result(df):
    return {(r.window_us - T0) // MINUTE: (r.n, r.avg_altitude) for r in df.collect()}


DELAYED = [(10, 10, 1000), (20, 20, 2000), (50, 90, 9000)]


def test_delay_across_a_boundary(spark):
    a = arrivals(spark, DELAYED)
    assert result(windows.ground_truth(a, MINUTE)) == {0: (3, 4000.0)}
    assert result(windows.naive(a, MINUTE)) == {0: (2, 1500.0), 1: (1, 9000.0)}
    marked = windows.annotate(a, [0], MINUTE, 0)
    assert result(windows.on_time_windows(marked, MINUTE)) == {0: (3, 4000.0)}
    assert marked.filter("is_late").count() == 0


def test_delay_alone_is_not_lateness(spark):
    a = arrivals(spark, [(o, o + 500, 100) for o in (0, 10, 20, 30, 40)])
    assert windows.annotate(a, [0], MINUTE, 0).filter("is_late").count() == 0


@pytest.mark.parametrize("copies, lateness, late, counted", [(1, 30, 1, 4), (2, 30, 1, 4), (1, 200, 0, 5)])
def test_side_output(spark, copies, lateness, late, counted):
    a = arrivals(spark, [(10, 10, 1000), (20, 20, 2000), (200, 200, 1), (210, 210, 1)] + [(55, 260, 9000)] * copies)
    marked = windows.annotate(a, [0], MINUTE, lateness * S)
    got = windows.late_events(marked).collect()
    assert len(got) == late and sum(n for n, _ in result(windows.on_time_windows(marked, MINUTE)).values()) == counted
    if late:
        assert (got[0].window_us, got[0].lateness_us) == (T0, 180 * S)
    one = windows.accounting(a, marked).first()
    assert one.windowed + one.late == one.processed and one.processed + one.duplicates == one.arrived and one.duplicates == copies - 1


def test_window_closes_on_its_end(spark):
    a = arrivals(spark, [(5, 5, 1), (70, 70, 1), (30, 80, 1)])
    assert windows.annotate(a, [0], MINUTE, 10 * S).filter("is_late").count() == 1
    assert windows.annotate(a, [0], MINUTE, 11 * S).filter("is_late").count() == 0


def test_compare_counts_each_kind(spark):
    a = arrivals(spark, DELAYED)
    one = windows.roll_up(windows.compare(windows.ground_truth(a, MINUTE), windows.naive(a, MINUTE))).first()
    assert (one.total, one.wrong, one.phantom, one.missing, one.count_mismatch, one.worst) == (2, 2, 1, 0, 1, 1)


def machine_windows(rows, lateness_us):
    m, out, late = WatermarkMachine(MINUTE, lateness_us), [], set()
    for r in sorted(rows, key=lambda r: (r.ingest_us, r.icao24, r.event_us, r.copy)):
        what, closed = m.offer(r.src, (r.icao24, r.event_us), r.cell, r.event_us, r.alt_cm, r.vel_cm)
        out += closed
        if what[0] == "late":
            late.add((r.icao24, r.event_us, what[2]))
    return {k: tuple(x) for k, x in out + m.close()}, late, m


@pytest.mark.parametrize("lateness_s", [0, 10, 20, 40])
def test_batch_plan_equals_the_machine(spark, lateness_s):
    chaos = synthetic.Chaos(out_of_order=0.4, max_skew_s=20, duplicates=0.05, late=0.02, late_s=100)
    rows = synthetic.fleet(spark, 12, 300, 11, chaos).cache()
    # slices far shorter than the stream, so that what they carry matters
    marked = windows.annotate(rows, range(6), MINUTE, lateness_s * S, slice_us=37 * S, slice_rows=100)
    got = marked.filter("not is_late").groupBy("window_us", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("alt_cm").alias("a"), F.sum("vel_cm").alias("v")).collect()
    want, late, m = machine_windows(rows.collect(), lateness_s * S)
    assert {(r.window_us, r.cell): (r.n, r.a, r.v) for r in got} == want
    assert {(r.icao24, r.event_us, r.watermark_us) for r in windows.late_events(marked).collect()} == late
    one = windows.accounting(rows, marked).first()
    assert (one.processed, one.duplicates, one.late, one.final_watermark_us) == (m.processed, m.duplicates, m.late, m.frontier)
    if lateness_s == 0:
        assert store.inversions(rows, slice_us=37 * S, slice_rows=100).first().inversions == store.inversions(rows).first().inversions > 0


def test_digest_does_not_depend_on_partitions(spark):
    rows = synthetic.fleet(spark, 10, 120, 5, synthetic.Chaos(out_of_order=0.25, max_skew_s=15))
    digest = lambda r: windows.digest(windows.on_time_windows(windows.annotate(r, range(6), MINUTE, 30 * S), MINUTE)).first()
    one, six = digest(rows.repartition(1)), digest(rows.repartition(6))
    assert one == six and one.windows > 0
    assert digest(rows.withColumn("alt_cm", F.col("alt_cm") + (F.col("event_us") == T0).cast("long") * 100)).digest != one.digest


def test_machine_sources_idle_and_awaited():
    m = WatermarkMachine(MINUTE, 10 * S, idle_after_us=30 * S)
    m.offer("p1", "a", "c", 5 * S, 1, 1, now_us=0)
    _, closed = m.offer("p0", "b", "c", 200 * S, 1, 1, now_us=0)
    assert closed == [] and m.tick(29 * S) == []
    m.heard_at["p0"] = 25 * S
    assert [k[0] for k, _ in m.tick(30 * S)] == [0]
    assert m.offer("p1", "c", "c", 20 * S, 1, 1, now_us=31 * S)[0][0] == "late"
    with pytest.raises(ValueError):
        WatermarkMachine(MINUTE, 10 * S, idle_after_us=5 * S)
    m = WatermarkMachine(MINUTE, 10 * S, awaited={"p0", "p1"})
    m.offer("p0", "a", "c", 500 * S, 1, 1)
    assert m.watermark is None and m.offer("p1", "b", "c", 10 * S, 1, 1)[0] == "counted"
    m = WatermarkMachine(MINUTE, 10 * S)
    m.offer("p0", "a", "c", 500 * S, 1, 1)
    assert m.offer("p1", "b", "c", 10 * S, 1, 1)[0][0] == "late"


def test_machine_forgets_keys_behind_its_horizon():
    for keep, want in ((5, "duplicate"), (0, "late")):
        m = WatermarkMachine(MINUTE, 0, keep_windows=keep)
        m.offer("p", "a", "c", 10 * S, 1, 1)
        m.offer("p", "b", "c", 190 * S, 1, 1)
        what = m.offer("p", "a", "c", 10 * S, 1, 1)[0]
        assert what == want or what[0] == want
    assert [windows.minimum_retention(a, b) for a, b in ((30, 60), (60, 60), (45, 10))] == [2, 2, 6]


def test_safe_offsets(spark):
    """A restart begins at the first event of a window that is still open, or at what comes next."""
    log = spark.createDataFrame([("p0", 5, 0), ("p0", 6, 1), ("p1", 2, 1), ("p2", 1, 1), ("p2", 2, 0), ("p3", 9, 0)], "partition string, offset long, window long")
    for closed, want in ((-1, {"p0": 5, "p1": 2, "p2": 1, "p3": 9}), (0, {"p0": 6, "p1": 2, "p2": 1, "p3": 10}), (1, {"p0": 7, "p1": 3, "p2": 3, "p3": 10})):
        assert {r.partition: r.safe for r in windows.safe_offsets(log, F.col("window") > closed).collect()} == want
