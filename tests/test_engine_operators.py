"""Stores, sources, predicates and control."""

import pytest
from pyspark.sql import functions as F

from aerolith.functions import telemetry as fn
from aerolith.operators import control, store
from aerolith.sources import filelog, positional
from aerolith.streaming import native

GOOD = dict(icao24="3d10d0", callsign="A", lat=0.0, lon=0.0, altitude_m=-500.0, velocity_ms=0.0, heading=359.999)


@pytest.mark.parametrize(
    "change, broken",
    [({}, []), ({"icao24": "3D10D0"}, ["icao24"]), ({"icao24": "3d10d"}, ["icao24"]), ({"icao24": "3d10d0\n"}, ["icao24"]), ({"callsign": ""}, ["callsign"]), ({"callsign": "TOOLONG99"}, ["callsign"]), ({"lat": float("nan")}, ["lat"]), ({"lon": float("inf")}, ["lon"]), ({"altitude_m": -500.1}, ["altitude_m"]), ({"velocity_ms": -0.1, "heading": 360.0}, ["velocity_ms", "heading"]), ({"heading": None}, ["heading"])],
)
def test_contract(spark, change, broken):
    row = GOOD | change
    df = spark.createDataFrame([tuple(row.values())], "icao24 string, callsign string, lat double, lon double, altitude_m double, velocity_ms double, heading double").withColumns({c: F.current_timestamp() for c in ("event_time", "ingest_time")})
    assert df.select(fn.violations().alias("v")).first().v == broken


def test_cells_and_boxes(spark):
    df = spark.createDataFrame([(51.4, -0.1), (53.9, -4.9), (56.0, -0.1)], "lat double, lon double")
    assert [r.c for r in df.select(fn.grid_cell(F.col("lat"), F.col("lon")).alias("c")).collect()] == ["10:-1", "10:-1", "11:-1"]
    assert fn.parse_box("-10,-60,30,45") == (-10, -60, 30, 45)
    for bad in ("1,2,3", "30,0,10,5", "0,0,95,5"):
        with pytest.raises(ValueError):
            fn.parse_box(bad)


VECTOR = ["3d10d0", "FL1", "X", 100, 100, 5.0, 10.0, 900.0, False, 200.0, 90.0, 0, None, 950.0]


@pytest.mark.parametrize(
    "changes, outcome, want",
    [
        ({5: None}, "skipped", {}), ({3: None}, "skipped", {}), ({7: None}, "emitted", {"altitude_m": 950.0, "substituted": True, "repaired": False}),
        ({7: None, 13: None}, "emitted", {"altitude_m": 0.0, "repaired": True}), ({7: None, 13: None, 8: True}, "emitted", {"altitude_m": 0.0, "repaired": False}),
        ({9: None, 10: None}, "emitted", {"velocity_ms": 0.0, "heading": 0.0, "repaired": True}), ({1: "  "}, "emitted", {"callsign": "3d10d0"}), ({1: None}, "emitted", {"callsign": "3d10d0"}),
        ({10: 360, 5: 185, 9: -3}, "emitted", {"heading": 0.0, "lon": -175.0, "velocity_ms": 0.0}), ({7: -9000}, "malformed", {}), ({0: "ZZ"}, "malformed", {}), ({6: "north"}, "malformed", {}), ({3: 1e18}, "malformed", {}),
    ],
)
def test_positional_rows(spark, changes, outcome, want):
    import json

    row = list(VECTOR)
    for k, v in changes.items():
        row[k] = v
    got = positional.parse_states(spark.createDataFrame([(json.dumps(row),)], "value string")).first()
    assert got.outcome == outcome and {k: got[k] for k in want} == want


def test_truncated_vector_and_other_json(spark):
    got = positional.parse_states(spark.createDataFrame([('["a"]',), ('{"a": 1}',), (None,)], "value string")).collect()
    assert [r.outcome for r in got] == ["malformed"] * 3


def log_rows(spark, n=40):
    return store.to_log(spark.range(n).select((F.col("id") * 3_600_000_000 * 7).alias("ingest_us"), F.concat(F.lit("c"), F.col("id") % 5).alias("cell"), "id"), "cell", 3, ["ingest_us", "id"])


def test_sealed_read(spark):
    log = log_rows(spark)
    ends = store.partition_stats(log).select("partition", "begin_offset", "end_offset")
    assert store.sealed(log, ends).count() == 40
    assert [(r.begin_offset, r.end_offset == r.messages) for r in store.partition_stats(log).collect()] == [(0, True)] * ends.count()
    with pytest.raises(store.IncompleteStream):
        store.sealed(log.filter("id <> 17"), ends)
    with pytest.raises(store.IncompleteStream):
        store.sealed(log, ends.limit(0))


def test_log_on_files_and_dead_letters(spark, tmp_path):
    filelog.publish(log_rows(spark), f"file://{tmp_path}", "states")
    log = filelog.read(spark, f"file://{tmp_path}", "states")
    cut = log.withColumn("value", F.when(F.col("offset") == 2, F.lit('{"id":')).otherwise(F.col("value")))
    good, dead = filelog.decode(cut, "id long, cell string")
    assert good.count() + dead.count() == 40 and dead.count() == cut.filter("offset = 2").count() > 0
    with pytest.raises(ValueError):
        filelog.open_source(spark, "none")


def test_insert_is_idempotent_and_first_wins(spark):
    batch = spark.createDataFrame([("a", 1, 5), ("a", 1, 3), ("b", 1, 9)], "icao24 string, event_us long, at long")
    first = store.new_rows(batch.limit(0), batch, ["icao24", "event_us"], ["at"])
    assert sorted(map(tuple, first.collect())) == [("a", 1, 3), ("b", 1, 9)]
    assert store.new_rows(first, batch, ["icao24", "event_us"], ["at"]).count() == 0


def test_latest_refuses_what_is_older(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "cell string, window_us long, n long")
    got = store.latest_wins(rows(("a", 60, 5), ("b", 60, 5), ("c", 60, 5)), rows(("a", 0, 9), ("b", 60, 4), ("c", 60, 5), ("d", 0, 1)))
    assert {r.cell: (r.window_us, r.n, r.replaced) for r in got.collect()} == {"a": (60, 5, False), "b": (60, 5, False), "c": (60, 5, True), "d": (0, 1, True)}


def test_lag(spark):
    ends = spark.createDataFrame([(0, 100), (1, 50), (2, None)], "partition int, end_offset long")
    done = spark.createDataFrame([(0, 70), (1, 55)], "partition int, committed long")
    assert [r.lag for r in store.partition_lag(ends, done).orderBy("partition").collect()] == [30, 0, None]


def test_summary(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("a", 2.0), ("a", 10.0), ("b", 5.0)], "arm string, v double")
    a, b = store.summary(df, "v", ["arm"]).orderBy("arm").collect()
    assert (a.n, a.median, a.least, a.most) == (4, 2.5, 1, 10) and abs(a.stdev - 4.08) < 0.1 and (b.n, b.stdev) == (1, 0)


def samples(spark, lags, dt=2.0):
    return spark.createDataFrame([(0, i * dt, x) for i, x in enumerate(lags)], "run long, at double, lag long")


def test_trend(spark):
    last = control.trend(samples(spark, [0, 10, 20], 1.0)).orderBy(F.desc("at")).first()
    assert last.slope == 10.0 and last.t_stat > 1e6
    spike = control.trend(spark.createDataFrame([(0, float(a), b) for a, b in ((0, 0), (1, 10), (2, 20), (3, 300))], "run long, at double, lag long")).orderBy(F.desc("at")).first()
    assert 90 < spike.slope < 100 and spike.t_stat < 3
    assert control.trend(samples(spark, [5, 5])).filter("slope is not null").count() == 0


CONFIG = dict(window_samples=4, cooldown_s=4.0)


def actions(spark, lags, **config):
    return [r.action for r in control.decide(samples(spark, lags), control.ControllerConfig(**(CONFIG | config))).orderBy("at").collect()]


def test_controller(spark):
    assert "scale_up" in actions(spark, range(300, 900, 100)) and "scale_up" in actions(spark, [200, 260, 330, 400, 470])
    assert set(actions(spark, range(5000, 1000, -800))) == {"hold"}
    assert actions(spark, [300 + 300 * i for i in range(8)], cooldown_s=20.0).count("scale_up") == 1
    got = actions(spark, [500 + 400 * i for i in range(20)], max_workers=2, cooldown_s=0.0)
    assert got.index("scale_up") < got.index("shed") and got.count("shed") == 1


def test_stabilised(spark):
    lags = [500, 400, 150, 900, 100, 90, 80, 70]
    assert control.stabilised(samples(spark, lags), 200).first().stable_at == 8.0
    assert control.stabilised(samples(spark, [500, 400]), 200).first().stable_at is None


def test_token_bucket(spark):
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate([0.0, 0.0, 0.0, 1.0, 0.5, 10.0, 10.0])], "client long, at double, seq long")
    got = [r.allowed for r in control.token_bucket(df, 1.0, 2.0).orderBy("at", "seq").collect()]
    assert got == [True, True, False, False, True, True, True]


def test_shedding_is_by_cell(spark):
    df = spark.range(2000).select((F.col("id") % 200).cast("string").alias("cell"))
    kept = df.withColumn("k", fn.kept_when_shedding(F.col("cell"), 0.25))
    assert kept.groupBy("cell").agg(F.countDistinct("k").alias("n")).filter("n > 1").count() == 0
    assert abs(kept.filter("not k").count() / 2000 - 0.25) < 0.15
    assert df.filter(fn.kept_when_shedding(F.col("cell"), 0.0)).count() == 2000


def test_stream_goes_on_after_a_stop(spark, tmp_path):
    """Two runs with one checkpoint give what one run gives, and nothing twice."""
    src, out, check = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    schema = "icao24 string, event_us long, ingest_us long, cell string, alt_cm long, vel_cm long"
    rows = [(f"a{i % 7}", i * 1_000_000, i * 1_000_000, "0:0", 100, 100) for i in range(400)]
    part = lambda a, b: spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(src)
    for a, b in ((0, 200), (200, 400)):
        part(a, b)
        stream = spark.readStream.schema(schema).parquet(src)
        native.run_to_end(native.streaming_windows([stream], 60_000_000, 10_000_000), native.append_new(out, ["window_us", "cell"]), check)
    got = {r.window_us // 60_000_000: r.n for r in spark.read.parquet(out).collect()}
    assert got == {k: 60 for k in range(6)} and spark.read.parquet(out).count() == 6
