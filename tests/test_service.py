"""Live sinks under replay, polling and retry, settings, results."""

import json

import pytest
from pyspark.sql import functions as F

from aerolith.config import Settings
from aerolith.functions import telemetry as fn
from aerolith.operators import results
from aerolith.sources.poller import Backoff, Response, poll, vectors, with_retry
from aerolith.streaming import service


def test_latest_table_under_replay(spark, tmp_path):
    path, sink = f"file://{tmp_path}/latest", service.latest_sink(f"file://{tmp_path}/latest")
    rows = lambda *r: spark.createDataFrame(list(r), "cell string, window_us long, n long")
    assert service.read_latest(spark, path).count() == 0
    sink(rows(("a", 60, 5), ("b", 0, 2)), 0)
    for _ in range(2):
        sink(rows(("a", 0, 9), ("b", 60, 1)), 1)
    assert {tuple(r) for r in service.read_latest(spark, path).collect()} == {("a", 60, 5), ("b", 60, 1)}
    assert service.read_latest(spark, path, "a").count() == 1


def test_late_total_under_replay_and_restart(spark, tmp_path):
    path = f"file://{tmp_path}/late"
    late = lambda n: spark.range(n).select(F.lit(0).cast("long").alias("src"))
    for batch, n in ((0, 3), (1, 7), (1, 7), (2, 2)):
        service.late_total_sink(path)(late(n), batch)
    assert service.late_totals(spark, path).first().late == 12


def test_split_by_contract(spark):
    df = spark.createDataFrame([("3d10d0", "A", 0.0, 0.0, 0.0, 0.0, 0.0), ("bad", "A", 0.0, 0.0, 0.0, 0.0, 400.0)], "icao24 string, callsign string, lat double, lon double, altitude_m double, velocity_ms double, heading double")
    good, bad = service.split_valid(df.withColumns({c: F.current_timestamp() for c in ("event_time", "ingest_time")}), fn.violations())
    assert good.count() == 1 and bad.first().error == "icao24,heading"


def test_poller():
    answers = iter([Response(200, "a"), Response(429, retry_after_s=7.0), Response(503), TimeoutError(), Response(200, "b"), Response(503)])

    def fetch():
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    waits = []
    assert list(poll(fetch, 10.0, Backoff(draw=lambda: 0.5), waits.append, polls=6)) == ["a", "b"]
    assert waits == [10.0, 7.0, 2.0, 4.0, 10.0, 1.0]
    with pytest.raises(ValueError):
        list(poll(lambda: Response(401), 1.0, Backoff(), waits.append, polls=1))


def test_vectors(spark):
    body = json.dumps({"states": [["3d10d0", "FL1", "X", 100, 100, 5.0, 10.0, 900.0, False, 200.0, 90.0, 0, None, 950.0], ["x"]]})
    assert sorted(r.outcome for r in vectors(spark, body).collect()) == ["emitted", "malformed"]


def test_retry():
    calls, waits = [], []

    def act():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError
        return "done"

    assert with_retry(act, sleep=waits.append, draw=lambda: 0.5) == "done" and waits == [0.2, 0.4]
    with pytest.raises(TimeoutError):
        with_retry(lambda: (_ for _ in ()).throw(TimeoutError()), sleep=waits.append)


def test_settings():
    s = Settings.from_env({"WINDOW_S": "10", "ALLOWED_LATENESS_S": "2.5", "IDLE_TIMEOUT_S": ""})
    assert (s.window_us, s.lateness_us, s.partitions) == (10_000_000, 2_500_000, 6)
    for bad in ({"window_s": 0}, {"idle_timeout_s": 30.0}, {"shed_fraction": 1.5}, {"retention_days": 0}, {"allowed_lateness_s": -1.0}):
        with pytest.raises(ValueError):
            Settings(**bad)


def test_results(spark, tmp_path):
    ids = {results.record(spark, f"file://{tmp_path}/runs", "arm", {"p99": v, "lag": 1}) for v in (3.0, 1.0, 2.0)}
    table = results.runs(spark, f"file://{tmp_path}/runs")
    got = {r.metric: r for r in results.summarise(table).collect()}
    assert (got["p99"].n, got["p99"].median, got["lag"].stdev) == (3, 2.0, 0.0) and {r.run for r in table.collect()} == ids
    assert results.render(spark.range(2)).splitlines()[-1] == "| 1 |" and "Range" in results.plan(spark.range(2))
    told = results.measured_plan(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count().filter("k < 2"))
    assert any("Aggregate" in name and rows == 2 for _, name, rows in told) or any("Filter" in name and rows == 2 for _, name, rows in told)
