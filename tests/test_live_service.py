"""The live service over a stream that stops and goes on, silent sources, and the streaming sources."""

import json

from pyspark.sql import functions as F

from aerolith.config import Settings
from aerolith.plans.streams import _rocks
from aerolith.sources import filelog, poller, synthetic
from aerolith.streaming import exact, native, service
from aerolith.streaming.machine import WatermarkMachine

S = 1_000_000
MINUTE = 60 * S
SCHEMA = "pipeline long, icao24 string, event_us long, ingest_us long, cell string, alt_cm long, vel_cm long, src long, copy int"


def feed(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def row(src, at, event=None, name=None):
    event = at if event is None else event
    return (0, name or f"{src}-{event}", event * S, at * S, f"{src}:0", 100, 200, src, 0)


def test_service_goes_on_after_a_stop(spark, tmp_path):
    source, path = f"file://{tmp_path}/in", f"file://{tmp_path}/service"
    rows = [row(k % 2, k) for k in range(400)]
    rows[150] = row(0, 150, 10, "late")
    with _rocks(spark):
        for a, b in ((0, 200), (200, 400)):
            stream = feed(spark, source, rows[a:b])
            service.serve(stream, path, Settings(window_s=60, allowed_lateness_s=5.0)).trigger(availableNow=True).start().awaitTermination()
    m, closed = WatermarkMachine(MINUTE, 5 * S), []
    for r in rows:
        closed += m.offer(r[7], (r[1], r[2]), r[4], r[2], r[5], r[6])[1]
    got = {(r.window_us, r.cell): (r.n, r.alt, r.vel) for r in service.read_windows(spark, path).collect()}
    assert got == {k: tuple(x) for k, x in closed} and m.late == 1
    assert service.late_totals(spark, f"{path}/late").agg(F.sum("late")).first()[0] == 1
    assert {r.cell: r.window_us for r in service.read_latest(spark, f"{path}/latest").collect()} == {c: max(w for w, x in got if x == c) for c in ("0:0", "1:0")}


def test_silent_sources_stop_holding_windows(spark, tmp_path):
    rows = [row(0, 0), row(1, 1)] + [row(0, k) for k in range(2, 400)] + [row(1, 401, 20, "back"), row(1, 402), row(0, 403), (0, "", 0, 404 * S, "", 0, 0, 0, 0)]
    expected = {}
    for idle in (None, 30 * S):
        m, closed, late = WatermarkMachine(MINUTE, 5 * S, 100, idle, awaited={0, 1}), [], 0
        for r in rows[:-1]:
            what, some = m.offer(r[7], (r[1], r[2]), r[4], r[2], r[5], r[6], r[3] if idle else None)
            closed, late = closed + some, late + (what[0] == "late")
        expected[idle] = ({k: tuple(x) for k, x in closed}, late)
    assert expected[None][1] == 0 and expected[30 * S][1] == 1 and len(expected[30 * S][0]) > 0
    with _rocks(spark):
        for idle in (None, 30 * S):
            stream = feed(spark, f"file://{tmp_path}/in{idle}", rows)
            out = f"file://{tmp_path}/out{idle}"
            native.run_to_end(exact.exact_windows(stream, MINUTE, 5 * S, 100, idle, (0, 1)), service.window_sink(out), f"file://{tmp_path}/check{idle}")
            got = spark.read.parquet(out).collect()
            assert ({(r.window_us, r.cell): (r.n, r.alt, r.vel) for r in got if r.kind == "closed"}, sum(r.kind == "late" for r in got)) == expected[idle]


def test_sink_is_tried_again():
    calls = []

    def sink(batch, n):
        calls.append(n)
        if len(calls) < 3:
            raise ConnectionError

    service.retried(sink, base_s=0.0)(None, 7)
    assert calls == [7, 7, 7]


def test_polls_as_a_stream(spark, tmp_path):
    vector = ["3d10d0", "FL1", "X", 100, 100, 5.0, 10.0, 900.0, False, 200.0, 90.0, 0, None, 950.0]
    for n, body in enumerate(({"states": [vector, ["x"]]}, {"states": None}, {"states": [vector]})):
        (tmp_path / f"{n}.json").write_text(json.dumps(body))
    (tmp_path / "3.503").write_text("")
    q = poller.stream_vectors(spark, folder=str(tmp_path), interval_s="0", backoff_s="0").writeStream.format("memory").queryName("polls").start()
    try:
        for _ in range(60):
            if spark.table("polls").count() >= 3:
                break
            q.awaitTermination(1)
    finally:
        q.stop()
    assert sorted(r.outcome for r in spark.table("polls").collect()) == ["emitted", "emitted", "malformed"]


def test_waiting_is_bounded():
    b = poller.Backoff(most_s=60.0, draw=lambda: 0.5)
    assert b.next(7.0) == 7.0 and b.next(10_000.0) == 60.0
    waits = []
    assert list(poller.poll(lambda: poller.Response(404), 1.0, poller.Backoff(draw=lambda: 0.5), waits.append, polls=2)) == [] and waits == [1.0, 2.0]


def test_fleet_as_a_stream(spark, tmp_path):
    rows = synthetic.fleet_stream(spark, 10, ticks_a_batch=3)
    q = rows.writeStream.format("memory").queryName("fleet").trigger(processingTime="100 milliseconds").start()
    try:
        for _ in range(60):
            if spark.table("fleet").count() >= 60:
                break
            q.awaitTermination(1)
    finally:
        q.stop()
    got = spark.table("fleet")
    assert got.agg(F.countDistinct("icao24")).first()[0] == 10 and got.filter(~F.col("lat").between(-85, 85) | ~F.col("lon").between(-180, 180) | ~F.col("altitude_m").between(0, 13000)).count() == 0
    assert got.groupBy("icao24", "event_us").count().filter("count > 1").count() == 0


def test_subscription_from_the_latest(spark, tmp_path):
    path = f"file://{tmp_path}"
    rows = lambda a, b: spark.createDataFrame([(k % 2, k // 2, f"c{k}") for k in range(a, b)], "partition long, offset long, cell string")
    filelog.publish(rows(0, 10), path, "t")
    stream = filelog.subscribe(spark, path, "t", starting="latest")
    every = filelog.subscribe(spark, path, "t")
    filelog.publish(rows(10, 15), path, "t")
    for df, name, want in ((stream, "new", 5), (every, "all", 15)):
        df.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        assert spark.table(name).count() == want
