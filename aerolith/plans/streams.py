"""Queries that run a stream over the test tables to its end, or generate and parse records."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.config import Settings
from aerolith.functions import telemetry as fn
from aerolith.operators import store, windows
from aerolith.operators.slices import SLICE_ROWS
from aerolith.plans.flights import HOUR_US, LATENESS_US, SOURCES, arrivals, flights, sql
from aerolith.plans.queries import ANNOTATED, ORACLES, query, replayed
from aerolith.sources import filelog, positional, synthetic
from aerolith.streaming import exact, native, service

#: More than the flight view's worst disorder, so the engine's watermark drops nothing.
COVERING_US = 5 * HOUR_US
SLICES = 4


def _work_dir(spark: SparkSession) -> str:
    """A new folder in the shared one that the cluster names; a temporary one on one machine, where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="aerolith-")
    return f"{root}/streams-{uuid.uuid4().hex}"


def _as_stream(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """rows by arrival as files that come one a micro-batch: dealt out by ranges of time in one pass. A file source takes files
    by their age, so they are given ages in the order of their ranges."""
    rows.repartitionByRange(SLICES, "ingest_us").sortWithinPartitions("ingest_us").write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((x.getPath() for x in files.listStatus(at) if x.getPath().getName().startswith("part-")), key=lambda x: x.getName())
    for k, part in enumerate(parts):
        files.setTimes(part, 1_000_000_000_000 + 1000 * k, -1)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("w4n_stream", sql(f"SELECT event_us - event_us % {HOUR_US} AS window_us, cell, count(*) AS n, CAST(sum(alt_cm) AS BIGINT) AS alt, CAST(sum(vel_cm) AS BIGINT) AS vel FROM firsts GROUP BY 1, 2 HAVING window_us + {HOUR_US} <= (SELECT max(event_us) FROM firsts) - {COVERING_US}"))
def native_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _work_dir(spark)
    rows = arrivals(spark, sf_dir).select("icao24", "event_us", "ingest_us", "cell", "alt_cm", "vel_cm")
    stream = _as_stream(spark, rows, f"{work}/in")
    native.run_to_end(native.streaming_windows([stream], HOUR_US, COVERING_US), service.window_sink(f"{work}/out"), f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").drop("batch")


@contextmanager
def _rocks(spark: SparkSession):
    """The state store that the exact stream needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _bounded(spark: SparkSession, sf_dir: str, work: str) -> DataFrame:
    """All arrivals as the stream of one pipeline, with the row that ends it."""
    rows = arrivals(spark, sf_dir).select(F.lit(0).cast("long").alias("pipeline"), "icao24", "event_us", "ingest_us", "cell", "alt_cm", "vel_cm", "src", "copy")
    none = {"icao24": F.lit(""), "event_us": F.lit(0).cast("long"), "cell": F.lit(""), "alt_cm": F.lit(0).cast("long"), "vel_cm": F.lit(0).cast("long"), "src": F.lit(0).cast("long"), "copy": F.lit(0), "pipeline": F.lit(0).cast("long")}
    end = rows.agg((F.max("ingest_us") + 1).alias("ingest_us")).withColumns(none).select(*rows.columns)
    return _as_stream(spark, rows.unionByName(end), f"{work}/in")


EXACT_SQL = sql(f"SELECT event_us - event_us % {HOUR_US} AS window_us, cell, count(*) AS n, CAST(sum(alt_cm) AS BIGINT) AS alt, CAST(sum(vel_cm) AS BIGINT) AS vel FROM annotated WHERE NOT is_late GROUP BY 1, 2", ANNOTATED)


@query("w4x_stream", EXACT_SQL)
def exact_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _work_dir(spark)
    with _rocks(spark):
        native.run_to_end(exact.exact_windows(_bounded(spark, sf_dir, work), HOUR_US, LATENESS_US), lambda batch, n: batch.write.mode("overwrite").parquet(f"{work}/out/batch={n}"), f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").filter("kind <> 'late'").select("window_us", "cell", "n", "alt", "vel")


@query("w12_idle_sources")
def idle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact stream with sources that count as idle after six hours without a row, by the time of arrival, and that are
    all awaited at the start: how its rows ended."""
    work = _work_dir(spark)
    with _rocks(spark):
        stream = exact.exact_windows(_bounded(spark, sf_dir, work), HOUR_US, LATENESS_US, idle_after_us=6 * HOUR_US, awaited=SOURCES)
        native.run_to_end(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{work}/out/batch={n}"), f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("events"))


@query("s1_generator", "SELECT 20 AS aircraft, true AS in_bounds, true AS near_rates")
def generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of the generated states, and that rates of disorder are within a tenth of what was asked for. Of what is not
    late 0.4 is moved, so 0.43 of all arrives after its time."""
    chaos = synthetic.Chaos(out_of_order=0.4, max_skew_s=45, duplicates=0.1, drops=0.05, late=0.05, late_s=100)
    rows = synthetic.fleet(spark, 20, 1500, 11, chaos).withColumn("delay_us", F.col("ingest_us") - F.col("event_us"))
    first, moved, late = F.col("copy") == 0, F.col("delay_us") > 0, F.col("delay_us") >= 100_000_000
    inside = F.col("lat").between(-85, 85) & F.col("lon").between(-180, 180) & F.col("altitude_m").between(0, 13000) & (F.col("heading") >= 0) & (F.col("heading") < 360) & F.col("delay_us").between(0, 245_000_000)
    one = rows.agg(
        F.countDistinct("icao24").cast("int").alias("aircraft"), F.min(inside).alias("in_bounds"), F.count_if(first).alias("ticks"), F.count_if(~first).alias("again"),
        F.count_if(first & moved).alias("moved"), F.count_if(first & late).alias("late"),
    )
    near = lambda got, want: F.abs(got - want) <= want * 0.1
    share = lambda c: F.col(c) / F.col("ticks")
    rates = near(F.col("ticks") / 30000, 0.95) & near(share("again"), 0.1) & near(share("moved"), 0.43) & near(share("late"), 0.05)
    return one.select("aircraft", "in_bounds", rates.alias("near_rates"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional arrays out of flights, some with fields missing or garbled by rule."""
    i = F.col("event_id")
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    seconds = F.floor(F.col("event_us") / 1_000_000)
    fields = [
        quoted(F.col("icao24")), F.when(i % 23 == 0, quoted(F.lit("  "))).otherwise(quoted(F.concat(F.lit("FL"), (i % 1000).cast("string")))), quoted(F.lit("X")), F.when(i % 29 == 0, F.lit("null")).otherwise(text(seconds)), text(seconds),
        text(F.col("lon_i")), F.when(i % 31 == 0, quoted(F.lit("north"))).otherwise(text(F.col("lat_i"))), F.when(i % 17 == 0, F.lit("null")).otherwise(text(F.col("alt_cm"))), F.when(i % 3 == 0, F.lit("true")).otherwise(F.lit("false")),
        F.when(i % 19 == 0, F.lit("null")).otherwise(text(F.col("vel_cm"))), text(i % 400), F.lit("0"), F.lit("null"), F.when(i % 34 == 0, F.lit("null")).otherwise(text(F.col("alt_cm") + 7)),
    ]
    whole = F.concat(F.lit("["), F.concat_ws(",", *fields), F.lit("]"))
    return flights(spark, sf_dir).select("event_id", F.when(i % 41 == 0, F.lit('["a"]')).otherwise(whole).alias("value"))


@query(
    "s2a_positional_parse",
    sql(
        """SELECT event_id, outcome, outcome = 'emitted' AND event_id % 17 = 0 AND event_id % 34 <> 0 AS substituted,
               outcome = 'emitted' AND ((event_id % 34 = 0 AND event_id % 3 <> 0) OR event_id % 19 = 0) AS repaired,
               CASE WHEN outcome = 'emitted' THEN CASE WHEN event_id % 23 = 0 THEN icao24 ELSE 'FL' || event_id % 1000 END END AS callsign,
               CASE WHEN outcome = 'emitted' THEN CAST(CASE WHEN event_id % 34 = 0 THEN 0 WHEN event_id % 17 = 0 THEN alt_cm + 7 ELSE alt_cm END AS DOUBLE) END AS altitude_m,
               CASE WHEN outcome = 'emitted' THEN CAST(CASE WHEN event_id % 19 = 0 THEN 0 ELSE vel_cm END AS DOUBLE) END AS velocity_ms,
               CASE WHEN outcome = 'emitted' THEN CAST(event_id % 400 % 360 AS DOUBLE) END AS heading
           FROM (SELECT *, CASE WHEN event_id % 41 = 0 THEN 'malformed' WHEN event_id % 29 = 0 THEN 'skipped' WHEN event_id % 31 = 0 THEN 'malformed' ELSE 'emitted' END AS outcome FROM flights)"""
    ),
)
def positional_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional.parse_states(_vectors(spark, sf_dir)).select("event_id", "outcome", "substituted", "repaired", "callsign", "altitude_m", "velocity_ms", "heading")


@query(
    "s2_poll_counts",
    sql(
        """SELECT count(*) AS fetched, count(*) FILTER (outcome = 'emitted') AS emitted, count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'malformed') AS malformed
           FROM (SELECT CASE WHEN event_id % 41 = 0 THEN 'malformed' WHEN event_id % 29 = 0 THEN 'skipped' WHEN event_id % 31 = 0 THEN 'malformed' ELSE 'emitted' END AS outcome FROM flights)"""
    ),
)
def poll_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional.poll_counts(positional.parse_states(_vectors(spark, sf_dir))).select("fetched", "emitted", "skipped", "malformed")


@query("r5_recorded_replay", ORACLES["r4_digest"])
def recorded_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recording: arrivals published as messages of a log on files, read back, decoded, checked to be whole, and replayed."""
    work = _work_dir(spark)
    names = ["icao24", "event_us", "ingest_us", "cell", "src", "alt_cm", "vel_cm", "copy"]
    filelog.publish(store.to_log(arrivals(spark, sf_dir).select(*names), "cell", 6, list(windows.ORDER)), work, "flights")
    log, dead = filelog.decode(filelog.read(spark, work, "flights"), "icao24 string, event_us long, ingest_us long, cell string, src long, alt_cm long, vel_cm long, copy int")
    return replayed(log)


@query("r5_fleet_replay")
def fleet_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recorded fleet, logged, read sealed, windowed and digested."""
    chaos = synthetic.Chaos(out_of_order=0.25, max_skew_s=15, duplicates=0.05, late=0.02, late_s=120, drops=0.01)
    rows = synthetic.fleet(spark, 30, 300, 99, chaos)
    return replayed(store.to_log(rows, "cell", 6, list(windows.ORDER)), tuple(range(6)), 60_000_000, 30_000_000)


@query("r6_levels")
def levels(spark: SparkSession, sf_dir: str, aircraft: int = 50, ticks: int = 1800, seed: int = 20260827) -> DataFrame:
    """The disorder sweep: six levels of a fleet, each under the baseline and all its bounds, whose sources count as one."""
    out, width = None, 60_000_000
    few = None if 2 * aircraft * ticks <= SLICE_ROWS else SLICE_ROWS
    for level in synthetic.LEVELS:
        rows = synthetic.fleet(spark, aircraft, ticks, seed, level.chaos).withColumn("src", F.lit(0))
        told = windows.report(windows.annotate(rows, (0,), width, 0, slice_rows=few), width, [round(b * 1e6) for b in level.bounds_s])
        told = told.select(F.lit(level.name).alias("level"), (F.col("bound_us") / 1e6).alias("bound_s"), "events", "misattributed", "naive_wrong", "naive_windows", "total", "wrong", "late")
        out = told if out is None else out.unionByName(told)
    return out


@query("k11_scoped_delete", sql("SELECT count(*) AS rows, count(*) FILTER (user_id % 5 = 2) AS removed, count(*) FILTER (user_id % 5 <> 2) AS left_over, CAST(0 AS BIGINT) AS truncated FROM flights"))
def scoped_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of which the rows of some keys are deleted, and then all."""
    path = f"{_work_dir(spark)}/table"
    store.save_days(flights(spark, sf_dir).select("event_id", "user_id", "event_us"), path)
    rows = spark.read.parquet(path).count()
    removed = store.delete_where(spark, path, F.col("user_id") % 5 == 2)
    left = spark.read.parquet(path).count()
    store.truncate(spark, path)
    return spark.createDataFrame([(rows, removed, left, spark.read.parquet(path).count())], "rows long, removed long, left_over long, truncated long")


@query("k10_drop_days", sql("SELECT event_id FROM flights WHERE event_us // 86400000000 >= (SELECT max(event_us) // 86400000000 - 7 FROM flights)"))
def dropped_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by day after retention has dropped the folders of days that it doesn't keep."""
    path = f"{_work_dir(spark)}/table"
    rows = flights(spark, sf_dir).select("event_id", "event_us")
    store.save_days(rows, path)
    first = rows.agg(F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), (F.floor(F.max("event_us") / store.DAY_US) - 7).cast("int")), "yyyy-MM-dd").alias("day")).first()["day"]
    store.drop_days(spark, path, first)
    return spark.read.parquet(path).select("event_id")


@query(
    "w20_service",
    sql(f"""SELECT event_us - event_us % {HOUR_US} AS window_us, cell, count(*) AS n, CAST(sum(alt_cm) AS BIGINT) AS alt, CAST(sum(vel_cm) AS BIGINT) AS vel, event_us - event_us % {HOUR_US} + {HOUR_US} <= (SELECT greatest(max(frontier_us), max(mark_us)) FROM annotated) AS published
            FROM annotated WHERE NOT is_late GROUP BY 1, 2""", ANNOTATED),
)
def live_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live service over all arrivals: windows that it has published, and those that its end showed as a preview."""
    work = _work_dir(spark)
    settings = Settings(window_s=HOUR_US // 1_000_000, allowed_lateness_s=LATENESS_US / 1e6)
    with _rocks(spark):
        service.serve(_bounded(spark, sf_dir, work), f"{work}/service", settings).trigger(availableNow=True).start().awaitTermination()
    shown = spark.read.schema("window_us long, cell string, n long, alt long, vel long").parquet(f"{work}/service/preview/batch=*")
    return service.read_windows(spark, f"{work}/service").withColumn("published", F.lit(True)).unionByName(shown.withColumn("published", F.lit(False)))


@query("i1_accounting", sql("""SELECT count(*) AS fetched, count(*) FILTER (outcome = 'emitted') AS published, count(*) FILTER (outcome = 'malformed') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped, true AS fetch_balanced,
           count(*) FILTER (stored) AS inserted, count(*) FILTER (outcome = 'emitted' AND kept AND NOT stored) AS suppressed, count(*) FILTER (outcome = 'emitted' AND NOT kept) AS shed, CAST(0 AS BIGINT) AS quarantined, true AS store_balanced
    FROM (SELECT *, outcome = 'emitted' AND kept AND row_number() OVER (PARTITION BY outcome = 'emitted' AND kept, icao24, event_us // 1000000 ORDER BY event_id) = 1 AS stored
          FROM (SELECT *, NOT (CAST('0x' || substr(md5(cell), 1, 4) AS BIGINT) / 65535.0 < 0.25) AS kept,
                CASE WHEN event_id % 41 = 0 THEN 'malformed' WHEN event_id % 29 = 0 THEN 'skipped' WHEN event_id % 31 = 0 THEN 'malformed' ELSE 'emitted' END AS outcome FROM flights))"""))
def accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each fetched vector went: every one is published, failed or skipped, and every one published is inserted,
    suppressed as a repeat, shed with its cell, or quarantined by the contract."""
    parsed = positional.parse_states(_vectors(spark, sf_dir)).withColumn("cell", fn.grid_cell(F.col("lat"), F.col("lon")))
    stated = parsed.withColumns({"event_time": F.timestamp_micros("event_us"), "ingest_time": F.timestamp_micros("event_us")})
    emitted = F.col("outcome") == "emitted"
    stated = stated.withColumn("kept", emitted & fn.kept_when_shedding(F.col("cell"), 0.25)).withColumn("sound", F.size(fn.violations()) == 0)
    nth = F.row_number().over(Window.partitionBy(F.col("kept") & F.col("sound"), "icao24", "event_us").orderBy("event_id"))
    stored = F.col("kept") & F.col("sound")
    one = stated.withColumn("nth", nth).agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if(emitted).alias("published"), F.count_if(F.col("outcome") == "malformed").alias("failed"), F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(stored & (F.col("nth") == 1)).alias("inserted"), F.count_if(stored & (F.col("nth") > 1)).alias("suppressed"), F.count_if(emitted & ~F.col("kept")).alias("shed"), F.count_if(F.col("kept") & ~F.col("sound")).alias("quarantined"),
    )
    total = lambda *names: sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return one.withColumn("fetch_balanced", F.col("fetched") == total("published", "failed", "skipped")).withColumn("store_balanced", F.col("published") == total("inserted", "suppressed", "shed", "quarantined"))
