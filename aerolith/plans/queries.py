"""Queries over the test tables, one for each operator or a few that belong together, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.functions import telemetry as fn
from aerolith.operators import control, store, windows
from aerolith.plans.flights import HOUR_US, LATENESS_US, SOURCES, annotated_sql, arrivals, flights, sql, windows_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


TRUTH, NAIVE = windows_sql("truth", "firsts", "event_us"), windows_sql("naive", "firsts", "ingest_us")
ANNOTATED, ON_TIME = annotated_sql(), windows_sql("got", "annotated", "event_us", "NOT is_late")


def truth(spark, d):
    return windows.ground_truth(arrivals(spark, d), HOUR_US)


def annotated(spark, d, lateness_us: int = LATENESS_US, sources=SOURCES):
    rows = arrivals(spark, d)
    rows = rows if len(sources) > 1 else rows.withColumn("src", F.lit(sources[0]))
    return windows.annotate(rows, sources, HOUR_US, lateness_us)


# windows

query("w1_ground_truth", sql("SELECT * FROM truth", TRUTH))(truth)
query("w2_naive", sql("SELECT * FROM naive", NAIVE))(lambda s, d: windows.naive(arrivals(s, d), HOUR_US))
query("w3_watermark_windows", sql("SELECT * FROM got", ANNOTATED, ON_TIME))(lambda s, d: windows.on_time_windows(annotated(s, d), HOUR_US))
query("w3_single_source", sql("SELECT * FROM got", annotated_sql(sources=(0,)), ON_TIME))(lambda s, d: windows.on_time_windows(annotated(s, d, sources=(0,)), HOUR_US))
query("w5_marks", sql("SELECT icao24, event_us, ingest_us, mark_us, frontier_us FROM annotated", ANNOTATED))(lambda s, d: annotated(s, d).select("icao24", "event_us", "ingest_us", "mark_us", "frontier_us"))
query("w8_late_events", sql("SELECT icao24, event_us, ingest_us, cell, src, window_us, frontier_us AS watermark_us, frontier_us - window_us AS lateness_us FROM annotated WHERE is_late", ANNOTATED))(lambda s, d: windows.late_events(annotated(s, d)))
query(
    "w18_accounting",
    sql(
        """SELECT (SELECT count(*) FROM arrivals) AS arrived, count(*) AS processed, (SELECT count(*) FROM arrivals) - count(*) AS duplicates,
           count(*) FILTER (NOT is_late) AS windowed, count(*) FILTER (is_late) AS late,
           greatest(max(frontier_us), max(mark_us)) AS final_watermark_us, max(event_us) AS max_event_us FROM annotated""",
        ANNOTATED,
    ),
)(lambda s, d: windows.accounting(arrivals(s, d), annotated(s, d)))
query("w9_first_seen", sql("SELECT event_id, copy FROM firsts"))(lambda s, d: windows.first_copies(arrivals(s, d)).select("event_id", "copy"))
HORIZON_WINDOWS = 1
EVERY = ANNOTATED.replace("FROM firsts", "FROM arrivals")
query(
    "w9_horizon",
    sql(
        f"""SELECT event_id, copy, CASE WHEN nth = 1 THEN CASE WHEN is_late THEN 'late' ELSE 'counted' END
            WHEN coalesce(window_us < frontier_us - {HORIZON_WINDOWS} * {HOUR_US}, false) THEN 'late' ELSE 'duplicate' END AS outcome
            FROM (SELECT *, row_number() OVER (PARTITION BY icao24, event_us ORDER BY ingest_us, copy) AS nth FROM annotated)""",
        EVERY,
    ),
)(lambda s, d: windows.outcomes(arrivals(s, d), SOURCES, HOUR_US, LATENESS_US, HORIZON_WINDOWS).select("event_id", "copy", "outcome"))
query("o5_recent_late", sql("SELECT icao24, event_us, ingest_us FROM annotated WHERE is_late ORDER BY ingest_us DESC, icao24 DESC, event_us DESC LIMIT 20", ANNOTATED))(lambda s, d: windows.recent_late(annotated(s, d), 20).select("icao24", "event_us", "ingest_us"))
query("w19_skew", sql("SELECT max(event_us) - max(mark_us) AS behind_us, max(ingest_us - event_us) AS most_skew_us FROM annotated", ANNOTATED))(
    lambda s, d: annotated(s, d).agg((F.max("event_us") - F.max("mark_us")).alias("behind_us"), F.max(F.col("ingest_us") - F.col("event_us")).alias("most_skew_us"))
)
query("w10_minimum_retention", "SELECT l AS lateness_s, w AS window_s, CAST(ceil(l / w) AS INTEGER) + 1 AS windows FROM (VALUES (30, 60), (60, 60), (45, 10)) t(l, w)")(
    lambda s, d: s.createDataFrame([(a, b, windows.minimum_retention(a, b)) for a, b in ((30, 60), (60, 60), (45, 10))], "lateness_s int, window_s int, windows int")
)


SWEEP_MINUTES = (0, 15, 30, 45, 90)


def sweep(s, d):
    """Accuracy at several bounds: one row each, all from one annotated relation."""
    rows = windows.sweep(annotated(s, d, 0), HOUR_US, [m * 60_000_000 for m in SWEEP_MINUTES])
    return rows.select((F.col("bound_us") / 60_000_000).cast("int").alias("lateness_min"), "total", "wrong", "late", "abs_count_error")


def _sweep_sql() -> str:
    parts, rows = [TRUTH], []
    for m in (0, 15, 30, 45, 90):
        parts.append(annotated_sql(m * 60_000_000).replace("a1", f"x{m}").replace("a2", f"y{m}").replace("annotated", f"z{m}") + windows_sql(f"g{m}", f"z{m}", "event_us", "NOT is_late"))
        rows.append(f"""SELECT {m} AS lateness_min, count(*) AS total,
            count(*) FILTER (t.n IS DISTINCT FROM g.n OR abs(t.avg_altitude - g.avg_altitude) > 1e-3 * greatest(abs(t.avg_altitude), abs(g.avg_altitude), 1) OR abs(t.avg_velocity - g.avg_velocity) > 1e-3 * greatest(abs(t.avg_velocity), abs(g.avg_velocity), 1)) AS wrong,
            (SELECT count(*) FROM z{m} WHERE is_late) AS late, CAST(sum(abs(coalesce(t.n, 0) - coalesce(g.n, 0))) AS BIGINT) AS abs_count_error
            FROM truth t FULL JOIN g{m} g ON t.window_us = g.window_us AND t.cell = g.cell""")
    return sql("\nUNION ALL\n".join(rows), *parts)


query("r6_lateness_sweep", _sweep_sql())(sweep)

# comparison and its joins

OFF = "abs(t.{0} - g.{0}) > 1e-3 * greatest(abs(t.{0}), abs(g.{0}), 1)"
COMPARED = f""", compared AS (
        SELECT coalesce(t.window_us, g.window_us) AS window_us, coalesce(t.cell, g.cell) AS cell, t.n AS n_true, g.n AS n_got,
               CASE WHEN g.n IS NULL THEN 'missing' WHEN t.n IS NULL THEN 'phantom' WHEN t.n <> g.n THEN 'count'
                    WHEN {OFF.format("avg_altitude")} OR {OFF.format("avg_velocity")} THEN 'value' END AS wrong
        FROM truth t FULL JOIN naive g ON t.window_us = g.window_us AND t.cell = g.cell)"""


def compared(s, d):
    return windows.compare(truth(s, d), windows.naive(arrivals(s, d), HOUR_US))


query("j1_compare", sql("SELECT * FROM compared", TRUTH, NAIVE, COMPARED))(compared)
query(
    "a11_comparison",
    sql(
        """SELECT count(*) AS total, count(wrong) AS wrong, count(*) FILTER (wrong = 'missing') AS missing, count(*) FILTER (wrong = 'phantom') AS phantom,
           count(*) FILTER (wrong = 'count') AS count_mismatch, count(*) FILTER (wrong = 'value') AS value_mismatch,
           CAST(sum(abs(coalesce(n_true, 0) - coalesce(n_got, 0))) AS BIGINT) AS abs_count_error, max(abs(coalesce(n_true, 0) - coalesce(n_got, 0))) AS worst FROM compared""",
        TRUTH, NAIVE, COMPARED,
    ),
)(lambda s, d: windows.roll_up(compared(s, d)))
query("j3_disagreement", sql("SELECT count(*) AS windows, count(*) FILTER (g.n IS DISTINCT FROM t.n) AS disagree FROM truth t LEFT JOIN naive g ON t.window_us = g.window_us AND t.cell = g.cell", TRUTH, NAIVE))(
    lambda s, d: windows.disagreement(truth(s, d), windows.naive(arrivals(s, d), HOUR_US))
)
query("p9_misattributed", sql(f"SELECT count(*) AS events, count(*) FILTER (ingest_us - ingest_us % {HOUR_US} <> event_us - event_us % {HOUR_US}) AS misattributed FROM firsts"))(lambda s, d: windows.misattributed(arrivals(s, d), HOUR_US))


query(
    "r7_headline",
    sql(
        f"""SELECT (SELECT count(*) FROM firsts) AS events, (SELECT count(*) FROM firsts WHERE ingest_us - ingest_us % {HOUR_US} <> event_us - event_us % {HOUR_US}) AS misattributed,
            (SELECT count(wrong) FROM compared) AS naive_wrong, (SELECT count(*) FROM compared) AS naive_windows,
            count(*) FILTER (t.n IS DISTINCT FROM g.n OR {OFF.format("avg_altitude")} OR {OFF.format("avg_velocity")}) AS watermark_wrong,
            (SELECT count(*) FROM annotated WHERE is_late) AS reported,
            CAST(sum(abs(coalesce(t.n, 0) - coalesce(g.n, 0))) AS BIGINT) - (SELECT count(*) FROM annotated WHERE is_late) AS silent
            FROM truth t FULL JOIN got g ON t.window_us = g.window_us AND t.cell = g.cell""",
        TRUTH, NAIVE, COMPARED, ANNOTATED, ON_TIME,
    ),
)(lambda s, d: windows.headline(annotated(s, d), HOUR_US))

# projections and predicates

query("p1_grid_cell", sql("SELECT DISTINCT lat_i, lon_i, cell FROM flights"))(lambda s, d: flights(s, d).select("lat_i", "lon_i", fn.grid_cell(F.col("lat_i"), F.col("lon_i")).alias("cell")).distinct())
#: Shifts the flights' times to before the epoch.
BACK_US = 2_000_000_000_000_000
query("p2_window_start", sql(f"SELECT event_id, event_us - event_us % 60000000 AS window_us, event_us - {BACK_US} - (((event_us - {BACK_US}) % 60000000) + 60000000) % 60000000 AS early_us FROM flights"))(
    lambda s, d: flights(s, d).select("event_id", fn.tumble(F.col("event_us")).alias("window_us"), fn.tumble(F.col("event_us") - BACK_US).alias("early_us"))
)


def states(s, d):
    """Contract rows from flights, some of them broken by rule."""
    i = F.col("event_id")
    return flights(s, d).select(
        "event_id", F.when(i % 101 == 0, F.upper("icao24")).otherwise(F.col("icao24")).alias("icao24"), F.when(i % 103 == 0, "").otherwise(F.concat(F.lit("FL"), (i % 1000).cast("string"))).alias("callsign"),
        F.when(i % 107 == 0, float("nan")).otherwise(F.col("lat_i").cast("double")).alias("lat"), F.when(i % 109 == 0, float("inf")).otherwise(F.col("lon_i").cast("double")).alias("lon"),
        F.when(i % 113 == 0, -500.1).otherwise(F.col("alt_cm") / 100.0).alias("altitude_m"), F.when(i % 127 == 0, -0.1).otherwise(F.col("vel_cm") / 100.0).alias("velocity_ms"),
        F.when(i % 131 == 0, 360.0).otherwise((i % 360).cast("double")).alias("heading"), F.timestamp_micros("event_us").alias("event_time"), F.timestamp_micros("ingest_us").alias("ingest_time"),
    )


_BROKEN = {"icao24": "event_id % 101 = 0 AND upper(icao24) <> icao24", "callsign": "event_id % 103 = 0", "lat": "event_id % 107 = 0", "lon": "event_id % 109 = 0", "altitude_m": "event_id % 113 = 0", "velocity_ms": "event_id % 127 = 0", "heading": "event_id % 131 = 0"}
query("p3_violations", sql("SELECT event_id, concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in _BROKEN.items()) + ") AS violations FROM flights"))(lambda s, d: states(s, d).select("event_id", F.array_join(fn.violations(), ",").alias("violations")))


def parsed(s, d):
    """A JSON log in which some records are cut short, read back: what parses, and what does not."""
    log = flights(s, d).select("event_id", F.to_json(F.struct("event_id", "icao24", "cell", "alt_cm")).alias("value"))
    log = log.withColumn("value", F.when(F.col("event_id") % 37 == 0, F.expr("substr(value, 1, length(value) - 4)")).otherwise(F.col("value")))
    x = F.from_json("value", "event_id long, icao24 string, cell string, alt_cm long, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return log.withColumn("x", x).select("event_id", F.col("x._bad").isNull().alias("parsed"), F.when(F.col("x._bad").isNull(), F.col("x.alt_cm")).alias("alt_cm"))


query("p4_parse_or_reject", sql("SELECT event_id, event_id % 37 <> 0 AS parsed, CASE WHEN event_id % 37 <> 0 THEN alt_cm END AS alt_cm FROM flights"))(parsed)
BUCKET = "CAST('0x' || substr(md5(cell), 1, 4) AS BIGINT)"
query("p5_shed", sql(f"SELECT event_id, {BUCKET} AS bucket, NOT ({BUCKET} / 65535.0 < 0.25) AS kept FROM flights"))(lambda s, d: flights(s, d).select("event_id", fn.shed_bucket(F.col("cell")).alias("bucket"), fn.kept_when_shedding(F.col("cell"), 0.25).alias("kept")))
query("c7_shed_accounting", sql(f"SELECT count(*) AS offered, count(*) FILTER (NOT {BUCKET} / 65535.0 < 0.25) AS kept, count(*) FILTER ({BUCKET} / 65535.0 < 0.25) AS dropped, count(DISTINCT cell) FILTER ({BUCKET} / 65535.0 < 0.25) AS cells_shed FROM flights"))(
    lambda s, d: flights(s, d).withColumn("kept_", fn.kept_when_shedding(F.col("cell"), 0.25)).agg(F.count(F.lit(1)).alias("offered"), F.count_if("kept_").alias("kept"), F.count_if(~F.col("kept_")).alias("dropped"), F.countDistinct(F.when(~F.col("kept_"), F.col("cell"))).alias("cells_shed"))
)
query("p6_event_filter", sql("SELECT event_id FROM flights WHERE alt_cm >= 10000 AND src <> 3"))(lambda s, d: flights(s, d).filter((F.col("alt_cm") >= 10000) & (F.col("src") != 3)).select("event_id"))
query("p7_arrival_lateness", sql("SELECT event_id, copy, (ingest_us - event_us) / 1000000.0 AS late_s FROM arrivals"))(lambda s, d: arrivals(s, d).select("event_id", "copy", ((F.col("ingest_us") - F.col("event_us")) / F.lit(1e6)).alias("late_s")))
query("p10_keyed_filter", sql("SELECT event_id, icao24 FROM flights WHERE icao24 IN (SELECT DISTINCT icao24 FROM flights WHERE user_id % 7 = 0)"))(
    lambda s, d: flights(s, d).join(flights(s, d).filter("user_id % 7 = 0").select("icao24").distinct(), "icao24", "left_semi").select("event_id", "icao24")
)
query("p12_cell_filter", sql("SELECT event_id, cell FROM flights WHERE cell = '0:0' OR cell = '-1:-1' OR cell = '2:3'"))(lambda s, d: flights(s, d).filter(F.col("cell").isin("0:0", "-1:-1", "2:3")).select("event_id", "cell"))
query("s2b_box", sql("SELECT event_id FROM flights WHERE lat_i BETWEEN -10 AND 30 AND lon_i BETWEEN -60 AND 45"))(lambda s, d: flights(s, d).filter(fn.in_box(F.col("lat_i"), F.col("lon_i"), fn.parse_box("-10,-60,30,45"))).select("event_id"))
query("f1_trace_id", sql("SELECT event_id, substr(sha256(icao24 || '|' || strftime(make_timestamp(event_us), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'), 1, 16) AS trace_id FROM flights"))(lambda s, d: flights(s, d).select("event_id", fn.trace_id(F.col("icao24"), F.timestamp_micros("event_us")).alias("trace_id")))

# log and store

PART = "CAST('0x' || substr(md5(cell), 1, 6) AS BIGINT) % 6"
LOG = f""", log AS (SELECT *, {PART} AS part, row_number() OVER (PARTITION BY {PART} ORDER BY ingest_us, icao24, event_us, copy) - 1 AS off FROM arrivals)"""


def log(s, d):
    return store.to_log(arrivals(s, d), "cell", 6, list(windows.ORDER))


query("k1_log", sql('SELECT event_id, copy, part AS "partition", off AS "offset" FROM log', LOG))(lambda s, d: log(s, d).select("event_id", "copy", "partition", "offset"))
query("s8_partition_stats", sql('SELECT part AS "partition", min(off) AS begin_offset, max(off) + 1 AS end_offset, count(*) AS messages FROM log GROUP BY 1', LOG))(lambda s, d: store.partition_stats(log(s, d)))
query("s5_sealed_read", sql('SELECT part AS "partition", count(*) AS messages, CAST(sum(event_id) AS BIGINT) AS ids FROM log GROUP BY 1', LOG))(
    lambda s, d: store.sealed(log(s, d), store.partition_stats(log(s, d)).select("partition", "begin_offset", "end_offset")).groupBy("partition").agg(F.count(F.lit(1)).alias("messages"), F.sum("event_id").alias("ids"))
)
query("p11_offset_range", sql('SELECT event_id, copy FROM log WHERE off >= 100 AND off < 400', LOG))(lambda s, d: log(s, d).filter("offset >= 100 and offset < 400").select("event_id", "copy"))
OPEN_FROM = "(SELECT max(event_us) - 86400000000 FROM arrivals)"
query("w16_safe_offsets", sql(f'SELECT part AS "partition", least(max(off) + 1, min(off) FILTER (event_us - event_us % {HOUR_US} + {HOUR_US} > {OPEN_FROM})) AS safe FROM log GROUP BY 1', LOG))(
    lambda s, d: windows.safe_offsets(log(s, d).crossJoin(arrivals(s, d).agg((F.max("event_us") - 86_400_000_000).alias("frontier"))), fn.tumble(F.col("event_us"), HOUR_US) + HOUR_US > F.col("frontier"))
)
query("s4_arrival_order", sql("SELECT event_id, copy, row_number() OVER (ORDER BY ingest_us, icao24, event_us, copy) AS \"at\" FROM arrivals"))(
    lambda s, d: store.arrival_order(arrivals(s, d), list(windows.ORDER)).select("event_id", "copy", "at")
)
query("k3_first_wins", sql("SELECT event_id, copy, ingest_us FROM firsts"))(lambda s, d: store.first_wins(arrivals(s, d), list(windows.KEY), list(windows.ORDER)).select("event_id", "copy", "ingest_us"))
query("k2_upsert_new_rows", sql("SELECT event_id FROM firsts WHERE event_id NOT IN (SELECT event_id FROM flights WHERE event_id % 3 = 0)"))(
    lambda s, d: store.new_rows(flights(s, d).filter("event_id % 3 = 0"), arrivals(s, d), list(windows.KEY), list(windows.ORDER)).select("event_id")
)
query("k5_quarantine", sql('SELECT part AS "partition", off AS "offset", event_id FROM log WHERE event_id % 37 = 0 AND NOT (off < 50)', LOG))(
    lambda s, d: store.new_rows(log(s, d).filter("event_id % 37 = 0 and offset < 50"), log(s, d).filter("event_id % 37 = 0"), ["partition", "offset"], ["event_id"]).select("partition", "offset", "event_id")
)
query(
    "k7_latest_cas",
    sql(
        """SELECT cell, window_us, n, new = 1 AS replaced FROM (
             SELECT cell, window_us, n, 0 AS new FROM truth WHERE window_us % 7200000000 = 0 QUALIFY row_number() OVER (PARTITION BY cell ORDER BY window_us DESC) = 1
             UNION ALL SELECT cell, window_us, n, 1 FROM truth WHERE window_us % 10800000000 = 0 QUALIFY row_number() OVER (PARTITION BY cell ORDER BY window_us DESC) = 1)
           QUALIFY row_number() OVER (PARTITION BY cell ORDER BY window_us DESC, n DESC, new DESC) = 1""",
        TRUTH,
    ),
)(
    lambda s, d: store.latest_wins(
        store.latest_per_cell(truth(s, d).filter(F.col("window_us") % 7_200_000_000 == 0)).select("cell", "window_us", "n"),
        store.latest_per_cell(truth(s, d).filter(F.col("window_us") % 10_800_000_000 == 0)).select("cell", "window_us", "n"),
    )
)
query("k8_encode", sql("SELECT window_us, cell, '{\"window_us\":' || window_us || ',\"cell\":\"' || cell || '\",\"n\":' || n || '}' AS payload FROM truth", TRUTH))(lambda s, d: truth(s, d).select("window_us", "cell", F.to_json(F.struct("window_us", "cell", "n")).alias("payload")))
query("k9_late_total", sql("SELECT src, count(*) AS late FROM annotated WHERE is_late GROUP BY src", ANNOTATED))(lambda s, d: annotated(s, d).filter("is_late").groupBy("src").agg(F.count(F.lit(1)).alias("late")))
query("k10_retention", sql("SELECT event_id FROM flights WHERE event_us // 86400000000 >= (SELECT max(event_us) // 86400000000 - 7 FROM flights)"))(
    lambda s, d: store.retained(flights(s, d).crossJoin(flights(s, d).agg(F.max("event_us").alias("now_us"))), F.col("now_us"), 7).select("event_id")
)
COMMITTED = ", committed AS (SELECT part, max(off) // 2 AS committed FROM log WHERE part <> 4 GROUP BY part), ends AS (SELECT part, max(off) + 1 AS end_offset FROM log GROUP BY part)"


def lag(s, d):
    x = log(s, d)
    return store.partition_lag(store.partition_stats(x).select("partition", "end_offset"), x.filter("partition <> 4").groupBy("partition").agg(F.floor(F.max("offset") / 2).alias("committed")))


query("j6_partition_lag", sql('SELECT part AS "partition", end_offset, committed, greatest(0, end_offset - coalesce(committed, 0)) AS lag FROM ends LEFT JOIN committed USING (part)', LOG, COMMITTED))(lag)
query("a13_lag_totals", sql("SELECT CAST(sum(greatest(0, end_offset - coalesce(committed, 0))) AS BIGINT) AS total, max(greatest(0, end_offset - coalesce(committed, 0))) AS most FROM ends LEFT JOIN committed USING (part)", LOG, COMMITTED))(lambda s, d: lag(s, d).agg(F.sum("lag").alias("total"), F.max("lag").alias("most")))
query("j2_anti", sql("SELECT event_id FROM flights WHERE event_id % 20 <> 0"))(lambda s, d: flights(s, d).join(arrivals(s, d).filter("copy = 1").select("event_id"), "event_id", "left_anti").select("event_id"))
query("j4_strip_rejected", sql("SELECT event_id, copy FROM log WHERE event_id % 41 <> 0", LOG))(lambda s, d: log(s, d).join(log(s, d).filter("event_id % 41 = 0").select("partition", "offset"), ["partition", "offset"], "left_anti").select("event_id", "copy"))
query("j7_reconcile", sql("SELECT (SELECT count(*) FROM arrivals) AS messages, (SELECT count(*) FROM firsts) AS stored, (SELECT count(*) - count(DISTINCT (icao24, event_us)) FROM arrivals) AS suppressed"))(
    lambda s, d: arrivals(s, d).agg(F.count(F.lit(1)).alias("messages"), (F.count(F.lit(1)) - F.countDistinct("icao24", "event_us")).alias("suppressed")).crossJoin(windows.first_copies(arrivals(s, d)).agg(F.count(F.lit(1)).alias("stored"))).select("messages", "stored", "suppressed")
)
query("r9_latest_per_cell", sql("SELECT * FROM truth QUALIFY row_number() OVER (PARTITION BY cell ORDER BY window_us DESC) = 1", TRUTH))(lambda s, d: store.latest_per_cell(truth(s, d)))
query("r10_status", sql("SELECT count(*) AS rows, max(event_us) AS max_event_us, count(DISTINCT icao24) AS aircraft, count(DISTINCT cell) AS cells FROM firsts"))(lambda s, d: store.status(windows.first_copies(arrivals(s, d))))

# aggregates

query("a2_count_max", sql("SELECT count(*) AS rows, max(event_us) AS latest_us FROM flights"))(lambda s, d: flights(s, d).agg(F.count(F.lit(1)).alias("rows"), F.max("event_us").alias("latest_us")))
query("a3_span", sql("SELECT count(DISTINCT icao24) AS aircraft, count(DISTINCT cell) AS cells, min(event_us) AS first_us, max(event_us) AS last_us FROM flights"))(lambda s, d: flights(s, d).agg(F.countDistinct("icao24").alias("aircraft"), F.countDistinct("cell").alias("cells"), F.min("event_us").alias("first_us"), F.max("event_us").alias("last_us")))
PCT = "count(*) AS n, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.95) AS p95, quantile_cont(v, 0.99) AS p99, avg(v) AS average, max(v) AS maximum"
query("a4_lateness_percentiles", sql(f"SELECT src, {PCT} FROM (SELECT src, CAST((ingest_us - event_us) // 1000000 AS DOUBLE) AS v FROM arrivals) GROUP BY src"))(lambda s, d: store.percentiles(arrivals(s, d), F.floor((F.col("ingest_us") - F.col("event_us")) / 1_000_000).cast("double"), ["src"]))
query("p8_latency_of_keys", sql(f"SELECT {PCT} FROM (SELECT CAST((ingest_us - event_us) // 1000000 AS DOUBLE) AS v FROM firsts WHERE user_id IN (3, 5, 8))"))(lambda s, d: store.percentiles(windows.first_copies(arrivals(s, d)).filter(F.col("user_id").isin(3, 5, 8)), F.floor((F.col("ingest_us") - F.col("event_us")) / 1_000_000).cast("double")))
query("a5_beyond_bound", sql("SELECT count(*) AS events, count(*) FILTER (ingest_us - event_us > 1800000000) AS beyond FROM arrivals"))(lambda s, d: arrivals(s, d).agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("ingest_us") - F.col("event_us") > LATENESS_US).alias("beyond")))
query("a6_duplicate_keys", sql("SELECT icao24, event_us, count(*) AS copies FROM arrivals GROUP BY ALL HAVING count(*) > 1"))(lambda s, d: arrivals(s, d).groupBy("icao24", "event_us").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
STATS = "count({0}) AS n, median({0}) AS median, avg({0}) AS mean, coalesce(stddev_samp({0}), 0) AS stdev, min({0}) AS least, max({0}) AS most, count(*) FILTER ({0} IS NULL) AS missing"
query("a7_summary", sql("SELECT src, " + STATS.format("v") + " FROM (SELECT src, CASE WHEN event_id % 11 <> 0 THEN CAST(alt_cm AS DOUBLE) END AS v FROM flights) GROUP BY src"))(lambda s, d: store.summary(flights(s, d).withColumn("v", F.when(F.col("event_id") % 11 != 0, F.col("alt_cm").cast("double"))), "v", ["src"]))
query("a8_summary_by_metric", sql("SELECT src, metric, " + STATS.format("v") + " FROM (SELECT src, 'altitude' AS metric, CAST(alt_cm AS DOUBLE) AS v FROM flights UNION ALL SELECT src, 'velocity', CASE WHEN event_id % 13 <> 0 THEN CAST(vel_cm AS DOUBLE) END FROM flights) GROUP BY ALL"))(
    lambda s, d: store.summary(flights(s, d).select("src", F.expr("stack(2, 'altitude', cast(alt_cm as double), 'velocity', if(event_id % 13 <> 0, cast(vel_cm as double), null)) as (metric, v)")), "v", ["src", "metric"])
)
BOUNDS = (0.0, 1.0, 60.0, 300.0, 900.0, 1800.0, 3600.0, 7200.0)
CASE = "CASE " + " ".join(f"WHEN v <= {b} THEN CAST({b} AS DOUBLE)" for b in BOUNDS) + " ELSE CAST('Infinity' AS DOUBLE) END"
HIST = f", hist AS (SELECT {CASE} AS le, count(*) AS n FROM (SELECT (ingest_us - event_us) / 1000000.0 AS v FROM arrivals) GROUP BY 1)"


def histogram(s, d):
    v = (F.col("ingest_us") - F.col("event_us")) / F.lit(1e6)
    return arrivals(s, d).groupBy(fn.histogram_bucket(v, BOUNDS).alias("le")).agg(F.count(F.lit(1)).alias("n"))


query("a12_latency_histogram", sql("SELECT * FROM hist", HIST))(histogram)


def quantile(s, d, q: float = 0.95):
    """Interpolated inside the first bucket whose cumulative count reaches the rank, as dashboards do; one row a bucket."""
    by = Window.orderBy("le")
    h = histogram(s, d).withColumn("upto", F.sum("n").over(by)).withColumn("low", F.coalesce(F.lag("le").over(by), F.lit(0.0)))
    h = h.withColumn("rank", F.sum("n").over(Window.partitionBy()) * q).filter("upto >= rank")
    first = h.agg(F.min_by(F.struct("le", "low", "n", "upto", "rank"), "le").alias("x")).select("x.*")
    inner = F.col("low") + (F.col("le") - F.col("low")) * (F.col("rank") - (F.col("upto") - F.col("n"))) / F.col("n")
    return first.select(F.when(F.col("le") == float("inf"), F.col("low")).otherwise(inner).alias("p95_s"))


query(
    "a15_histogram_quantile",
    sql(
        """SELECT CASE WHEN le = 'Infinity' THEN low ELSE low + (le - low) * (rank - (upto - n)) / n END AS p95_s FROM (
             SELECT le, n, sum(n) OVER (ORDER BY le) AS upto, coalesce(lag(le) OVER (ORDER BY le), 0) AS low, sum(n) OVER () * 0.95 AS rank FROM hist)
           WHERE upto >= rank ORDER BY le LIMIT 1""",
        HIST,
    ),
)(quantile)
RATE = f", hourly AS (SELECT src, ingest_us // {HOUR_US} AS hour, count(*) AS n FROM arrivals GROUP BY ALL)"
query("a15_rate", sql("SELECT src, hour, (n - lag(n) OVER (PARTITION BY src ORDER BY hour)) / (CAST(hour - lag(hour) OVER (PARTITION BY src ORDER BY hour) AS DOUBLE) * 3600) AS change_per_s FROM hourly", RATE))(
    lambda s, d: (lambda h, w: h.select("src", "hour", ((F.col("n") - F.lag("n").over(w)) / ((F.col("hour") - F.lag("hour").over(w)) * F.lit(3600.0))).alias("change_per_s")))(
        arrivals(s, d).groupBy("src", F.floor(F.col("ingest_us") / HOUR_US).alias("hour")).agg(F.count(F.lit(1)).alias("n")), Window.partitionBy("src").orderBy("hour")
    )
)

# lag series and control

SAMPLES = f""", samples AS (
        SELECT src AS run, CAST(row_number() OVER (PARTITION BY src ORDER BY hour) * 2 AS DOUBLE) AS \"at\", CAST((hour * 7919 + src * 104729) % 97 * (hour % 50) + hour % 13 AS BIGINT) AS lag
        FROM (SELECT src, event_us // {HOUR_US} AS hour FROM flights GROUP BY ALL))"""


def samples(s, d):
    h = flights(s, d).groupBy("src", F.floor(F.col("event_us") / HOUR_US).alias("hour")).agg(F.lit(1).alias("x"))
    at = (F.row_number().over(Window.partitionBy("src").orderBy("hour")) * 2).cast("double")
    return h.select(F.col("src").alias("run"), at.alias("at"), ((F.col("hour") * 7919 + F.col("src") * 104729) % 97 * (F.col("hour") % 50) + F.col("hour") % 13).alias("lag"))


TREND = """, w AS (
        SELECT run, \"at\", lag, count(*) OVER f AS k, regr_slope(lag, \"at\" - 0) OVER f AS slope, regr_sxx(lag, \"at\") OVER f AS sxx, regr_syy(lag, \"at\") OVER f AS syy, regr_sxy(lag, \"at\") OVER f AS sxy
        FROM samples WINDOW f AS (PARTITION BY run ORDER BY \"at\" ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
    ), trend AS (
        SELECT run, \"at\", lag, CASE WHEN k >= 3 THEN slope END AS slope,
               CASE WHEN k < 3 THEN NULL WHEN syy - sxy * sxy / sxx <= 1e-6 * syy THEN CASE WHEN slope = 0 OR syy = 0 THEN 0 ELSE 'Infinity' END
                    ELSE abs(slope) / sqrt((syy - sxy * sxy / sxx) / (k - 2) / sxx) END AS t_stat FROM w)"""
rounded = lambda c: F.round(c, 4).alias(c)
query("n3_rolling_trend", sql("SELECT run, \"at\", lag, round(slope, 4) AS slope, round(t_stat, 4) AS t_stat FROM trend", SAMPLES, TREND))(lambda s, d: control.trend(samples(s, d)).select("run", "at", "lag", rounded("slope"), rounded("t_stat")))
query("a9_trend", sql("SELECT run, round(regr_slope(lag, \"at\"), 6) AS slope, count(*) AS n FROM samples GROUP BY run", SAMPLES))(lambda s, d: samples(s, d).groupBy("run").agg(F.round(F.regr_slope("lag", "at"), 6).alias("slope"), F.count(F.lit(1)).alias("n")))
GROW = "t_stat >= 4.6 AND slope > 5 AND lag >= 200"
query("c3_flags", sql(f"SELECT run, \"at\", coalesce({GROW}, false) AS growing, lag < 100 AS quiet, coalesce(t_stat >= 4.6 AND slope < -5, false) OR (lag < 100 AND NOT coalesce({GROW}, false)) AS draining FROM trend", SAMPLES, TREND))(
    lambda s, d: control.flags(control.trend(samples(s, d))).select("run", "at", "growing", "quiet", "draining")
)
STEPS = f""", fl AS (
        SELECT run, "at", lag, slope, t_stat, coalesce({GROW}, false) AS growing, lag < 100 AS quiet,
               coalesce(t_stat >= 4.6 AND slope < -5, false) OR (lag < 100 AND NOT coalesce({GROW}, false)) AS draining, row_number() OVER (PARTITION BY run ORDER BY "at") AS i
        FROM trend
    ), steps AS (
        SELECT DISTINCT run, CAST(0 AS BIGINT) AS i, 0 AS growth, 0 AS drain, 0 AS stuck, CAST(1 AS BIGINT) AS workers, false AS shedding, CAST(NULL AS DOUBLE) AS acted, 'hold' AS action FROM samples
        UNION ALL
        SELECT run, i, growth, drain, stuck, workers + CASE action WHEN 'scale_up' THEN 1 WHEN 'scale_down' THEN -1 ELSE 0 END,
               CASE action WHEN 'shed' THEN true WHEN 'unshed' THEN false ELSE shedding END, CASE WHEN action <> 'hold' THEN "at" ELSE acted END, action
        FROM (
            SELECT *, CASE WHEN i < 3 THEN 'hold' WHEN stuck >= 3 AND NOT shedding THEN 'shed' WHEN shedding AND drain >= 3 THEN 'unshed'
                           WHEN acted IS NOT NULL AND "at" - acted < 10 THEN 'hold' WHEN growth >= 2 AND workers < 4 THEN 'scale_up'
                           WHEN drain >= 2 AND quiet AND NOT growing AND NOT shedding AND workers > 1 THEN 'scale_down' ELSE 'hold' END AS action
            FROM (
                SELECT f.run, f.i, f."at", f.growing, f.quiet, s.workers, s.shedding, s.acted,
                       CASE WHEN f.i >= 3 AND f.growing THEN s.growth + 1 ELSE 0 END AS growth, CASE WHEN f.i >= 3 AND f.draining THEN s.drain + 1 ELSE 0 END AS drain,
                       CASE WHEN f.i >= 3 AND f.growing AND s.workers >= 4 THEN s.stuck + 1 ELSE 0 END AS stuck
                FROM steps s JOIN fl f ON f.run = s.run AND f.i = s.i + 1)))"""
recursive = lambda text: text.replace("WITH ", "WITH RECURSIVE ", 1)
DECIDED = "SELECT {} FROM steps s JOIN fl f ON f.run = s.run AND f.i = s.i"
query("c1_controller", recursive(sql(DECIDED.format('f.run, f."at", f.lag, round(f.slope, 4) AS slope, round(f.t_stat, 4) AS t_stat, s.action, s.workers, s.shedding'), SAMPLES, TREND, STEPS)))(
    lambda s, d: control.decide(samples(s, d)).select("run", "at", "lag", rounded("slope"), rounded("t_stat"), "action", "workers", "shedding")
)
query("a14_peak_final", sql("SELECT run, max(lag) AS peak, arg_max(lag, \"at\") AS final FROM samples GROUP BY run", SAMPLES))(lambda s, d: samples(s, d).groupBy("run").agg(F.max("lag").alias("peak"), F.max_by("lag", "at").alias("final")))
query(
    "n5_stabilise",
    sql("SELECT run, min(\"at\") FILTER (calm = 3) AS stable_at FROM (SELECT run, \"at\", count(*) FILTER (lag <= 1500) OVER (PARTITION BY run ORDER BY \"at\" ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS calm FROM samples) GROUP BY run", SAMPLES),
)(lambda s, d: control.stabilised(samples(s, d), 1500))
query("n6_actions_before", recursive(sql("SELECT run, count(*) FILTER (action <> 'hold' AND i <= 20) AS actions FROM steps WHERE i > 0 GROUP BY run", SAMPLES, TREND, STEPS)))(
    lambda s, d: control.actions_before(control.decide(samples(s, d)), 20)
)
query(
    "n5_stabilise_from",
    sql("""SELECT run, (min(i) FILTER (calm = 3 AND i > 30) - 31) * 2.0 AS seconds FROM (
             SELECT run, row_number() OVER w AS i, count(*) FILTER (lag <= 1500) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS calm FROM samples WINDOW w AS (PARTITION BY run ORDER BY "at")) GROUP BY run""", SAMPLES),
)(lambda s, d: control.time_to_stabilise(samples(s, d), 1500, 30, 2.0))
query("n4_runs", sql("SELECT run, \"at\", lag, CASE WHEN lag > 1000 THEN row_number() OVER (PARTITION BY run, island ORDER BY \"at\") - CASE WHEN island > 0 THEN 1 ELSE 0 END ELSE 0 END AS streak FROM (SELECT *, sum(CASE WHEN lag > 1000 THEN 0 ELSE 1 END) OVER (PARTITION BY run ORDER BY \"at\") AS island FROM samples)", SAMPLES))(
    lambda s, d: (lambda x: x.select("run", "at", "lag", F.when(F.col("lag") > 1000, F.row_number().over(Window.partitionBy("run", "island").orderBy("at")) - F.when(F.col("island") > 0, 1).otherwise(0)).otherwise(0).cast("long").alias("streak")))(
        samples(s, d).withColumn("island", F.sum(F.when(F.col("lag") > 1000, 0).otherwise(1)).over(Window.partitionBy("run").orderBy("at")))
    )
)
query("c10_grid", "SELECT aircraft, burst, cap, workers, aircraft * burst / CAST(cap * workers AS DOUBLE) AS ratio FROM (VALUES (60), (120)) a(aircraft), (VALUES (6), (12)) b(burst), (VALUES (250)) c(cap), (VALUES (1), (2), (4)) w(workers)")(
    lambda s, d: s.createDataFrame([(x,) for x in (60, 120)], "aircraft int").crossJoin(s.createDataFrame([(x,) for x in (6, 12)], "burst int")).crossJoin(s.createDataFrame([(1,), (2,), (4,)], "workers int")).withColumn("cap", F.lit(250)).withColumn("ratio", F.col("aircraft") * F.col("burst") / (F.col("cap") * F.col("workers")).cast("double"))
)
BUCKETED = """, asked AS (
        SELECT src AS client, ingest_us / 1e6 AS "at", event_id * 2 + copy AS seq, row_number() OVER (PARTITION BY src ORDER BY ingest_us / 1e6, event_id * 2 + copy) AS i FROM arrivals
    ), refilled AS (
        SELECT client, "at", seq, i, CAST(4.0 AS DOUBLE) AS tokens, true AS allowed FROM asked WHERE i = 1
        UNION ALL
        SELECT client, "at", seq, i, tokens - CASE WHEN tokens >= 1 - 1e-9 THEN 1 ELSE 0 END, tokens >= 1 - 1e-9
        FROM (SELECT a.client, a."at", a.seq, a.i, CASE WHEN a."at" > r."at" THEN least(CAST(5.0 AS DOUBLE), r.tokens + (a."at" - r."at") * CAST(0.001 AS DOUBLE)) ELSE r.tokens END AS tokens
              FROM refilled r JOIN asked a ON a.client = r.client AND a.i = r.i + 1))"""
query("c8_token_bucket", recursive(sql('SELECT client, "at", seq, allowed FROM refilled', BUCKETED)))(lambda s, d: control.token_bucket(arrivals(s, d).select(F.col("src").alias("client"), (F.col("ingest_us") / 1e6).alias("at"), (F.col("event_id") * 2 + F.col("copy")).alias("seq")), 0.001, 5.0))

# analytic functions, order and sets

query("n1_inversions", sql("SELECT count(*) AS events, count(*) FILTER (event_us < before) AS inversions FROM (SELECT event_us, lag(event_us) OVER (ORDER BY ingest_us, icao24, event_us, copy) AS before FROM arrivals)"))(lambda s, d: store.inversions(arrivals(s, d)))
query("o2_top_windows", sql("SELECT * FROM truth ORDER BY window_us, cell LIMIT 20", TRUTH))(lambda s, d: truth(s, d).orderBy("window_us", "cell").limit(20))
query("o3_topk_cell", sql("SELECT event_id, event_us FROM flights WHERE cell = (SELECT min(cell) FROM flights) ORDER BY event_us DESC, event_id DESC LIMIT 100"))(
    lambda s, d: flights(s, d).join(F.broadcast(flights(s, d).agg(F.min("cell").alias("cell"))), "cell", "left_semi").orderBy(F.desc("event_us"), F.desc("event_id")).limit(100).select("event_id", "event_us")
)
query("u1_key_union", sql("SELECT window_us, cell FROM truth UNION SELECT window_us, cell FROM naive", TRUTH, NAIVE))(lambda s, d: truth(s, d).select("window_us", "cell").union(windows.naive(arrivals(s, d), HOUR_US).select("window_us", "cell")).distinct())
query("u2_missing_keys", sql("SELECT window_us, cell FROM truth EXCEPT SELECT window_us, cell FROM naive", TRUTH, NAIVE))(lambda s, d: truth(s, d).select("window_us", "cell").exceptAll(windows.naive(arrivals(s, d), HOUR_US).select("window_us", "cell")))
query("u3_common_cells", sql(f"SELECT count(*) AS common FROM (SELECT cell FROM flights WHERE {BUCKET} / 65535.0 < 0.25 INTERSECT SELECT cell FROM flights WHERE NOT {BUCKET} / 65535.0 < 0.25)"))(
    lambda s, d: (lambda f, keep: f.filter(~keep).select("cell").intersect(f.filter(keep).select("cell")).agg(F.count(F.lit(1)).alias("common")))(flights(s, d), fn.kept_when_shedding(F.col("cell"), 0.25))
)
query("u4_concat", sql("SELECT src, count(*) AS n FROM arrivals GROUP BY src"))(lambda s, d: (lambda parts: parts.groupBy("src").agg(F.count(F.lit(1)).alias("n")))(reduce(DataFrame.unionByName, [arrivals(s, d).filter(F.col("src") == k) for k in SOURCES])))

# reports

LINES = """, lines AS (SELECT window_us, cell, strftime(make_timestamp(window_us), '%Y-%m-%dT%H:%M:%S+00:00') || '|' || cell || '|' || n || '|' || printf('%.4f', avg_altitude) || '|' || printf('%.4f', avg_velocity) AS line FROM got)"""
HASHED = """, hashed AS (SELECT window_us, sha256(string_agg(line, chr(10) ORDER BY cell)) AS hash, count(*) AS n FROM lines GROUP BY window_us)"""
query("r4_digest", sql("SELECT sha256(string_agg(line, chr(10) ORDER BY window_us, cell)) AS digest, count(*) AS windows FROM lines", ANNOTATED, ON_TIME, LINES))(
    lambda s, d: windows.digest(windows.on_time_windows(annotated(s, d), HOUR_US))
)
query("r4_tree_digest", sql("SELECT sha256(string_agg(hash, chr(10) ORDER BY window_us)) AS digest, CAST(sum(n) AS BIGINT) AS windows FROM hashed", ANNOTATED, ON_TIME, LINES, HASHED))(
    lambda s, d: windows.tree_digest(windows.on_time_windows(annotated(s, d), HOUR_US))
)


def replayed(log_, sources=SOURCES, width_us=HOUR_US, lateness_us=LATENESS_US):
    read = store.sealed(log_, store.partition_stats(log_).select("partition", "begin_offset", "end_offset"))
    return windows.digest(windows.on_time_windows(windows.annotate(read, sources, width_us, lateness_us), width_us))


query("r3_replay", ORACLES["r4_digest"])(lambda s, d: replayed(log(s, d)))
query("r1_reconcile", sql("SELECT (SELECT count(*) FROM log) AS messages, (SELECT count(*) FROM firsts) AS stored, (SELECT count(*) FROM log) - (SELECT count(*) FROM firsts) AS suppressed, true AS balanced", LOG))(
    lambda s, d: log(s, d).agg(F.count(F.lit(1)).alias("messages")).crossJoin(windows.first_copies(arrivals(s, d)).agg(F.count(F.lit(1)).alias("stored")))
    .crossJoin(arrivals(s, d).withColumn("_n", F.row_number().over(Window.partitionBy(*windows.KEY).orderBy(*windows.ORDER))).agg(F.count_if(F.col("_n") > 1).alias("suppressed"))).withColumn("balanced", F.col("messages") == F.col("stored") + F.col("suppressed"))
)
query(
    "r2_disorder",
    sql(
        """SELECT events, inversions, p50, p95, p99, maximum, beyond FROM
           (SELECT count(*) AS events, count(*) FILTER (event_us < before) AS inversions FROM (SELECT event_us, lag(event_us) OVER (ORDER BY ingest_us, icao24, event_us, copy) AS before FROM arrivals)),
           (SELECT quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.95) AS p95, quantile_cont(v, 0.99) AS p99, max(v) AS maximum, count(*) FILTER (v > 1800) AS beyond FROM (SELECT CAST((ingest_us - event_us) // 1000000 AS DOUBLE) AS v FROM arrivals))"""
    ),
)(
    lambda s, d: store.inversions(arrivals(s, d)).crossJoin(store.percentiles(arrivals(s, d), F.floor((F.col("ingest_us") - F.col("event_us")) / 1_000_000).cast("double")).select("p50", "p95", "p99", "maximum"))
    .crossJoin(arrivals(s, d).agg(F.count_if(F.floor((F.col("ingest_us") - F.col("event_us")) / 1_000_000) > 1800).alias("beyond")))
)
query(
    "r8_arm",
    sql("""SELECT run, max(lag) AS peak_lag, arg_max(lag, "at") AS final_lag, count(*) * 500 AS published, count(*) * 500 - arg_max(lag, "at") AS stored, arg_max(lag, "at") AS undrained,
             round(100.0 * (count(*) * 500 - arg_max(lag, "at")) / (count(*) * 500), 4) AS absorbed_pct, (min(i) FILTER (calm = 3 AND i > 30) - 31) * 2.0 AS stabilise_s
           FROM (SELECT *, row_number() OVER w AS i, count(*) FILTER (lag <= 1500) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS calm FROM samples WINDOW w AS (PARTITION BY run ORDER BY "at")) GROUP BY run""", SAMPLES),
)(lambda s, d: control.analyse(samples(s, d).withColumn("published", F.lit(500)), 1500, 30, 2.0))
