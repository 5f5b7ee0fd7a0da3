"""A flight view over the events table, in integers alone, with disorder, repeats and heights below zero added by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
SOURCES = tuple(range(6))
LATENESS_US = 1_800_000_000


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts", "value")
    i, u = F.col("event_id"), F.col("user_id")
    lat = (u * 37 + i % 7) % 130 - 60
    lon = (u * 53 + i % 11) % 360 - 180
    skew = F.when(i % 10 < 3, (i * 7919) % 2700).when(i % 50 == 9, 7200 + (i * 31) % 7200).otherwise(0)
    part = lambda x: F.floor(x / F.lit(5.0)).cast("string")
    event_us = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.select(
        "event_id", "user_id", F.lower(F.lpad(F.hex((u * 65537) % 16777216), 6, "0")).alias("icao24"), event_us.alias("event_us"),
        lat.alias("lat_i"), lon.alias("lon_i"), F.concat_ws(":", part(lat), part(lon)).alias("cell"), F.when(i % 9 == 4, -((i * 13) % 501)).otherwise(F.round(F.col("value") * 100).cast("long")).alias("alt_cm"),
        ((u * 131 + i * 17) % 30000).alias("vel_cm"), (event_us + skew.cast("long") * 1_000_000).alias("ingest_us"), (u % 6).alias("src"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every flight row, and one in twenty once more up to five minutes later."""
    f = flights(spark, sf_dir)
    again = f.filter(F.col("event_id") % 20 == 0).withColumn("ingest_us", F.col("ingest_us") + 1_000_000 * (F.col("event_id") % 300))
    return f.withColumn("copy", F.lit(0)).unionByName(again.withColumn("copy", F.lit(1)))


#: The same views in DuckDB's SQL, and what the queries share.
FLIGHTS_SQL = """
    f0 AS (
        SELECT event_id, user_id, lower(lpad(printf('%X', (user_id * 65537) % 16777216), 6, '0')) AS icao24, epoch_us(ts) AS event_us,
               (user_id * 37 + event_id % 7) % 130 - 60 AS lat_i, (user_id * 53 + event_id % 11) % 360 - 180 AS lon_i,
               CASE WHEN event_id % 9 = 4 THEN -((event_id * 13) % 501) ELSE CAST(round(value * 100) AS BIGINT) END AS alt_cm, (user_id * 131 + event_id * 17) % 30000 AS vel_cm,
               CASE WHEN event_id % 10 < 3 THEN (event_id * 7919) % 2700 WHEN event_id % 50 = 9 THEN 7200 + (event_id * 31) % 7200 ELSE 0 END AS skew_s,
               user_id % 6 AS src
        FROM events
    ), flights AS (
        SELECT event_id, user_id, icao24, event_us, lat_i, lon_i, CAST(floor(lat_i / 5.0) AS BIGINT) || ':' || CAST(floor(lon_i / 5.0) AS BIGINT) AS cell,
               alt_cm, vel_cm, event_us + skew_s * 1000000 AS ingest_us, src
        FROM f0
    ), arrivals AS (
        SELECT *, 0 AS copy FROM flights
        UNION ALL
        SELECT * REPLACE (ingest_us + 1000000 * (event_id % 300) AS ingest_us), 1 AS copy FROM flights WHERE event_id % 20 = 0
    ), firsts AS (
        SELECT * FROM arrivals QUALIFY row_number() OVER (PARTITION BY icao24, event_us ORDER BY ingest_us, copy) = 1
    )"""


def windows_sql(name: str, rows: str, time: str, where: str = "true") -> str:
    return f""", {name} AS (
        SELECT {time} - {time} % {HOUR_US} AS window_us, cell, count(*) AS n,
               CAST(sign(sum(alt_cm)) * ((2 * 100 * abs(sum(alt_cm)) + count(*)) // (2 * count(*))) AS BIGINT) / 10000.0 AS avg_altitude,
               CAST((2 * 100 * sum(vel_cm) + count(*)) // (2 * count(*)) AS BIGINT) / 10000.0 AS avg_velocity
        FROM {rows} WHERE {where} GROUP BY ALL
    )"""


def annotated_sql(lateness_us: int = LATENESS_US, sources: tuple[int, ...] = SOURCES) -> str:
    order = "(ORDER BY ingest_us, icao24, event_us, copy ROWS BETWEEN UNBOUNDED PRECEDING AND {})"
    of = "max(CASE WHEN {} THEN event_us END) OVER " + order.format("CURRENT ROW")
    marks = ", ".join(of.format(f"src = {s}" if len(sources) > 1 else "true") for s in sources)
    least = f"least({marks})" if len(sources) > 1 else marks
    return f""", a1 AS (SELECT *, {least} - {lateness_us} AS mark_us FROM firsts),
    a2 AS (SELECT *, max(mark_us) OVER {order.format("1 PRECEDING")} AS frontier_us, event_us - event_us % {HOUR_US} AS window_us FROM a1),
    annotated AS (SELECT *, frontier_us IS NOT NULL AND window_us + {HOUR_US} <= frontier_us AS is_late FROM a2)"""


def sql(body: str, *more: str) -> str:
    return f"WITH {FLIGHTS_SQL}{''.join(more)}\n{body}"
