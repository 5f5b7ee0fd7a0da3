"""A seeded fleet with adjustable disorder.

Every row is a function of the seed, the aircraft and the tick, so any split of the work gives the same rows. Positions
are integrated along each aircraft's ticks by window sums; noise comes from hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.functions.telemetry import grid_cell


@dataclass(frozen=True)
class Chaos:
    out_of_order: float = 0.0
    max_skew_s: float = 0.0
    duplicates: float = 0.0
    drops: float = 0.0
    late: float = 0.0
    late_s: float = 0.0


#: Earth in metres a degree of latitude, and bounds of a state.
METRES_A_DEGREE = 111_320.0
MOST_LATITUDE, MOST_ALTITUDE = 85.0, 13_000.0


def fleet(spark: SparkSession, aircraft: int, ticks: int, seed: int = 1, chaos: Chaos = Chaos(), start_us: int = 1_767_225_600_000_000, tick_s: float = 1.0, slices: int | None = None) -> DataFrame:
    """States of `aircraft` aircraft for `ticks` ticks, in no order, with ingest time by the chaos."""
    draw = lambda name, *of: F.pmod(F.xxhash64(F.lit(name), F.lit(seed), *map(F.col, of)), F.lit(1 << 40)) / float(1 << 40)
    between = lambda u, a, b: u * (b - a) + F.lit(float(a))
    planes = spark.range(0, aircraft, 1, slices or min(aircraft, 64)).withColumnRenamed("id", "plane")
    planes = planes.select(
        "plane", F.lower(F.lpad(F.hex((F.col("plane") * 65537 + seed) % 16777216), 6, "0")).alias("icao24"), between(draw("lat", "plane"), -60, 60).alias("lat0"), between(draw("lon", "plane"), -180, 180).alias("lon0"),
        between(draw("alt", "plane"), 1000, 11000).alias("alt0"), between(draw("speed", "plane"), 120, 260).alias("velocity_ms"), between(draw("heading", "plane"), 0, 360).alias("heading0"),
    )
    rows = planes.withColumn("tick", F.explode(F.sequence(F.lit(0), F.lit(ticks - 1)))).withColumn("turn", between(draw("turn", "plane", "tick"), -2, 2)).withColumn("climb", between(draw("climb", "plane", "tick"), -8, 8))
    along = Window.partitionBy("plane").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("heading", F.pmod(F.col("heading0") + F.sum("turn").over(along), F.lit(360.0)))
    step = F.col("velocity_ms") * tick_s / METRES_A_DEGREE
    north = F.sum(step * F.cos(F.radians("heading"))).over(along)
    lat = F.greatest(F.lit(-MOST_LATITUDE), F.least(F.lit(MOST_LATITUDE), F.col("lat0") + north))
    rows = rows.withColumn("lat", lat)
    east = F.sum(step * F.sin(F.radians("heading")) / F.cos(F.radians("lat"))).over(along)
    lon = F.pmod(F.col("lon0") + east + 180.0, F.lit(360.0)) - 180.0
    altitude = F.greatest(F.lit(0.0), F.least(F.lit(MOST_ALTITUDE), F.col("alt0") + F.sum("climb").over(along)))
    rows = rows.withColumn("lon", lon).withColumn("altitude_m", altitude).withColumn("event_us", F.lit(start_us) + (F.col("tick") * int(tick_s * 1e6)).cast("long"))
    late = draw("is_late", "plane", "tick") < chaos.late
    moved = draw("moved", "plane", "tick") < chaos.out_of_order
    delay: Column = F.when(late, between(draw("late", "plane", "tick"), chaos.late_s, 2 * chaos.late_s)).when(moved, draw("skew", "plane", "tick") * chaos.max_skew_s).otherwise(0.0)
    rows = rows.filter(draw("drop", "plane", "tick") >= chaos.drops).withColumn("copies", F.when(draw("twice", "plane", "tick") < chaos.duplicates, 2).otherwise(1))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    ingest = F.col("event_us") + ((delay + F.col("copy") * draw("again", "plane", "tick") * F.lit(chaos.max_skew_s or 1.0)) * 1e6).cast("long")
    return rows.select(
        "icao24", F.concat(F.lit("FL"), F.col("plane").cast("string")).alias("callsign"), "lat", "lon", "altitude_m", "velocity_ms", "heading", "event_us", ingest.alias("ingest_us"), "copy",
        grid_cell(F.col("lat"), F.col("lon")).alias("cell"), F.round(F.col("altitude_m") * 100).cast("long").alias("alt_cm"), F.round(F.col("velocity_ms") * 100).cast("long").alias("vel_cm"), (F.col("plane") % 6).alias("src"),
    )


def fleet_stream(spark: SparkSession, aircraft: int, seed: int = 1, ticks_a_batch: int = 1, tick_s: float = 1.0, start_us: int = 1_767_225_600_000_000) -> DataFrame:
    """The fleet as a stream, ticks_a_batch ticks of all aircraft a micro-batch, each of which is told when it happened; paced
    by the query's trigger. A position is a function of the tick alone: straight courses, with heights that sway."""
    draw = lambda name: F.pmod(F.xxhash64(F.lit(name), F.lit(seed), F.col("plane")), F.lit(1 << 40)) / float(1 << 40)
    between = lambda u, a, b: u * (b - a) + F.lit(float(a))
    rows = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", aircraft * ticks_a_batch).option("advanceMillisPerBatch", int(1000 * tick_s * ticks_a_batch)).load()
    rows = rows.select((F.col("value") % aircraft).alias("plane"), F.floor(F.col("value") / aircraft).alias("tick"))
    rows = rows.withColumn("velocity_ms", between(draw("speed"), 120, 260)).withColumn("heading", between(draw("heading"), 0, 360))
    gone = F.col("velocity_ms") * F.col("tick") * tick_s / METRES_A_DEGREE
    lat = F.greatest(F.lit(-MOST_LATITUDE), F.least(F.lit(MOST_LATITUDE), between(draw("lat"), -60, 60) + gone * F.cos(F.radians("heading"))))
    rows = rows.withColumn("lat", lat)
    lon = F.pmod(between(draw("lon"), -180, 180) + gone * F.sin(F.radians("heading")) / F.cos(F.radians("lat")) + 180.0, F.lit(360.0)) - 180.0
    altitude = F.greatest(F.lit(0.0), F.least(F.lit(MOST_ALTITUDE), between(draw("alt"), 1000, 11000) + 300.0 * F.sin(F.col("tick") * tick_s / 60.0)))
    rows = rows.withColumn("lon", lon).withColumn("altitude_m", altitude).withColumn("event_us", F.lit(start_us) + (F.col("tick") * int(tick_s * 1e6)).cast("long"))
    icao24 = F.lower(F.lpad(F.hex((F.col("plane") * 65537 + seed) % 16777216), 6, "0"))
    return rows.select(icao24.alias("icao24"), F.concat(F.lit("FL"), F.col("plane").cast("string")).alias("callsign"), "lat", "lon", "altitude_m", "velocity_ms", "heading", "event_us", grid_cell(F.col("lat"), F.col("lon")).alias("cell"))


@dataclass(frozen=True)
class Level:
    """Disorder of a name, and the bounds on lateness that are tried on it, in seconds."""

    name: str
    chaos: Chaos

    @property
    def bounds_s(self) -> tuple[float, ...]:
        skew = self.chaos.max_skew_s
        return (0.0, skew / 2, skew, 2 * skew, *((2 * self.chaos.late_s + skew,) if self.chaos.late else ())) if skew else (0.0,)


#: Levels of disorder.
LEVELS = (
    Level("none", Chaos(duplicates=0.05, drops=0.01)),
    Level("low", Chaos(out_of_order=0.05, max_skew_s=5.0, duplicates=0.02, drops=0.01)),
    Level("medium", Chaos(out_of_order=0.20, max_skew_s=20.0, duplicates=0.05, drops=0.01)),
    Level("high", Chaos(out_of_order=0.40, max_skew_s=45.0, duplicates=0.10, drops=0.02)),
    Level("medium+late", Chaos(out_of_order=0.20, max_skew_s=20.0, duplicates=0.05, drops=0.01, late=0.02, late_s=90.0)),
    Level("high+late", Chaos(out_of_order=0.40, max_skew_s=45.0, duplicates=0.10, drops=0.02, late=0.05, late_s=120.0)),
)
