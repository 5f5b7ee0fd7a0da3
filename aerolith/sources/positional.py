"""State vectors that come as positional JSON arrays, repaired or refused by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.telemetry import finite

#: Places of the fields in a vector.
PLACES = {"icao24": 0, "callsign": 1, "time_position": 3, "lon": 5, "lat": 6, "baro_altitude": 7, "on_ground": 8, "velocity": 9, "track": 10, "geo_altitude": 13}
LEAST_FIELDS = 14


def parse_states(raw: DataFrame, column: str = "value") -> DataFrame:
    """raw with outcome ('emitted', 'skipped' without a position, 'malformed'), substituted, repaired and the state.

    A missing barometric altitude is substituted by the geometric one; without either it is 0, which is a repair unless
    on the ground. Missing velocity or track become 0, a repair of the row. A blank callsign becomes the icao24. Track
    and longitude wrap, a negative velocity becomes 0.
    """
    vector = F.from_json(column, "array<string>")
    x = raw.withColumn("v", vector).withColumn("whole", F.coalesce(F.size("v") >= LEAST_FIELDS, F.lit(False)))
    at = lambda name: F.get("v", F.lit(PLACES[name]))
    number = lambda name: at(name).try_cast("double")
    garbled = lambda name: at(name).isNotNull() & number(name).isNull()
    baro, geo, ground = number("baro_altitude"), number("geo_altitude"), F.coalesce(at("on_ground") == "true", F.lit(False))
    x = x.withColumns({
        "icao24": F.trim(at("icao24")), "lat": number("lat"), "lon": F.pmod(number("lon") + 180.0, F.lit(360.0)) - 180.0, "altitude_m": F.coalesce(baro, geo, F.lit(0.0)),
        "velocity_ms": F.greatest(F.coalesce(number("velocity"), F.lit(0.0)), F.lit(0.0)), "heading": F.pmod(F.coalesce(number("track"), F.lit(0.0)), F.lit(360.0)), "seconds": number("time_position"),
        "substituted": baro.isNull() & geo.isNotNull(), "repaired": (baro.isNull() & geo.isNull() & ~ground) | number("velocity").isNull() | number("track").isNull(),
        "absent": at("lat").isNull() | at("lon").isNull() | at("time_position").isNull(), "odd": garbled("lat") | garbled("lon") | garbled("time_position") | garbled("baro_altitude") | garbled("velocity") | garbled("track"),
    })
    x = x.withColumn("callsign", F.coalesce(F.nullif(F.substring(F.trim(at("callsign")), 1, 8), F.lit("")), F.col("icao24")))
    valid = F.col("icao24").rlike(r"\A[0-9a-f]{6}\z") & F.col("lat").between(-90.0, 90.0) & F.col("lon").between(-180.0, 180.0) & (F.col("altitude_m") >= -500.0) & finite(F.col("velocity_ms")) & F.col("seconds").between(0.0, 253402300799.0)
    outcome = F.when(~F.col("whole"), "malformed").when(F.col("absent"), "skipped").when(F.col("odd") | ~F.coalesce(valid, F.lit(False)), "malformed").otherwise("emitted")
    x = x.withColumn("outcome", outcome).withColumn("event_us", F.when(outcome == "emitted", (F.col("seconds") * 1_000_000).try_cast("long")))
    state = ["icao24", "callsign", "lat", "lon", "altitude_m", "velocity_ms", "heading", "event_us"]
    kept = F.col("outcome") == "emitted"
    return x.select(*raw.columns, "outcome", (kept & F.col("substituted")).alias("substituted"), (kept & F.col("repaired")).alias("repaired"), *[F.when(kept, F.col(c)).alias(c) for c in state])


def poll_counts(parsed: DataFrame) -> DataFrame:
    """fetched == emitted + skipped + malformed, and the repairs among those emitted."""
    return parsed.agg(F.count(F.lit(1)).alias("fetched"), *[F.count_if(F.col("outcome") == k).alias(k) for k in ("emitted", "skipped", "malformed")], F.count_if("substituted").alias("substituted"), F.count_if("repaired").alias("repaired"))
