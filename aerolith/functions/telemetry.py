"""Scalar functions of telemetry rows, as Column expressions. Times are microseconds since the epoch unless named otherwise."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
DEFAULT_WINDOW_US = 60 * SECOND
DEFAULT_LATENESS_US = 30 * SECOND
CELL_DEGREES = 5.0

STATE_SCHEMA = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("altitude_m", T.DoubleType()),
        T.StructField("velocity_ms", T.DoubleType()),
        T.StructField("heading", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("ingest_time", T.TimestampType()),
    ]
)


def grid_cell(lat: Column, lon: Column, degrees: float = CELL_DEGREES) -> Column:
    """Name of the cell that a place lies in; floors, so cells south and west of zero have negative numbers."""
    number = lambda x: F.floor(x / F.lit(degrees)).cast("string")
    return F.concat_ws(":", number(lat), number(lon))


def tumble(at: Column, width_us: int = DEFAULT_WINDOW_US) -> Column:
    """Start of the window that a time falls into; floors before the epoch too."""
    return at - F.pmod(at, F.lit(width_us))


def mean_4dp(total: Column, count: Column, unit: int = 100) -> Column:
    """total / unit / count rounded to four decimals, halves away from zero, by whole numbers alone: sums in any order agree.

    total counts 1/unit parts.
    """
    scale = 10_000 // unit
    size = F.call_function("div", F.abs(total) * (2 * scale) + count, count * 2)
    return F.when(total < 0, -size).otherwise(size) / F.lit(10_000.0)


def iso_utc(at: Column, fraction: bool = False) -> Column:
    """Microseconds since the epoch as text in UTC, 2026-01-01T00:00:00+00:00, whatever the session's time zone."""
    seconds = F.floor(at / SECOND)
    day, rest = F.floor(seconds / 86_400), F.pmod(seconds, F.lit(86_400))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    date = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int")), "yyyy-MM-dd")
    time = F.concat_ws(":", two(F.floor(rest / 3600)), two(F.pmod(F.floor(rest / 60), F.lit(60))), two(F.pmod(rest, F.lit(60))))
    part = F.concat(F.lit("."), F.lpad(F.pmod(at, F.lit(SECOND)).cast("string"), 6, "0")) if fraction else F.lit("")
    return F.concat(date, F.lit("T"), time, part, F.lit("+00:00"))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def violations() -> Column:
    """Names of the contract's rules that a state row breaks, in order."""
    between = lambda c, low, high: finite(F.col(c)) & (F.col(c) >= low) & (F.col(c) <= high)
    rules = {
        "icao24": F.col("icao24").rlike(r"\A[0-9a-f]{6}\z"),
        "callsign": F.col("callsign").rlike(r"\A[\x20-\x7e]{1,8}\z"),
        "lat": between("lat", -90.0, 90.0),
        "lon": between("lon", -180.0, 180.0),
        "altitude_m": finite(F.col("altitude_m")) & (F.col("altitude_m") >= -500.0),
        "velocity_ms": finite(F.col("velocity_ms")) & (F.col("velocity_ms") >= 0.0),
        "heading": finite(F.col("heading")) & (F.col("heading") >= 0.0) & (F.col("heading") < 360.0),
        "event_time": F.col("event_time").isNotNull(),
        "ingest_time": F.col("ingest_time").isNotNull(),
    }
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())


def shed_bucket(cell: Column) -> Column:
    """A stable number in [0, 65535] of a cell."""
    return F.conv(F.substring(F.md5(cell.cast("binary")), 1, 4), 16, 10).cast("long")


def kept_when_shedding(cell: Column, fraction: float) -> Column:
    """False for all rows of the cells that are shed: about the fraction, at 0 none and at 1 all but the last bucket."""
    return F.lit(fraction <= 0) | ~(shed_bucket(cell) / 65535.0 < fraction)


def trace_id(icao24: Column, event_time: Column) -> Column:
    """16 hex digits that name a row; stable over reruns."""
    return F.substring(F.sha2(F.concat_ws("|", icao24, iso_utc(F.unix_micros(event_time), True)), 256), 1, 16)


def in_box(lat: Column, lon: Column, box: Sequence[float]) -> Column:
    south, west, north, east = box
    return lat.between(south, north) & lon.between(west, east)


def parse_box(spec: str) -> tuple[float, float, float, float]:
    """'south,west,north,east' in degrees; ValueError where it is no box."""
    parts = [float(x) for x in spec.split(",")]
    if len(parts) != 4:
        raise ValueError("a box has four numbers: south, west, north, east")
    south, west, north, east = parts
    if not (-90 <= south < north <= 90 and -180 <= west < east <= 180):
        raise ValueError(f"not a box: {spec}")
    return south, west, north, east


def histogram_bucket(value: Column, bounds: Iterable[float]) -> Column:
    """The least bound that a value does not pass; infinity beyond the last."""
    out = None
    for b in bounds:
        out = F.when(value <= b, F.lit(float(b))) if out is None else out.when(value <= b, F.lit(float(b)))
    return out.otherwise(F.lit(float("inf")))
