"""Cutting an order of arrival into slices of counted rows, so that no task has to hold the whole order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MINUTE_US = 60_000_000
#: Rows that a slice has before the next one begins.
SLICE_ROWS = 1_000_000


def sliced(rows: DataFrame, time: str, name: str, grid_us: int = MINUTE_US, slice_rows: int | None = SLICE_ROWS) -> tuple[DataFrame, int]:
    """rows with the column `name`, the number of its slice in the order of `time` (microseconds), and how many slices there
    are. Rows are counted in cells of grid_us, a row a cell reaches the driver, and cells are gathered until they hold
    slice_rows; so a slice has about so many rows, or those of one cell. Rows without a time are in the first. With None for
    slice_rows nothing is counted: the caller knows that the rows are few enough for one slice."""
    if slice_rows is None:
        return rows.withColumn(name, F.lit(0).cast("long")), 1
    counted = rows.groupBy(F.floor(F.col(time) / grid_us).alias("cell")).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("cell", na_position="first")
    if counted["n"].sum() <= slice_rows or len(counted) < 2:
        return rows.withColumn(name, F.lit(0).cast("long")), 1
    before = counted["n"].cumsum() - counted["n"]
    numbers = (before // slice_rows).rank(method="dense").astype("int64") - 1
    cells = counted.assign(number=numbers)[["cell", "number"]].dropna()
    table = rows.sparkSession.createDataFrame(cells.astype("int64")).withColumnsRenamed({"cell": "_cell", "number": name})
    out = rows.withColumn("_cell", F.floor(F.col(time) / grid_us)).join(table, "_cell", "left").withColumn(name, F.coalesce(name, F.lit(0))).drop("_cell")
    return out, int(numbers.iloc[-1]) + 1
