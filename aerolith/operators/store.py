"""Log, keyed store and reports as batch transforms: each is a relation in, a relation out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.operators.slices import MINUTE_US, SLICE_ROWS, sliced


class IncompleteStream(RuntimeError):
    """A sealed read found less than it was promised."""


def to_log(rows: DataFrame, key: str, partitions: int, order: Sequence[str], base: int = 0, slice_us: int = MINUTE_US, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """rows with partition (a stable hash of the key) and offset (their place in it, from base on). The order's first column
    is a time in microseconds.

    Places within a partition come from counts of slices of the order and places within a slice, so a partition of the
    log is not a task.
    """
    part = F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 6), 16, 10).cast("long") % partitions
    return _placed(rows.withColumn("partition", part), ["partition"], order, "offset", base, slice_us, slice_rows)


def arrival_order(rows: DataFrame, order: Sequence[str], slice_us: int = MINUTE_US, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All rows with at: their place, from 1 on, in the order, whose first column is a time in microseconds.

    As in to_log, places come from counts of slices and places within a slice, so no task reads all rows.
    """
    return _placed(rows, [], order, "at", 1, slice_us, slice_rows)


def _placed(rows: DataFrame, by: list[str], order: Sequence[str], name: str, base: int, slice_us: int, slice_rows: int) -> DataFrame:
    rows, n = sliced(rows, order[0], "_slice", slice_us, slice_rows)
    if n == 1:
        place = F.row_number().over((Window.partitionBy(*by) if by else Window).orderBy(*order))
        return rows.withColumn(name, (place + (base - 1)).cast("long")).drop("_slice")
    counts = rows.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*by) if by else Window).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*by, "_slice").orderBy(*order))
    return rows.join(starts, [*by, "_slice"]).withColumn(name, F.col("_start") + place + (base - 1)).drop("_slice", "_start")


def partition_stats(log: DataFrame) -> DataFrame:
    return log.groupBy("partition").agg(F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset"), F.count(F.lit(1)).alias("messages"))


def sealed(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Exactly the rows before each partition's end; raises where the log lacks any of them or there is none at all.

    ends: partition, begin_offset, end_offset, a row a partition of the log. One pass over the log's offsets checks that each
    partition has as many different ones as it should.
    """
    named = ends.withColumnsRenamed({"begin_offset": "_begin", "end_offset": "_end"})
    read = log.join(named, "partition").filter("offset >= _begin and offset < _end").drop("_begin", "_end")
    got = read.groupBy("partition").agg(F.countDistinct("offset").alias("got"))
    told = ends.join(got, "partition", "left").select("partition", F.coalesce("got", F.lit(0)).alias("got"), (F.col("end_offset") - F.col("begin_offset")).alias("wanted"))
    one = told.agg(F.coalesce(F.sum("wanted"), F.lit(0)).alias("n"), F.min(F.when(F.col("got") != F.col("wanted"), F.struct("partition", "got", "wanted"))).alias("short")).first()
    if one["n"] == 0:
        raise IncompleteStream("the log is empty")
    if (short := one["short"]) is not None:
        raise IncompleteStream(f"partition {short['partition']} has {short['got']} of {short['wanted']} messages")
    return read


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What an idempotent insert of batch adds to target: first copies whose key is not there."""
    return first_wins(batch, keys, order).join(target.select(*keys), list(keys), "left_anti")


def latest_wins(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Latest window of each cell after a compare-and-set: an older window, or a smaller count of the same, is refused;
    a tie goes through. Both: cell, window_us, n."""
    both = current.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return both.groupBy("cell").agg(F.max(F.struct("window_us", "n", "_new")).alias("x")).select("cell", "x.window_us", "x.n", (F.col("x._new") == 1).alias("replaced"))


def partition_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """lag of each partition: what was never committed counts from 0, and no lag is negative; unknown ends stay null."""
    behind = F.col("end_offset") - F.coalesce("committed", F.lit(0))
    return ends.join(committed, "partition", "left").select("partition", "end_offset", "committed", F.when(F.col("end_offset").isNotNull(), F.greatest(behind, F.lit(0))).alias("lag"))


def retained(rows: DataFrame, now_us: Column, days: int, time: str = "event_us") -> DataFrame:
    """Rows on days that retention keeps; whole days go, as partitions of a table do."""
    day = 24 * 3600 * 1_000_000
    return rows.filter(F.floor(F.col(time) / day) >= F.floor(now_us / day) - days)


def latest_per_cell(windows: DataFrame) -> DataFrame:
    """Latest finalized window of each cell."""
    rest = [c for c in windows.columns if c != "cell"]
    return windows.groupBy("cell").agg(F.max_by(F.struct(*rest), "window_us").alias("x")).select("cell", "x.*")


def status(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.max("event_us").alias("max_event_us"), F.countDistinct("icao24").alias("aircraft"), F.countDistinct("cell").alias("cells"))


def percentiles(rows: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """n, p50, p95, p99 (continuous), average and maximum of a value."""
    rows = rows.withColumn("_v", value)
    at = lambda p: F.percentile("_v", F.lit(p))
    return rows.groupBy(*by).agg(F.count("_v").alias("n"), at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99"), F.avg("_v").alias("average"), F.max("_v").alias("maximum"))


def summary(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """n, median, mean, sample deviation (0 for one value), least, most and missing values."""
    return rows.groupBy(*by).agg(
        F.count(value).alias("n"), F.median(value).alias("median"), F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("stdev"),
        F.min(value).alias("least"), F.max(value).alias("most"), F.count_if(F.col(value).isNull()).alias("missing"),
    )


def inversions(rows: DataFrame, slice_us: int = MINUTE_US, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row: how many rows, by arrival, have an event time before that of the row in front of them.

    Slices of the order are sorted on their own; the last row of the slice before is carried in.
    """
    order = ["ingest_us", "icao24", "event_us", "copy"]
    rows, n = sliced(rows, "ingest_us", "_slice", slice_us, slice_rows)
    before = F.lag("event_us").over((Window.partitionBy("_slice") if n > 1 else Window).orderBy(*order))
    if n > 1:
        ends = rows.groupBy("_slice").agg(F.max_by("event_us", F.struct(*order)).alias("_last"))
        rows = rows.join(ends.select("_slice", F.lag("_last").over(Window.orderBy("_slice")).alias("_carried")), "_slice")
        before = F.coalesce(before, F.col("_carried"))
    return rows.withColumn("_before", before).agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_us") < F.col("_before")).alias("inversions"))


DAY_US = 24 * 3600 * 1_000_000


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def save_days(rows: DataFrame, path: str, time: str = "event_us", mode: str = "append") -> None:
    """rows as a table in a folder a day, so retention drops whole folders."""
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col(time) / DAY_US).cast("int")), "yyyy-MM-dd")
    rows.withColumn("day", day).write.mode(mode).partitionBy("day").parquet(path)


def drop_days(spark: SparkSession, path: str, before: str) -> int:
    """Deletes the days before `before` (yyyy-mm-dd) of a table of save_days(); how many there were. Rows are not read."""
    files, at = _folder(spark, path)
    old = [x.getPath() for x in files.listStatus(at) if x.getPath().getName().startswith("day=") and x.getPath().getName() < f"day={before}"]
    for x in old:
        files.delete(x, True)
    return len(old)


def delete_where(spark: SparkSession, path: str, condition: Column) -> int:
    """Deletes the rows for which condition holds from the table at path, by writing the others beside it and then taking its
    place; how many there were. Rows for which it is null stay."""
    rows = spark.read.parquet(path)
    gone = F.coalesce(condition, F.lit(False))
    n = rows.filter(gone).count()
    if n:
        days = [c for c in ("day",) if c in rows.columns]
        rows.filter(~gone).write.mode("overwrite").partitionBy(*days).parquet(f"{path}.next")
        files, at = _folder(spark, path)
        files.delete(at, True)
        files.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.next"), at)
    return n


def truncate(spark: SparkSession, path: str) -> None:
    """Empties the table at path; its schema stays."""
    spark.createDataFrame([], spark.read.parquet(path).schema).write.mode("overwrite").parquet(path)
