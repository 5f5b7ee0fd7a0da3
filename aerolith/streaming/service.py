"""Sinks of the live service, each idempotent by batch: run again, a batch changes nothing.

A batch's outcome is written under its number, and readers take the newest number or the sum over numbers; so a restart
that replays the last batch replaces what that batch wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.config import Settings
from aerolith.operators import store
from aerolith.sources.poller import with_retry
from aerolith.streaming.exact import exact_windows

LATEST = "cell string, window_us long, n long"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
    whole = [x for x in names if x.startswith("batch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{x}/_SUCCESS"))]
    return sorted(int(x.removeprefix("batch=")) for x in whole)


def latest_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Keeps the latest window of each cell by compare-and-set. batch: cell, window_us, n."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        older = [n for n in _numbers(spark, path) if n < batch_id]
        current = spark.read.schema(LATEST).parquet(f"{path}/batch={older[-1]}") if older else batch.select("cell", "window_us", "n").limit(0)
        newest = store.latest_per_cell(batch.select("cell", "window_us", "n"))
        store.latest_wins(current, newest).drop("replaced").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return sink


def read_latest(spark: SparkSession, path: str, cell: str | None = None) -> DataFrame:
    numbers = _numbers(spark, path)
    rows = spark.read.schema(LATEST).parquet(f"{path}/batch={numbers[-1]}") if numbers else spark.createDataFrame([], LATEST)
    return rows if cell is None else rows.filter(F.col("cell") == cell)


def late_total_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Counts a batch's late events by source under the batch's number."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("src").agg(F.count(F.lit(1)).alias("late")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return sink


def late_totals(spark: SparkSession, path: str) -> DataFrame:
    """Sums over all batches, read as one table partitioned by batch."""
    if not _numbers(spark, path):
        return spark.createDataFrame([], "src long, late long")
    rows = spark.read.schema("src long, late long, batch long").option("basePath", path).parquet(f"{path}/batch=*")
    return rows.groupBy("src").agg(F.sum("late").alias("late"))


def compact(spark: SparkSession, path: str, keep: int = 10) -> int:
    """Drops all but the newest batches of a table whose newest batch holds everything, as latest_sink()'s does; how many."""
    old = _numbers(spark, path)[:-keep]
    jvm = spark.sparkContext._jvm
    for n in old:
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/batch={n}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(old)


def window_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A batch's windows under its number."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return sink


def retried(sink: Callable[[DataFrame, int], None], attempts: int = 5, base_s: float = 0.2) -> Callable[[DataFrame, int], None]:
    """A sink that is tried again after transient errors; the last one stops the query, and nothing is committed."""
    return lambda batch, batch_id: with_retry(lambda: sink(batch, batch_id), attempts, base_s, TRANSIENT)


TRANSIENT = (ConnectionError, TimeoutError, OSError)


def serve(arrivals: DataFrame, path: str, settings: Settings = Settings(), awaited: Sequence = (), tick_ms: int | None = None, on_batch: Callable[[DataFrame, int], None] | None = None):
    """Starts the live service on a stream of arrivals with a pipeline column and gives its query: rows are windowed exactly,
    closed windows published and the latest of each cell kept, late events counted, and then the batch is committed. What a
    row with an empty icao24 flushes at the end is written as a preview and published nowhere.

    Under path: windows, latest, late, preview and the checkpoint. A batch that is run again after a crash replaces what it
    wrote, so sinks and checkpoint agree.
    """
    idle = None if settings.idle_timeout_s is None else round(settings.idle_timeout_s * 1_000_000)
    told = exact_windows(arrivals, settings.window_us, settings.lateness_us, None, idle, awaited, tick_ms)
    windows, latest, late, preview = window_sink(f"{path}/windows"), latest_sink(f"{path}/latest"), late_total_sink(f"{path}/late"), window_sink(f"{path}/preview")

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            closed = batch.filter("kind = 'closed'").select("window_us", "cell", "n", "alt", "vel")
            windows(closed, batch_id)
            latest(closed, batch_id)
            late(batch.filter("kind = 'late'"), batch_id)
            preview(batch.filter("kind = 'flushed'").select("window_us", "cell", "n", "alt", "vel"), batch_id)
            if on_batch is not None:
                on_batch(batch, batch_id)
        finally:
            batch.unpersist()

    return told.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint").foreachBatch(retried(publish))


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The windows that a service has published under path."""
    schema = "window_us long, cell string, n long, alt long, vel long"
    if not _numbers(spark, f"{path}/windows"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch long").option("basePath", f"{path}/windows").parquet(f"{path}/windows/batch=*").drop("batch")


def split_valid(parsed: DataFrame, broken: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and those that do not with the rules that they break; broken: an array of names."""
    told = parsed.withColumn("_broken", broken)
    return told.filter(F.size("_broken") == 0).drop("_broken"), told.filter(F.size("_broken") > 0).withColumn("error", F.array_join("_broken", ",")).drop("_broken")
