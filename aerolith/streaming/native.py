"""Windows by Structured Streaming's own watermark, one for each source, and idempotent sinks.

The engine's watermark moves between micro-batches, so rows that are late by the per-event rules may still be counted;
where the allowed lateness covers the disorder there are none and results are the ground truth. Repeats are dropped by
key and window, never by event time alone: that would drop on-time rows behind the watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streaming_windows(sources: Sequence[DataFrame], width_us: int, lateness_us: int) -> DataFrame:
    """Closed windows of streams of arrivals, one stream a source that is known to have data: window_us, cell, n, alt, vel.

    A window closes when the least watermark of the sources passes its end (spark.sql.streaming.multipleWatermarkPolicy
    is `min` unless set).
    """
    every = None
    for s in sources:
        s = s.withColumn("event_time", F.timestamp_micros("event_us")).withWatermark("event_time", f"{lateness_us} microseconds")
        every = s if every is None else every.union(s)
    width = f"{width_us} microseconds"
    once = every.withColumn("w", F.window("event_time", width)).dropDuplicates(["icao24", "event_us", "w"])
    counted = once.groupBy("w", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("alt_cm").alias("alt"), F.sum("vel_cm").alias("vel"))
    return counted.select(F.unix_micros("w.start").alias("window_us"), "cell", "n", "alt", "vel")


def append_new(path: str, keys: Sequence[str]):
    """A foreachBatch sink: rows whose key the table at path has not yet; a replayed batch adds nothing."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.dropDuplicates(list(keys))
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            batch = batch.join(spark.read.parquet(path).select(*keys), list(keys), "left_anti")
        batch.write.mode("append").parquet(path)

    return sink


def run_to_end(stream: DataFrame, sink, checkpoint: str, mode: str = "append") -> None:
    """Runs over what is there now and stops; started again with the same checkpoint it goes on from there."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
