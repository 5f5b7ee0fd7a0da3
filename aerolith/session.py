"""Session settings that the library's results depend on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "aerolith", cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster supplies its own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
