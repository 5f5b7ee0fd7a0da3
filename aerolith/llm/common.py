"""What the operators share: the word pattern, scratch tables, and the size bounds of broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: A side is broadcast only if it was counted and has no more rows than this; beyond it Spark shuffles.
BROADCAST_ROWS = 20_000

CHECKPOINT = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names. One that is not named is made up for a local master alone, as in tests:
    on a cluster executors would each write to a disk of their own."""
    root = spark.conf.get(CHECKPOINT, None) or spark.sparkContext.getConf().get(CHECKPOINT)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT} to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="aerolith-")  # one machine
        spark.conf.set(CHECKPOINT, root)
    return root


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends here, and a lost executor costs nothing.

    Its codec keeps no contexts outside the heap, of which wide tables would need one a column and task.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/aerolith/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Whole texts go to Python workers and back in batches of about so many rows and bytes.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs in here, not what is only planned, exchanges small batches with Python. A batch of 10,000 texts stands
    several times over in an executor: off the heap on its way out and back, and in the worker as texts and as results."""
    before = {k: spark.conf.get(k, None) for k in BATCHES}
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drop_scratch(spark: SparkSession, *labels: str) -> None:
    """Deletes scratch tables: all of them, or those whose label begins so; for when no result on them is still to be read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for label in labels or ("",):
        path = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/aerolith/{label}*")
        files = path.getFileSystem(conf)
        for found in files.globStatus(path) or ():
            files.delete(found.getPath(), True)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files hold it in fewer parts; a table of as many parts as there are cores is left as
    it is, so a large one is never shuffled. The parts that have rows are counted without reading a column."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.select(F.spark_partition_id().alias("part")).groupBy("part").count().count()
    return df.repartition(cores) if parts < cores else df


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marks df for broadcast if its counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
