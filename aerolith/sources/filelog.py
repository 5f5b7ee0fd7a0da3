"""A log on files: one row a message, with topic, partition, offset, key and value, as a broker's source gives it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([T.StructField(c, t) for c, t in (("topic", T.StringType()), ("partition", T.LongType()), ("offset", T.LongType()), ("key", T.StringType()), ("value", T.StringType()))])


def publish(rows: DataFrame, path: str, topic: str, key: str = "cell") -> None:
    """rows with partition and offset (see store.to_log) as JSON messages; in files by partition."""
    payload = [c for c in rows.columns if c not in ("partition", "offset")]
    out = rows.select(F.lit(topic).alias("topic"), "partition", "offset", F.col(key).alias("key"), F.to_json(F.struct(*payload)).alias("value"))
    out.write.mode("append").parquet(f"{path}/{topic}")


def read(spark: SparkSession, path: str, topic: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/{topic}")


def subscribe(spark: SparkSession, path: str, topic: str, files_a_batch: int = 8, starting: str = "earliest") -> DataFrame:
    """The log as a stream, from its beginning, or, starting at `latest`, from where its partitions end now."""
    stream = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_a_batch).parquet(f"{path}/{topic}")
    if starting == "earliest":
        return stream
    if starting != "latest":
        raise ValueError(f"no start named {starting}")
    ends = read(spark, path, topic).groupBy("partition").agg((F.max("offset") + 1).alias("_end")).collect()  # a row a partition of the log
    begin = spark.createDataFrame([(r["partition"], r["_end"]) for r in ends], "partition long, _end long")
    return stream.join(F.broadcast(begin), "partition", "left").filter("offset >= coalesce(_end, 0)").select(*LOG_SCHEMA.names)


def decode(log: DataFrame, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that parse, and those that do not: dead letters by their place in the log."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    x = log.withColumn("x", F.from_json("value", T.StructType([*fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    good = x.filter(F.col("x._bad").isNull() & F.col("value").isNotNull()).select("partition", "offset", *[F.col(f"x.{f.name}").alias(f.name) for f in fields])
    dead = x.filter(F.col("x._bad").isNotNull() | F.col("value").isNull()).select("topic", "partition", "offset", F.col("value").alias("payload"), F.lit("does not parse").alias("error"))
    return good, dead


def open_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """A source by name: `log` (path, topic), `stream` (path, topic), `synthetic` (see synthetic.fleet) or `kafka`, where
    its connector is on the class path (options as the connector's)."""
    from aerolith.sources.synthetic import fleet

    if kind == "log":
        return read(spark, **options)
    if kind == "stream":
        return subscribe(spark, **options)
    if kind == "synthetic":
        return fleet(spark, **options)
    if kind == "kafka":
        return spark.readStream.format("kafka").options(**options).load()
    raise ValueError(f"no source named {kind}")
