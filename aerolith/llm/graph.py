"""Connected components by alternating star operations, with a row an edge and nothing gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node that it reaches) of the nodes of edges, which has columns a and b.

    A large star ties each node's larger neighbours to its smallest neighbour, a small star its smaller ones; the two
    alternate until only stars are left, which takes about the logarithm of the number of nodes. Hub nodes are joined to
    one row each, so a skewed join can be split.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialise(e, "edges")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u <> v").distinct()
        e = materialise(small, "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u: as u > v, every v is then the least node of its star."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select("v").distinct().select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 and up > 0").isEmpty()
