"""Mixing sources to target weights with DataFrame operations only.

The words of each source, documents in a fixed pseudorandom order, form one stream that is cut into blocks of a fixed
number of words. The mix is a sequence of slots, each of which takes one block. Slots come in shards; within a shard the
sources of the slots are a multinomial draw by the target shares, stratified so that a shard's counts stay next to
their expectation. The k-th slot of a source takes block perm(k mod n) of its n blocks, perm being a pseudorandom
permutation of [0, n) keyed by source and pass. Joining slots and documents by block index tells what each document
gives.

Cases: a null text has size 0 and gives nothing; a null source is a source of its own, last in order; equal rows each
take their own place in the stream; an empty table gives an empty result. Input columns besides the named ones are
ignored. Reruns on the same rows agree, whatever the partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise, small

#: Fixed values of the contract: weights of the sources in order, repeating, and the most often that a source is used.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3


@dataclass(frozen=True)
class MixConfig:
    block_words: int = 64
    shard_slots: int = 4096
    chunk_docs: int = 8192
    weights: tuple[int, ...] = WEIGHTS
    most_passes: int = MOST_PASSES
    seed: int = 20240
    cells: int = 1024
    rounds: int = 12


def row_key() -> Column:
    """Names a row; rows that agree in it are alike for the mix."""
    return F.xxhash64("doc_id", "source", "text")


def word_sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text; 0 for null) and tie, which orders rows of equal doc_id."""
    return documents.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_key().alias("tie"),
    )


def source_targets(sizes: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """One row a source: src (its place in code-point order, from 1), source, source_size, target.

    Targets are shares of all words by weight; one that passes most_passes times its source's size stops there and the
    excess is shared again by weight. That fixed point is found in one pass: by ascending size per weight, the level
    that the rest would reach if all before were full decides whether a source is full.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # Windows without a partition: one row a source, never a row a document.
    everything = Window.partitionBy()
    place = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy("room", "src")
    weight = F.element_at(F.array(*map(F.lit, config.weights)), ((F.col("src") - 1) % len(config.weights) + 1).cast("int"))
    ranked = per_source.withColumn("src", F.row_number().over(place)).withColumn("weight", weight.cast("long"))
    ranked = ranked.withColumn("full", F.col("source_size") * config.most_passes).withColumn("room", F.col("full") / F.col("weight"))
    ranked = (
        ranked.withColumn("at", F.row_number().over(level))
        .withColumn("full_before", F.coalesce(F.sum("full").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("lambda", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
        .withColumn("is_full", F.col("full") <= F.col("lambda") * F.col("weight"))
    )
    reached = F.min(F.when(~F.col("is_full"), F.struct("at", "lambda"))).over(everything)["lambda"]
    return ranked.withColumn("reached", reached).select(
        F.col("src").cast("long").alias("src"),
        "source",
        "source_size",
        F.when(F.col("is_full"), F.col("full").cast("double")).otherwise(F.col("reached") * F.col("weight")).alias("target"),
        "n_docs",
    )


def permuted(index: Column, n: Column, *key: Column, rounds: int) -> Column:
    """A pseudorandom permutation of [0, n) for any n: each round swaps index with its mirror at a keyed pivot or leaves
    both, as a keyed bit of the larger of the two says."""

    def one(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(r, *key), n) - x, n)
        return F.when(F.xxhash64(F.greatest(x, mirror), r, *key).bitwiseAND(1) == 1, mirror).otherwise(x)

    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), index, one)


def plan_mix(documents: DataFrame, config: MixConfig = MixConfig()) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Documents in their streams, slots with the blocks that they take, the sources, and the number of sources."""
    sizes = materialise(word_sizes(documents), "mix-sizes")
    sources = materialise(source_targets(sizes, config), "mix-sources")
    block = config.block_words
    n_blocks = F.ceil(F.col("source_size") / block)
    sources = sources.withColumn("n_blocks", n_blocks).withColumn("want", F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0))
    counts = sources.agg(F.count(F.lit(1)).alias("sources"), F.sum("n_docs").alias("docs"), F.sum("want").alias("want")).first()
    n_sources, n_slots = counts["sources"], round(counts["want"] or 0)
    chunks = max(1, -(-(counts["docs"] or 0) // config.chunk_docs))

    placed = sizes.join(small(sources.select("src", F.col("source").alias("name")), n_sources), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "size", "tie", "src", F.pmod(F.xxhash64("doc_id", F.lit(config.seed)), F.lit(chunks)).alias("chunk")
    )
    within = Window.partitionBy("src", "chunk").orderBy("doc_id", "tie")
    starts = placed.groupBy("src", "chunk").agg(F.sum("size").alias("words"))
    starts = starts.select("src", "chunk", F.coalesce(F.sum("words").over(Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    docs = (
        placed.withColumn("row", F.row_number().over(within))
        .withColumn("before", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(starts, ["src", "chunk"])
        .select("doc_id", "size", "tie", "src", "chunk", "row", (F.col("start") + F.col("before")).alias("offset"))
    )
    docs = materialise(docs, "mix-docs")

    upto = Window.orderBy("src")  # one row a source
    bounds = sources.withColumn("share", F.col("want") / F.sum("want").over(Window.partitionBy())).withColumn("high", F.sum("share").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    bounds = bounds.filter("want > 0").withColumn("low", F.col("high") - F.col("share"))
    last = F.col("src") == F.max("src").over(Window.partitionBy())
    first = F.col("src") == F.min("src").over(Window.partitionBy())
    low, high = F.when(first, F.lit(-1.0)).otherwise(F.col("low")), F.when(last, F.lit(2.0)).otherwise(F.lead("low").over(upto))
    cell = lambda x: F.least(F.greatest(F.floor(x * config.cells), F.lit(0)), F.lit(config.cells - 1))
    bounds = bounds.select("src", "n_blocks", low.alias("low"), high.alias("high"))
    bounds = bounds.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))

    spark = documents.sparkSession
    slot, shard = F.col("id"), F.floor(F.col("id") / config.shard_slots)
    in_shard = F.least(F.lit(config.shard_slots), F.lit(n_slots) - F.col("shard") * config.shard_slots)
    jitter = F.pmod(F.xxhash64(F.lit(config.seed), slot), F.lit(1 << 40)) / float(1 << 40)
    drawn = spark.range(n_slots).withColumn("shard", shard).withColumn("u", (slot - F.col("shard") * config.shard_slots + jitter) / in_shard)
    drawn = drawn.withColumn("cell", cell(F.col("u"))).join(small(bounds, n_sources + config.cells), "cell").filter("low <= u and u < high")
    drawn = drawn.select(F.col("id").alias("slot"), "shard", "src", "n_blocks")
    shards = drawn.groupBy("src", "shard").agg(F.count(F.lit(1)).alias("n"))
    shards = shards.select("src", "shard", F.coalesce(F.sum("n").over(Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    nth = F.col("start") + F.row_number().over(Window.partitionBy("src", "shard").orderBy("slot")) - 1
    slots = drawn.join(shards, ["src", "shard"]).withColumn("nth", nth)
    slots = slots.withColumn("pass", F.floor(F.col("nth") / F.col("n_blocks"))).filter(F.col("pass") < config.most_passes)
    index = F.col("nth") - F.col("pass") * F.col("n_blocks")
    slots = slots.withColumn("block", permuted(index, F.col("n_blocks"), F.col("src"), F.col("pass"), F.lit(config.seed), rounds=config.rounds))
    return docs, slots.select("shard", "slot", "src", "block"), sources, n_sources


def mix(documents: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """doc_id, size, source_size, target, taken (what the mix takes of each document, in words with repeats) and row_key."""
    docs, slots, sources, n_sources = plan_mix(documents, config)
    block = F.lit(config.block_words)
    begin, end = F.col("offset"), F.col("offset") + F.col("size")
    pieces = docs.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(begin / block), F.floor((end - 1) / block))))
    pieces = pieces.select("src", "block", "chunk", "row", (F.least((F.col("block") + 1) * block, end) - F.greatest(F.col("block") * block, begin)).alias("overlap"))
    uses = slots.groupBy("src", "block").agg(F.count(F.lit(1)).alias("uses"))
    taken = pieces.join(uses, ["src", "block"]).groupBy("src", "chunk", "row").agg(F.sum(F.col("overlap") * F.col("uses")).alias("taken"))
    return (
        docs.join(taken, ["src", "chunk", "row"], "left")
        .join(small(sources.select("src", "source_size", "target"), n_sources), "src")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), F.col("tie").alias("row_key"))
    )
