"""A training corpus out of the documents table: five stages, each over all that the one before it kept."""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import language, mixing, neardup, packing, secrets
from aerolith.llm.common import drop_scratch, materialise, small_batches, spread

#: A language that the model gives less than this is no decision.
LEAST_SCORE = 0.5

#: Near-duplicates of the pipeline: similarity 0.8 or more, where op1's contract says 0.85. A pair at 0.8 shares none of
#: 27 bands of 4 rows with a probability of 7e-7; of op1's 24 bands of 5 it would share none with 7e-5.
NEAR = neardup.NearDupConfig(similarity_percent=80, bands=27, rows=4)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those whose language can't be told."""
    model = language.fit(docs.select("doc_id", "text", "lang").filter("text is not null and lang is not null"))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    told = language.predict(spread(docs), model)
    told = told.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE)).select(*docs.columns)
    with small_batches(spark):
        return materialise(told, "pipeline-language")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, config: neardup.NearDupConfig = neardup.NearDupConfig()) -> DataFrame:
    """Of each component of near-duplicates one row stays, that with the smallest doc_id (the smallest key of its columns,
    where several rows have it). Rows with no doc_id or without words belong to no component and stay. What goes is named by doc_id
    and a key of all columns, so a row that shares a doc_id with a copy but not its text is judged for itself."""
    key, names = "_near_key", docs.columns
    keyed = docs.withColumn(key, F.xxhash64(*[F.col(f"`{c}`") for c in names]))
    with small_batches(spark):
        judged = materialise(neardup.near_duplicates(keyed, config, (key,)).filter("n_shingles > 0 and doc_id is not null").select("doc_id", key, "component_id"), "pipeline-neardup")
    stays = judged.groupBy("component_id").agg(F.min(F.struct("doc_id", key)).alias("x"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("component_id", "x")
    told = materialise(judged.join(stays, "component_id").groupBy("doc_id", key).agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("n")), "pipeline-groups")
    gone = told.filter((F.col("x.doc_id") != F.col("doc_id")) | (F.col(f"x.{key}") != F.col(key))).select("doc_id", key)
    again = told.filter((F.col("x.doc_id") == F.col("doc_id")) & (F.col(f"x.{key}") == F.col(key)) & (F.col("n") > 1)).select("doc_id", key)
    n = gone.count()
    rest = keyed.join(F.broadcast(gone) if n <= neardup.ID_ROWS else gone, ["doc_id", key], "left_anti")
    if again.isEmpty():
        return rest.select(*names)
    once = rest.join(again, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key])
    return rest.join(again, ["doc_id", key], "left_anti").unionByName(once).select(*names)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    with small_batches(spark):
        return materialise(secrets.redact(docs), "pipeline-secrets")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; the part of a document is rounded up or down by a draw of its own. Rows are
    told apart by the mix's key of doc_id, source and text; rows that agree in it share their copies."""
    key, names = "_mix_key", docs.columns
    drawn = F.pmod(F.xxhash64("doc_id", "row_key", F.lit(mixing.MixConfig().seed + 1)), F.lit(1 << 30)) / float(1 << 30)
    taken = mixing.mix(docs).filter("size > 0").withColumn("copies", F.floor(F.col("taken") / F.col("size") + drawn).cast("int"))
    copies = taken.groupBy(F.col("row_key").alias(key)).agg(F.sum("copies").alias("_mix_copies"), F.count(F.lit(1)).alias("_mix_rows")).filter("_mix_copies > 0")
    copies = materialise(copies, "pipeline-copies")
    copies = F.broadcast(copies) if copies.count() <= neardup.ID_ROWS else copies
    mixed = docs.withColumn(key, mixing.row_key()).join(copies, key)
    several = mixed.filter("_mix_rows > 1")
    mixed = mixed.filter("_mix_rows = 1").unionByName(several.dropDuplicates([key]))
    return mixed.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))).select(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", partial(drop_near_duplicates, config=NEAR)),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The mix's draws and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


#: What the stages' operators call their scratch tables.
SCRATCH = ("neardup-", "edges-", "language-", "mix-", "pipeline-")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scratch tables of a stage go as soon as its result is written; the last stage's input stays, being read later."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for (name, stage), before in zip(STAGES[:-1], [None, *(name for name, _ in STAGES)], strict=False):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_scratch(spark, *SCRATCH, *([f"stage-{before}-"] if before else []))
    return STAGES[-1][1](spark, docs, sf_dir)
