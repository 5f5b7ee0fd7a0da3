"""The pipeline's stages in turn, each against what its operator says of its own input."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from aerolith.llm import language, mixing, neardup, secrets
from aerolith.llm.common import materialise

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, n = docs, docs.count()
    blank = [(10**6, "12 34", "en", "src0", 5), (10**6 + 1, None, None, None, None)]
    kept = [(10**6 + 2, "the password = abcdef12345 is of the and that", "en", "src0", 45)]
    docs, n = docs.unionByName(spark.createDataFrame(blank + kept, docs.schema)), n + 1
    names = [name for name, _ in cp.STAGES]
    assert names == ["language", "near_duplicates", "secrets", "mixing", "packing"]

    told = materialise(cp.identify_language(spark, docs, SF), "test")
    assert told.columns == first.columns and told.count() == n and told.filter("doc_id >= 1000000").count() == 1

    unique = materialise(cp.drop_near_duplicates(spark, told, SF), "test")
    judged = neardup.near_duplicates(told)
    assert {r.doc_id for r in unique.select("doc_id").collect()} == {r.doc_id for r in judged.filter("kept").collect()} and unique.columns == first.columns
    assert neardup.near_duplicates(unique).filter("not kept").count() == 0
    twice = cp.drop_near_duplicates(spark, unique.unionByName(unique.limit(3)), SF)
    assert twice.count() == unique.count()

    clean = materialise(cp.redact_secrets(spark, unique, SF), "test")
    assert clean.count() == unique.count() and secrets.find_secrets(unique).agg(F.sum("n_spans")).first()[0] > 0
    assert secrets.find_secrets(clean).agg(F.sum("n_spans")).first()[0] == 0

    mixed = materialise(cp.mix_sources(spark, clean, SF), "test")
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for r in mixing.mix(clean).collect():
        assert r.size == 0 or int(r.taken / r.size) <= copies.get(r.doc_id, 0) <= int(r.taken / r.size) + 1
    assert mixed.columns == first.columns and max(copies.values()) <= 3

    pieces = cp.pack(spark, mixed, SF)
    starts = pieces.filter("start = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in starts} == copies


def test_run_and_unlabelled_input(spark, tmp_path):
    assert cp.run(spark, SF).count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5).withColumn("lang", F.lit(None).cast("string"))
    assert cp.identify_language(spark, docs, SF).count() == 5 and language.fit(docs.filter("lang is not null")).languages == []
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, f"file://{tmp_path}").count() == 0
