"""Stages that send whole texts to Python workers do it in small batches, and leave the session as it was."""

import pyarrow as pa
import pytest

import corpus_pipeline as cp
from aerolith.llm.common import BATCHES, materialise, small_batches

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_batches_are_small_inside_only(spark):
    df = spark.range(4000, numPartitions=1)

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    sizes = df.mapInArrow(rows, "n long")
    with small_batches(spark):
        assert max(r.n for r in sizes.collect()) == int(BATCHES["spark.sql.execution.arrow.maxRecordsPerBatch"])
    assert [r.n for r in sizes.select("n").collect()] == [4000]


@pytest.mark.parametrize("stage", ["language", "secrets"])
def test_stages_run_in_small_batches(spark, monkeypatch, stage):
    docs = spark.createDataFrame([(i, f"the cat of {i} and that password = abcdef{i:06d}", "en", "s", 50) for i in range(20)], DOCS)
    before, seen = {k: spark.conf.get(k, None) for k in BATCHES}, []

    def watched(df, label):
        seen.append({k: spark.conf.get(k, None) for k in BATCHES})
        return materialise(df, label)

    monkeypatch.setattr(cp, "materialise", watched)
    assert dict(cp.STAGES)[stage](spark, docs, "").count() == 20
    assert seen == [BATCHES] and {k: spark.conf.get(k, None) for k in BATCHES} == before
