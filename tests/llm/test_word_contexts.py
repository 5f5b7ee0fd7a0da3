"""Scores depend on the order of words, and not on whether a context is dealt out."""

import math
import random

from pyspark.sql import functions as F

from aerolith.llm import scoring
from aerolith.llm.pitman_yor import HpyConfig


def test_order_of_words_counts(spark, monkeypatch):
    r = random.Random(4)
    follow = {f"w{i}": [f"w{r.randrange(60)}" for _ in range(3)] for i in range(60)}
    texts = []
    for _ in range(300):
        w = ["w1"]
        for _ in range(40):
            w.append(r.choice(follow[w[-1]]))
        texts.append(w)
    turned = [r.sample(w, len(w)) for w in texts[:30]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts + turned)] + [(900, "never seen"), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = (F.col("doc_id") < 30) | (F.col("doc_id") >= 300)
    got = {x.doc_id: x for x in scoring.score(docs, held).collect()}
    assert len(got) == 332 and all(math.isfinite(x.score) and x.score < 0 for x in got.values())
    for i in range(30):
        assert math.isclose(got[i].base_score, got[300 + i].base_score) and got[i].score > got[300 + i].score + 10
    monkeypatch.setattr(scoring, "BUCKET_BYTES", 4096)
    dealt = {x.doc_id: x.score for x in scoring.score(docs, held, HpyConfig(hot=50)).collect()}
    assert abs(sum(dealt[i] for i in range(30, 300)) / sum(got[i].score for i in range(30, 300)) - 1) < 0.01
    assert all(dealt[i] > dealt[300 + i] + 10 for i in range(30))
