"""The exact search in many groups, and that no side of it goes through the driver."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import topk

SMALL = topk.TopKConfig(shard_rows=16, block_rows=4, fan_in=2, piece_cells=64, group_bytes=400, least_bytes=200)


def vectors(kind):
    r = random.Random(kind)
    if kind == "ties":
        return [[r.choice([0.0, 0.5]) for _ in range(6)] for _ in range(900)]
    if kind == "ascending":  # each shard beats all before it
        return [[i / 4, 1.0] for i in range(900)]
    if kind == "wide":  # sums beyond 2**24, 2**53 and 2**63
        return [[r.choice([1.0, 3e4, 7e9, -3e16]) * r.random() for _ in range(3)] for _ in range(900)]
    return [[r.gauss(0, 0.2) for _ in range(r.choice([2, 5, 40, 90]))] for _ in range(900)]


@pytest.mark.parametrize("kind", ["ties", "ascending", "wide", "lengths"])
@pytest.mark.parametrize("config", [topk.TopKConfig(), SMALL], ids=["one", "many"])
def test_equals_brute_force(spark, kind, config):
    rows = list(enumerate(vectors(kind)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    good, want = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows], []
    for i, q in good:
        if i % 50 == 0:
            scored = sorted((-max(topk.LOWEST + 1, min(2**63 - 1, sum(a * b for a, b in zip(q, c, strict=True)))), j) for j, c in good if j != i and len(c) == len(q))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:5])]
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, config).collect())) == want


def test_no_vectors_are_broadcast(spark):
    """A broadcast of queries, once for each shard of candidates, took the driver's memory at 720,000 vectors."""
    df = spark.createDataFrame(list(enumerate(vectors("lengths"))), "vec_id long, embedding array<double>")
    plan, found = topk.top_k(df, F.col("vec_id") % 50 == 0, topk.TopKConfig(shard_rows=16))._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().startswith("BroadcastExchange"):
            found.append(node.output().mkString(","))
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plan)
    assert found and not [x for x in found if "matrix" in x]
