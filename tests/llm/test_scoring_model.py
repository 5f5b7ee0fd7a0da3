"""The language model: a distribution over texts, better than unigrams on both parts, the same however rows lie, and its
sampler against a plain one that seats customers one after the other."""

import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from aerolith.llm import language, scoring
from aerolith.llm.pitman_yor import CROWD, HpyConfig, gibbs

SF = "/root/testdata/sf0.001"


def test_probabilities_of_all_texts_sum_to_one(spark):
    train = [["a"], ["b"], ["a", "b"], ["a"], [], ["b"]] * 8
    asked = [list(x) for n in range(6) for x in itertools.product(("a", "b", "unseen"), repeat=n)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(train + asked)], "doc_id long, text string")
    got = scoring.score(docs, F.col("doc_id") >= len(train)).filter(F.col("doc_id") >= len(train)).collect()
    total = sum(10**r.event_score for r in got)
    assert len(got) == len(asked) and 0.97 < total < 1 + 1e-6
    assert all(r.score <= r.event_score + 1e-9 for r in got)


def test_unseen_words_are_scored_by_their_spelling(spark):
    sf = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6, "theration"), (10**6 + 1, "xqzjkvbwp"), (10**6 + 2, "theration theration")], "doc_id long, text string")
    got = {r.doc_id: r for r in scoring.score(sf.unionByName(odd), F.col("doc_id") >= 10**6).filter("doc_id >= 1000000").collect()}
    assert got[10**6].score > got[10**6 + 1].score + 1 and got[10**6].event_score == got[10**6 + 1].event_score


def test_perplexity_and_layout(spark, monkeypatch):
    sf = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    held = language.held_out(F.col("doc_id"), 10)
    one = scoring.score(sf.repartition(1), held).cache()
    for r in scoring.perplexity(one).collect():
        assert r.perplexity < r.base_perplexity
    monkeypatch.setattr(scoring, "HOME_BYTES", 100_000)
    many = {r.doc_id: r for r in scoring.score(sf.repartition(5), held).collect()}
    assert all(many[r.doc_id].score == r.score and many[r.doc_id].base_score == r.base_score for r in one.collect())


def plain_gibbs(n, p, discount, strength, sweeps, burn_in, r):
    """Mean tables of dishes of one restaurant, customer by customer."""
    tables = [[] for _ in n]

    def seat(i):
        weights = [max(0.0, x - discount) for x in tables[i]] + [(strength + discount * sum(map(len, tables))) * p[i]]
        at = r.choices(range(len(weights)), weights)[0]
        if at == len(tables[i]):
            tables[i].append(0)
        tables[i][at] += 1

    for i, c in enumerate(n):
        for _ in range(c):
            seat(i)
    total = np.zeros(len(n))
    for sweep in range(sweeps):
        for i, c in enumerate(n):
            for _ in range(c):
                at = r.choices(range(len(tables[i])), tables[i])[0]
                tables[i][at] -= 1
                if not tables[i][at]:
                    del tables[i][at]
                seat(i)
        if sweep >= burn_in:
            total += [len(x) for x in tables]
    return total / (sweeps - burn_in)


def test_sampler_equals_a_plain_one():
    n, p = [1, 2, 3, 7, 20, 60, 0], [0.05, 0.2, 0.01, 0.1, 0.3, 0.02, 0.1]
    want = np.mean([plain_gibbs(n, p, 0.6, 2.0, 60, 20, random.Random(k)) for k in range(12)], 0)
    config = HpyConfig(sweeps=60, burn_in=20)
    got = np.mean([gibbs(np.array(n), np.zeros(7, np.int64), np.ones(1), np.array(p), 0.6, 2.0, np.random.default_rng(k), config) for k in range(30)], 0) / 40
    assert np.all(np.abs(got - want) <= 0.12 * want + 0.12), (got, want)


def test_crowded_dishes_and_restaurants_side_by_side():
    n, group = np.array([CROWD * 30, 5, 2, CROWD + 1, 1]), np.array([0, 0, 1, 1, 1])
    tables = gibbs(n, group, np.ones(2), np.full(5, 0.1), 0.5, 1.0, np.random.default_rng(1), HpyConfig()) / 4
    assert (tables >= 1).all() and (tables <= n).all() and tables[0] > 1 and tables[3] > 1 and math.isclose(tables[4], 1)
