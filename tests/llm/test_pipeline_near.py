"""The pipeline's near-duplicate stage against brute force at its own similarity, 0.8."""

import itertools
import random

import corpus_pipeline as cp


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_copies_between_80_and_85_percent_go(spark):
    r, texts = random.Random(3), []
    for k in range(40):
        base = [f"v{r.randrange(5000)}" for _ in range(100)]
        copy = list(base)
        for at in ((20, 70), (20, 50, 80))[k % 4 == 3]:  # two edits: 86 of 106 shingles; three: 81 of 111
            copy[at] = f"edit{k}x{at}"
        texts += [" ".join(base), " ".join(copy)]
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    between = 0
    for a, b in itertools.combinations(range(len(texts)), 2):
        common, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if 100 * common >= 80 * union:
            between += 100 * common < 85 * union
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert between == 30
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {x.doc_id for x in dict(cp.STAGES)["near_duplicates"](spark, docs, "").collect()} == {i for i in range(len(texts)) if root(i) == i}
