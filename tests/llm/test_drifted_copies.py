"""Near-duplicates among drifted copies, and rows of one doc_id with unlike texts, against brute force."""

import itertools
import random

import numpy as np

from aerolith.llm import neardup


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(rows, percent):
    """rows: (doc_id, text). The smallest doc_id that each reaches."""
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows]
    for (a, s), (b, t) in itertools.combinations(sets, 2):
        common = len(s & t)
        if common and 100 * common >= percent * len(s | t):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: root(d) for d in parent}


def test_drifted_copies_share_edits(spark):
    r = random.Random(11)
    base = [f"v{r.randrange(300)}" for _ in range(120)]
    edits = {at: f"n{at}" for at in range(0, 120, 3)}
    rows = []
    for i in range(300):
        w = list(base)
        for at in sorted(r.sample(sorted(edits), r.choice([1, 2, 3, 4, 6, 8])), reverse=True):
            if r.random() < 0.5:
                del w[at]
            else:
                w[at] = edits[at]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, bands, width in ((85, 24, 5), (80, 27, 4)):
        got = {x.doc_id: x.component_id for x in neardup.near_duplicates(docs, neardup.NearDupConfig(percent, bands, width)).collect()}
        want = components(rows, percent)
        assert got == want and len(set(want.values())) > 5


def test_rows_of_one_doc_id_are_one_document(spark):
    r = random.Random(2)
    text = lambda: [f"q{r.randrange(10**6)}" for _ in range(60)]
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, b), (2, [*a, "x"]), (3, [*b, "y"]), (9, c), (8, a), (9, ["z", *b]), (7, c)]
    rows = [(d, " ".join(t)) for d, t in rows] + [(1, "")]
    got = {(x.doc_id, x.n_shingles): x.component_id for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: k for (d, n), k in got.items() if n} == {1: 1, 2: 1, 3: 1, 9: 1, 8: 1, 7: 1} == {d: k for d, k in components(rows[:-1], 85).items()}


def test_odd_sketch_bounds_the_difference_from_below():
    r = np.random.default_rng(4)
    x = r.integers(0, 2**63, 3000).astype(np.uint64)
    for n, m in ((100, 0), (100, 7), (400, 60), (2000, 900)):
        a, b = x[:n], x[m : n + m]
        cells = int(np.unpackbits((neardup.odd_sketch(a) ^ neardup.odd_sketch(b)).view(np.uint8)).sum())
        assert cells <= 2 * m and cells >= min(1.2 * m, 400)
