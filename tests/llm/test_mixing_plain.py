"""What the mix takes of each document, against a plain version that walks the slots one by one."""

import math
import random

import xxhash

from aerolith.llm import mixing

CONFIG = mixing.MixConfig(block_words=8, shard_slots=64, chunk_docs=16)


def hashed(*values):
    """Spark's xxhash64 of whole numbers, as (value, bytes)."""
    h = 42
    for value, size in values:
        h = xxhash.xxh64_intdigest(value.to_bytes(size, "little", signed=True), seed=h % 2**64)
    return h - 2**64 if h >= 2**63 else h


def permuted(x, n, *key):
    for r in range(CONFIG.rounds):
        mirror = (hashed((r, 4), *key) % n - x) % n
        x = mirror if hashed((max(x, mirror), 8), (r, 4), *key) & 1 else x
    return x


def plain_taken(rows, targets):
    """rows: (doc_id, source, size). targets: of each source in order."""
    sources, seed = list(targets), (CONFIG.seed, 4)
    chunks = max(1, -(-len(rows) // CONFIG.chunk_docs))
    sizes = {s: sum(n for _, x, n in rows if x == s) for s in sources}
    blocks = {s: -(-sizes[s] // CONFIG.block_words) for s in sources}
    want = {s: targets[s] * blocks[s] / sizes[s] if sizes[s] else 0.0 for s in sources}
    n_slots = round(sum(want.values()))
    edges, at = [], 0.0
    for s in sources:
        if want[s] > 0:
            edges.append((at, s))
            at += want[s] / sum(want.values())
    nth, uses = dict.fromkeys(sources, 0), {}
    for slot in range(n_slots):
        shard = slot // CONFIG.shard_slots
        width = min(CONFIG.shard_slots, n_slots - shard * CONFIG.shard_slots)
        u = (slot - shard * CONFIG.shard_slots + hashed(seed, (slot, 8)) % (1 << 40) / float(1 << 40)) / width
        s = [x for low, x in edges if low <= u][-1]
        turn, index = divmod(nth[s], blocks[s])
        nth[s] += 1
        if turn < 3:
            block = permuted(index, blocks[s], (sources.index(s) + 1, 8), (turn, 8), seed)
            uses[s, block] = uses.get((s, block), 0) + 1
    out = {}
    for s in sources:
        offset = 0
        for doc, _, n in sorted((r for r in rows if r[1] == s), key=lambda r: (hashed((r[0], 8), seed) % chunks, r[0])):
            out[doc] = sum(uses.get((s, k // CONFIG.block_words), 0) for k in range(offset, offset + n))
            offset += n
    return out


def test_taken_equals_a_plain_version(spark):
    r = random.Random(5)
    rows = [(i, r.choice(["a", "a", "a", "a", "b", "c", None]), r.choice([0, 1, 5, 30, 200])) for i in range(120)]
    docs = spark.createDataFrame([(i, s, " ".join(["w"] * n)) for i, s, n in rows], "doc_id long, source string, text string")
    got = mixing.mix(docs, CONFIG).collect()
    size = {s: sum(n for _, x, n in rows if x == s) for s in ("a", "b", "c", None)}
    target = {s: next(x.target for x in got if rows[x.doc_id][1] == s) for s in size}
    assert {x.doc_id: x.taken for x in got} == plain_taken(rows, target)
    for s in size:
        took = sum(x.taken for x in got if rows[x.doc_id][1] == s)
        assert math.isclose(took, target[s], rel_tol=0.1, abs_tol=40)
