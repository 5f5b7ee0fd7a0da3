"""The packer against a plain dot-product version, short documents, and instruction data whose loss binds."""

import random
import zlib

import numpy as np
import public_tokenizers

from aerolith.llm import packing

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def plain_pack(items, caps):
    """items: (tokens, loss). Bins of item numbers, by the dot product of demand and room in shares of the limits."""
    demand = [(t, 1, x) for t, x in items]
    weight = [sum(d[k] / caps[k] for d in demand) / len(demand) for k in range(3)]
    left, bins = list(range(len(items))), []
    while left:
        room, mine = list(caps), []
        while True:
            fits = [i for i in left if all(d <= r for d, r in zip(demand[i], room, strict=True))]
            if not fits:
                break
            at = max(fits, key=lambda i: (sum(w * (d / c) * (r / c) for w, d, r, c in zip(weight, demand[i], room, caps, strict=True)), -i))
            mine.append(at)
            left.remove(at)
            room = [r - d for r, d in zip(room, demand[at], strict=True)]
        bins.append(mine)
    return bins


def test_packer_equals_a_plain_dot_product():
    r = random.Random(7)
    for _ in range(20):
        items = [(t := r.randrange(1, 90), r.randrange(0, min(t, 60) + 1)) for _ in range(40)]
        packer = packing.Packer(packing.Limits(100, 5, 60), cut=False, group=10**6)
        for i, (t, x) in enumerate(items):
            packer.add(i, t, x)
        got = [[k for k, _, _ in b.pieces] for b in packer.finish()]
        want = plain_pack(items, (100.0, 5.0, 60.0))
        assert len(got) == len(want) and sorted(map(sorted, got)) == sorted(map(sorted, want))


def test_short_documents_leave_little_padding(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(5000)], "doc_id long, text string").coalesce(1)
    rows = packing.pack_documents(docs, TOKENIZER).collect()
    sequences = {}
    for r in rows:
        sequences[r.sequence_id] = sequences.get(r.sequence_id, 0) + r.length
    padded = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sequences.values())
    assert sum(sequences.values()) == sum(r.doc_tokens for r in rows if r.start == 0) and padded == 0


def test_conversations_keep_all_limits(spark):
    from tokenizers import Tokenizer

    tokenizer, r = Tokenizer.from_file(TOKENIZER), random.Random(1)
    rows = []
    for c in range(150):
        for t in range(r.randrange(1, 6)):
            rows.append((c, t, "assistant" if t % 2 else "user", " ".join(r.choice(["fish", "runs", "é", "quick", "13"]) for _ in range(r.randrange(0, 120)))))
    rows += [(500, 0, "user", "w " * 3000), (500, 1, "assistant", "v " * 5000), (501, 1, "assistant", None), (None, 1, "assistant", "x"), (502, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    text = {(c, t): x for c, t, _, x in rows}
    ids = lambda x: tokenizer.encode(x or "", add_special_tokens=False).ids
    pieces = packing.pack_conversations(df, TOKENIZER).collect()
    by, bins = {}, {}
    for p in pieces:
        by.setdefault((p.conv_id, p.turn), []).append(p)
        bins.setdefault(p.sequence_id, []).append(p)
    assert set(by) == {(c, t) for c, t, role, _ in rows if role == "assistant"}
    for (c, t), found in by.items():
        prompt, answer = ids(text.get((c, t - 1))), ids(text[c, t])
        whole, at, loss = np.array([*prompt, *answer, 1], "<u4"), 0, 0
        for p in sorted(found, key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(whole[at : at + p.length].tobytes()) and p.doc_tokens == len(whole)
            assert p.loss == len([k for k in range(at, at + p.length) if k >= len(prompt)])
            at, loss = at + p.length, loss + p.loss
        assert at == len(whole) and loss == len(answer) + 1
    for found in bins.values():
        assert sum(p.length for p in found) <= 2048 and sum(p.loss for p in found) <= 1024 and len(found) <= 64
    assert max(sum(p.loss for p in found) for found in bins.values()) == 1024
    assert packing.pack_conversations(df.limit(0), TOKENIZER).count() == 0
