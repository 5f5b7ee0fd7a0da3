"""Each operator against a plain version of itself, on small tables with the odd cases in them."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import automaton, fixity, language, mixing, neardup, packing, pitman_yor, quality, repeats, scoring, secrets, suffixes, topk

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, home long, bucket string, size int, n_words string, target double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def documents(spark, texts, sources=None, ids=None):
    """Rows with columns whose names the operators use themselves."""
    rows = [(i if ids is None else ids[i], t, "en" if i % 2 else None, sources[i] if sources else f"s{i % 3}", 0, 7, "x", 1, None, 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(seed=5):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [r.choice(vocabulary) for _ in range(100)]
    texts = []
    for _ in range(60):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 5])):
            w[r.randrange(100)] = f"x{r.randrange(10**6)}"
        texts.append(" ".join(w[: r.choice([100, 100, 100, 85, 92])]))
    chain = [r.choice(vocabulary) for _ in range(90)]
    for i in range(15):
        chain = list(chain)
        chain[r.randrange(90)] = f"y{i}"
        texts.append(" ".join(chain))
    texts += [" ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 50))) for _ in range(40)]
    texts += texts[:10] + ["", None, "a b", "A  B", "é\n" * 80, "one two three four five", " " * 30, "z" * 5000, "long " * 4000]
    r.shuffle(texts)
    return texts


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return documents(spark, texts).cache()


def shingle_sets(texts):
    out = []
    for t in texts:
        w = words(t)
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def test_near_duplicates(docs, texts):
    sets, parent = shingle_sets(texts), list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 85 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in range(len(texts))}


def test_near_duplicates_of_odd_rows(spark):
    rows = documents(spark, ["a b c d e f"] * 3 + [None, "q"], ids=[4, 4, None, 5, 5])
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(rows).collect()), key=repr)
    assert got == sorted([(4, 4, True), (4, 4, True), (None, None, True), (5, 5, True), (5, 5, True)], key=repr)
    assert neardup.near_duplicates(rows.limit(0)).count() == 0


def test_sketch_fills_and_estimates():
    r = np.random.default_rng(1)
    x = r.integers(0, 2**63, 1000).astype(np.uint64)
    for n in (1, 2, 5, 50, 1000):
        assert (neardup.sketch(x[:n], 120) < np.iinfo(np.uint64).max).all()
    a, b = neardup.sketch(x[:900], 480), neardup.sketch(x[100:], 480)
    assert abs((a == b).mean() - 0.8) < 0.1


def test_language(spark):
    sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("h", language.held_out(F.col("doc_id"), 5))
    model = language.fit(sf.filter("not h and lang is not null and text is not null"))
    got = language.predict(sf.filter("h").withColumn("lang_pred", F.lit("x")), model).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("lang_score").alias("s"), F.max("lang_score").alias("t")).first()
    assert got.a >= 0.95 and 0 <= got.s and got.t <= 1
    odd = language.predict(documents(spark, [None, "", "12 34 !? ²", "日本語"]), model).select("lang_pred", "lang_score").collect()
    assert [r.lang_pred for r in odd[:3]] == ["und"] * 3 and odd[3].lang_pred in model.languages
    none = language.fit(sf.limit(0))
    assert none.languages == [] and language.predict(sf.limit(3), none).filter("lang_pred <> 'und'").count() == 0


def test_language_prefers_words_then_long_grams():
    config = language.LanguageConfig(longest=3)
    model = language.Model(["a", "b"], [0.5, 0.5], {0: {"the": (-1.0, -7.0)}, 3: {"xyz": (-7.0, -2.0)}, 1: {"q": (-3.0, -4.0)}}, config)
    assert model.word("the") == (-1.0, -7.0) and model.word("axyz") == (-7.0, -2.0) and model.word("qq") == (-3.0, -4.0) and model.word("zzz") is None


PATTERNS = [re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")]
KEEPS = [lambda m: len(m[1]) >= 6, lambda m: len(m[0]) >= 20, lambda m: len(m[0]) >= 24]


def plain_secrets(text):
    return sorted(((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text or "") if KEEPS[k](m)))


def test_secrets(spark):
    r = random.Random(1)
    bits = ["token", "Secret", "api_key", "apikey", "password", "PASSWD", " ", "=", ":", "'", '"', "  ", "AKIA", "ABCDEFGH123456789", "0123456789abcdef", "deadbeef", "é", "\n", "abc", "x", "==", ": token : abcdefgh", "-", "日本", "ghp_" + "a" * 36]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(0, 40))) for _ in range(1500)] + [None, "", "deadbeef" * 2000, ("x" * 3000 + "token=abcdef1 ") * 5]
    names = ("assign", "access", "hex")
    for row in secrets.find_secrets(documents(spark, texts)).collect():
        want = plain_secrets(texts[row.doc_id])
        said = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert row.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [x for x in row.spans.split(",") if x.split(":")[0] in names] == said.split(",") or (not said and not [x for x in row.spans.split(",") if x.split(":")[0] in names])
    assert secrets.find_secrets(documents(spark, ["a"]).limit(0)).count() == 0


def test_redaction(spark):
    rows = documents(spark, ["é password = abcdef1 end", "clean", None])
    got = [(r.text, r.n_chars) for r in secrets.redact(rows).collect()]
    assert got == [("é [SECRET] end", 14), ("clean", 0), (None, 0)]


@pytest.mark.parametrize("pattern", [r"a(b|c)*d", r"x{2,4}y?", r"(?i:ab)+c", r"[^a-c]z", r"a{3,}", r"(a|ab)(c|bcd)"])
def test_automaton(pattern):
    dfa, r = automaton.compile_rules([pattern], False), random.Random(2)
    for _ in range(300):
        s = "".join(r.choice("abcdxyzAB") for _ in range(r.randrange(12)))
        got = [(a, b) for a, b, _ in automaton.longest_matches(dfa, s.encode())]
        longest, i = [], 0
        while i < len(s):
            ends = [j for j in range(len(s), i, -1) if re.fullmatch(pattern, s[i:j])]
            longest += [(i, ends[0])] if ends else []
            i = ends[0] if ends else i + 1
        assert got == longest


def plain_targets(sizes, weights=(5, 2, 1)):
    """The reshare as it is told: give by weight, stop at three times, share the excess again."""
    w = {s: weights[i % 3] for i, s in enumerate(sizes)}
    target, full, left = dict.fromkeys(sizes, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-9 and len(full) < len(sizes):
        total = sum(w[s] for s in sizes if s not in full)
        share, left = left, 0.0
        for s in sizes:
            if s not in full:
                target[s] += share * w[s] / total
        for s in sizes:
            if s not in full and target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                full.add(s)
    return target


def test_mixing(spark):
    r = random.Random(3)
    sources = ["b", "a", None, "é", "z"]
    texts = [" ".join(["w"] * r.choice([0, 3, 40, 200])) for _ in range(400)] + [None, "", "t u v", "w " * 3000]
    of = [r.choice(["b"] * 12 + sources) for _ in texts]
    texts += texts[:5]
    of += of[:5]
    rows = documents(spark, texts, of, ids=[*range(len(texts) - 5), *range(5)])
    got = mixing.mix(rows).collect()
    assert sorted((x.doc_id, x.size) for x in got) == sorted(((i if i < len(texts) - 5 else i - (len(texts) - 5)), len(WORD.findall(t or ""))) for i, t in enumerate(texts))
    sizes = Counter()
    for t, s in zip(texts, of, strict=True):
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = plain_targets({s: sizes[s] for s in order})
    taken, target = Counter(), {}
    for x in got:
        assert 0 <= x.taken <= 3 * x.size
        taken[x.source_size] += x.taken
        target[x.source_size] = x.target
    assert {sizes[s]: round(want[s], 6) for s in order} == {k: round(v, 6) for k, v in target.items()}
    assert all(abs(taken[k] - target[k]) <= 0.02 * target[k] + 200 for k in target)
    again = mixing.mix(rows.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    assert mixing.mix(rows.limit(0)).count() == 0


def test_index_permutation(spark):
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(4), rounds=12).alias("p"))
        assert sorted(r.p for r in got.collect()) == list(range(n))


def pages(spark, n=300):
    return spark.createDataFrame([(i, f"http://h/{i}" if i % 9 else None, f"<p>é {i}</p>" if i % 7 else None) for i in range(n)] + [(3, "http://h/3", "<p>é 3</p>"), (None, None, "x")], "page_id long, url string, html string")


def test_warc_round_trip(spark):
    record = fixity.record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = pages(spark).select("page_id", "html", record.alias("r")).collect()
    archive = b"".join(r.r.encode() for r in rows)
    got = list(fixity.parse(archive))
    assert [p.decode() for _, p, _, _ in got] == [r.html or "" for r in rows]
    assert got[-1][2] + got[-1][3] == len(archive)
    for bad in (archive[:-3], b"junk" + archive):
        with pytest.raises(ValueError):
            list(fixity.parse(bad))


def test_read_warc(spark, tmp_path):
    record = fixity.record(F.col("page_id"), F.col("url"), F.col("html"))
    (tmp_path / "a.warc").write_bytes(b"".join(r.r.encode() for r in pages(spark, 20).select(record.alias("r")).collect()))
    got = fixity.read_warc(spark, f"file://{tmp_path}").collect()
    assert len(got) == 22 and got[0].offset == 0 and got[1].offset == got[0].length


def test_audit_finds_what_differs(spark):
    config = fixity.FixityConfig(archive_records=40, fan_out=3)
    laid = fixity.lay_out(pages(spark), config).cache()
    tree = fixity.build_tree(laid, config)
    assert fixity.audit(tree, fixity.build_tree(laid, config), config).count() == 0
    rot = F.col("page_id").isin(11, 200)
    changed = laid.withColumn("digest", F.when(rot, F.col("rotten")).otherwise(F.col("digest")))
    found = fixity.audit(tree, fixity.build_tree(changed, config), config)
    assert {(r.archive, r.place) for r in found.collect()} == {(r.archive, r.place) for r in laid.filter(rot).collect()}
    last = laid.groupBy("archive").agg(F.max("place").alias("place")).orderBy("archive").limit(1)
    cut = laid.join(last, ["archive", "place"], "left_anti")
    assert [r.status for r in fixity.audit(tree, fixity.build_tree(cut, config), config).collect()] == ["missing"]
    assert fixity.audit_pages(pages(spark).limit(0)).count() == 0


def test_packing(docs, texts, spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]
    rows = packing.pack_documents(docs, TOKENIZER).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for d, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[d]) and p.ids_crc32 == zlib.crc32(ids[d][at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids[d])
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or at & (at - 1) == 0
    assert packing.pack_documents(docs.limit(0), TOKENIZER).count() == 0


def test_packer_keeps_all_limits():
    r, limits = random.Random(4), packing.Limits(tokens=100, segments=6, loss=60)
    packer, bins, given = packing.Packer(limits, cut=False, group=64), [], []
    for i in range(500):
        tokens = r.randrange(1, 101)
        given.append((i, tokens, min(60, r.randrange(0, tokens + 1))))
        bins += packer.add(*given[-1])
    bins += packer.finish()
    assert sorted(k for b in bins for k, _, _ in b.pieces) == list(range(500))
    assert all(b.tokens <= 100 and b.segments <= 6 and b.loss <= 60 for b in bins)
    assert len(bins) <= 1.15 * max(sum(t for _, t, _ in given) / 100, sum(x for _, _, x in given) / 60)
    with pytest.raises(ValueError):
        packer.add(1, 101)


def test_encoder_equals_the_tokenizer():
    r, encoder = random.Random(3), packing.Encoder(TOKENIZER)
    bits = ["a", "é", "Ü", " ", "  ", "\n", "'s", "'ll", "123", "²", "日本", "<|endoftext|>", "\t", "\xa0", "\x1c", "!?", "’", "ß", "🎉", "|", "\r\n", "_", " \n", "\x85", "ʼn"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(3000)]
    want = [np.array(x.ids, "<u4").tobytes() for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want and encoder.encode(texts) == want


def plain_quality(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, texts, spark):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = quality.judge(docs).collect()
    assert {r.doc_id: tuple(r[n] for n in names) for r in rows} == {i: plain_quality(t) for i, t in enumerate(texts)}
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in rows)
    r = random.Random(9)
    odd = ["".join(r.choice("a b\n#|é\t\x0b") for _ in range(r.randrange(80))) for _ in range(200)]
    assert {x.doc_id: tuple(x[n] for n in names) for x in quality.judge(documents(spark, odd)).collect()} == {i: plain_quality(t) for i, t in enumerate(odd)}
    assert quality.judge(docs.limit(0)).count() == 0


def test_cascade_order_does_not_change_the_verdict(spark):
    rows = documents(spark, ["fine words stand here in a row and go on", "###### |||| $$$$", "A B C D SHOUT LOUD!! !! !!", "x\nx\nx\nx", None])
    one = quality.estimate(rows)
    verdict = lambda order: [r.f is None for r in rows.select(quality.cascade(order, quality.measures(F.col("text"))).alias("f")).collect()]
    assert verdict(one) == verdict(one[::-1]) == [r.failed_rule is None for r in quality.apply_rules(rows).collect()]
    assert verdict(one)[:2] == [True, False]


def plain_repeats(texts, length=50):
    seen, out = set(), []
    for t in texts:
        b, mine = (t or "").encode(), set()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            g = b[p : p + length]
            mine.add(g)
            if g in seen:
                gone[p : p + length] = b"\1" * length
        seen |= mine
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, y in zip(b, gone, strict=True) if not y)).hexdigest()))
    return out


@pytest.mark.parametrize("home", [1 << 20, 3000])
def test_repeats(spark, docs, texts, home):
    config = repeats.RepeatConfig(home_bytes=home, minimizer_bucket_bytes=20_000, context_bucket_bytes=15_000, sorted_bytes=2000)
    got = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(docs, config).collect()}
    assert got == dict(enumerate(plain_repeats(texts)))


def test_repeats_of_odd_rows(spark):
    rows = documents(spark, ["q" * 60] * 4 + [None], ids=[2, 2, None, 3, 4])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in repeats.remove_repeats(rows).collect())
    assert got == [(False, 2, 0), (False, 2, 0), (False, 3, 60), (False, 4, 0), (True, 0, 0)]
    assert repeats.remove_repeats(rows.limit(0)).count() == 0


def test_suffix_order():
    r = random.Random(8)
    for alphabet in (b"ab", b"abcdefgh"):
        data = bytes(r.choice(alphabet) for _ in range(3000)) + b"ab" * 300
        data += data[500:1500]
        text, depth = np.frombuffer(data, np.uint8), 50
        positions = np.arange(len(data) - depth + 1)
        order = suffixes.SuffixOrder(text, depth, block=256)
        got = order.order(positions)
        windows = [data[p : p + depth] for p in got.tolist()]
        assert sorted(got.tolist()) == positions.tolist() and windows == sorted(windows)
        assert order.equal_to_next(got).tolist() == [a == b for a, b in itertools.pairwise(windows)]
    for v in (3, 8, 16):
        cover = suffixes.difference_cover(v)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_top_k(spark):
    r = random.Random(6)
    rows = [(i, [r.choice([0.0, 0.25, -0.5, r.random()]) for _ in range(4)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (303, [float("inf")] * 4), (None, [1.0] * 4), (350, [1e15, -1e15, 3.0, 1.0]), (304, [1e15, 1e15, 1.0, 1.0]), (400, []), (401, []), (450, [1.0]), (500, [0.1, 0.2, 0.3, 0.4]), (500, [0.1, 0.2, 0.3, 0.4])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, q in good:
        if i % 50 == 0:
            scored = sorted((-max(-(2**63) + 2, min(2**63 - 1, sum(a * b for a, b in zip(q, c, strict=True)))), j) for j, c in good if j != i and len(c) == len(q))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:5])]
    for config in (topk.TopKConfig(), topk.TopKConfig(shard_rows=20, block_rows=3, fan_in=2)):
        assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, config).collect())) == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_scoring(spark, docs, texts):
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    tokens = [[*words(t), ""] for t in texts]
    counts = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, types = sum(counts.values()), len(counts)
    rows = scoring.score(docs, language.held_out(F.col("doc_id"), 10)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(counts[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (types + 1))) for w in t), rel_tol=1e-9) and r.score < 0
    again = {r.doc_id: r.score for r in scoring.score(docs.repartition(1), language.held_out(F.col("doc_id"), 10)).collect()}
    assert all(math.isclose(r.score, again[r.doc_id], rel_tol=0.02) for r in rows)
    assert scoring.score(docs.limit(0), F.lit(False)).count() == 0


def test_scoring_beats_unigrams_on_unseen_texts(spark):
    sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    p = {r.held_out: r for r in scoring.perplexity(scoring.score(sf, language.held_out(F.col("doc_id"), 10))).collect()}
    assert p[True].perplexity < p[True].base_perplexity


def test_spelling_is_a_distribution():
    vocabulary = [b"", b"the", b"then", b"a1", "é".encode(), b"x-y"] + [f"w{i}".encode() for i in range(200)]
    data = pitman_yor.laid_out(vocabulary)
    keys, n = np.unique(pitman_yor.quads(data), return_counts=True)
    model = pitman_yor.fit_spelling(keys, n, np.bincount(data, minlength=256))
    sums = np.power(10.0, model.quad_log.astype(float)).reshape(-1, pitman_yor.SYMBOLS).sum(1)
    assert np.allclose(sums, 1, atol=1e-4)
    logs = model.log_probability([b"the", b"zzzz", b""])
    assert logs[0] > logs[1] and np.power(10.0, model.log_probability(vocabulary)).sum() < 1
    tables = pitman_yor.seated(np.array([0, 1, 5, 100_000]), np.array([1.0, 1.0, 0.5, 50.0]), 0.5, np.random.default_rng(1))
    assert tables[0] == 0 and tables[1] == 1 and 1 <= tables[2] <= 5 and 100 < tables[3] < 100_000
