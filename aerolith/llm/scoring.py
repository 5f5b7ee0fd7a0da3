"""Scoring texts by a hierarchical Pitman-Yor language model (see pitman_yor) and by add-0.1 unigrams.

Tokens are words with A-Z lower-cased, then one end, which is spelled as the empty word. A token's restaurant is that of
the word in front of it (of the end, if there is none). The tables of all these are the customers of one parent restaurant
without context, and its base is a model of spellings, which is trained on one customer a word and gives every byte
string a probability. So the score is a probability over all texts: words not seen in training are scored by their
spelling. event_score is the same model over the base score's events, the words seen in training and one more for all
others, which gets what the spellings leave to them; perplexities are compared on these.

1. Texts become homes of a few MB: their distinct words, and their tokens as places among these.
2. Words meet in buckets, which count them, number them, and send each home its words' numbers and counts. Counts of symbols,
   which are of bounded number, go to the driver, where the spellings are fitted.
3. Homes send their distinct word pairs to buckets by context, those of a hot context to several by the second word. A
   bucket seats the pairs' customers by Gibbs sampling; the parent's probability is a word's relative frequency there.
   Homes get their pairs' shares back.
4. Tables meet by word: as customers of the parent restaurant, which is seated there, and as sums of a context.
5. Homes put both together and add up their documents.

A word weighs a row a home at most in its bucket, however frequent. Draws are seeded by bucket and made in an order of the
words' numbers, so scores do not depend on how the rows are laid out.

Cases: a null or empty text is a lone end; a row without doc_id is not held out; equal rows each count and are scored;
texts of any length are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import loosened, squeezed, utf8_slices
from .common import materialise
from .pitman_yor import HpyConfig, fit_spelling, gibbs, laid_out, quads

SMOOTHING = 0.1
HOME_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20


def narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers that are not negative in as few bytes as they need: 4 or 8."""
    return a.astype(np.uint32 if not len(a) or a.max() < 2**32 else np.uint64)


def _column(t: pa.Table, c: str, kind) -> list[np.ndarray]:
    return [loosened(x.as_buffer(), kind) for x in t.column(c)]


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


HOMES = "home long, words binary, buckets binary, sizes binary, counts binary, docs array<long>, held array<boolean>, tokens binary, seq binary"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


_TYPES = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "double": pa.float64(), "boolean": pa.bool_()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(x.split()[0], _TYPES[x.split()[1]]) for x in schema.split(", ")])


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = _arrow(schema)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


def _homes(n_buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = TaskContext.get().partitionId() << 32
        for batch in batches:
            for row, end, data, offsets in utf8_slices(batch, limit=HOME_BYTES):
                numbers, raw = Numbers(), data.tobytes().lower()
                held = np.asarray(batch.column(2).slice(row, end - row).to_numpy(zero_copy_only=False), bool)
                seq, tokens, train = [], [], [np.zeros(0, np.int32)]
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    words = raw[a:b].split()
                    words.append(b"")
                    ids = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                    if not held[i]:
                        train.append(ids)
                    seq.append(ids)
                    tokens.append(len(words))
                words = list(numbers)
                count = np.bincount(np.concatenate(train), minlength=len(words))
                bucket = (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                place = np.empty(len(words), np.int32)
                place[order] = np.arange(len(words))
                buckets, sizes = np.unique(bucket, return_counts=True)
                ids = pa.array(batch.column(0)).slice(row, end - row).to_pylist()
                blob = zstandard.ZstdCompressor(level=1).compress(b"\n".join([words[k] for k in order.tolist()]))
                one = (home, blob, squeezed(buckets), squeezed(sizes), squeezed(count[order]), ids, held.tolist(), squeezed(np.array(tokens, np.int64)), squeezed(place[np.concatenate(seq)]))
                yield from _table([one], HOMES).to_batches()
                home += 1

    return run


SENT = "bucket long, home long, words binary, counts binary"


def _send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A home's words to their buckets."""
    for batch in batches:
        for r in range(batch.num_rows):
            x = {c: batch.column(i)[r].as_py() for i, c in enumerate(batch.schema.names)}
            words, counts = zstandard.ZstdDecompressor().decompress(x["words"]).split(b"\n"), loosened(x["counts"], np.int64)
            rows, at = [], 0
            for bucket, size in zip(loosened(x["buckets"], np.int64).tolist(), loosened(x["sizes"], np.int64).tolist(), strict=True):
                rows.append((bucket, x["home"], b"\n".join(words[at : at + size]), squeezed(counts[at : at + size])))
                at += size
            yield from _table(rows, SENT).to_batches()


#: home -1: a bucket's words in order, their counts in training. Else: places in it of a home's words, and their counts.
MERGED = "bucket long, home long, words binary, places binary, counts binary"


def _merge(t: pa.Table) -> pa.Table:
    numbers, rows, counts = Numbers(), [], []
    for words, n in zip(t.column("words"), _column(t, "counts", np.int64), strict=True):
        words = words.as_py().split(b"\n")
        rows.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        counts.append(n)
    total = np.zeros(len(numbers), np.int64)
    for k, n in zip(rows, counts, strict=True):
        total[k] += n  # a word is in a row once
    words = list(numbers)
    order = sorted(range(len(words)), key=lambda k: (-total[k], words[k]))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    total, bucket = total[order], t.column("bucket")[0].as_py()
    blob = zstandard.ZstdCompressor(level=1).compress(b"\n".join([words[k] for k in order]))
    out = [(bucket, -1, blob, None, squeezed(total))]
    out += [(bucket, h, None, squeezed(narrow(place[k])), squeezed(total[place[k]])) for h, k in zip(t.column("home").to_pylist(), rows, strict=True)]
    return _table(out, MERGED)


#: Keys of totals beside quads' numbers, which are not negative.
N_TOKENS, N_TYPES, BYTES_FROM = -1, -2, -300


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob, n in zip(batch.column(0), batch.column(1), strict=True):
            words, counts = zstandard.ZstdDecompressor().decompress(blob.as_buffer()).split(b"\n"), loosened(n.as_buffer(), np.int64)
            known = words[: int((counts > 0).sum())]  # the most frequent come first
            data = laid_out(known)
            keys, n_of = np.unique(quads(data), return_counts=True)
            seen = np.bincount(data, minlength=256)
            keys = np.concatenate([keys, [N_TOKENS, N_TYPES], BYTES_FROM + np.arange(256)])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.concatenate([n_of, [counts.sum(), len(known)], seen]), pa.int64())], names=["key", "n"])


def _places(x, n) -> np.ndarray:
    size = len(loosened(n.as_buffer(), np.int64))
    raw = zstandard.ZstdDecompressor().decompress(x.as_buffer())
    return loosened(x.as_buffer(), np.uint32 if len(raw) == 4 * size else np.uint64).astype(np.int64)


class Pairs:
    """A home's distinct pairs of (word in front, word) by bucket, then by context; pair: of each token. ids: of the home's
    words, that is place * n_buckets + bucket."""

    def __init__(self, t: pa.Table, words: pa.Table, n_buckets: int, config: HpyConfig):
        words = words.sort_by("bucket")
        narrowed = [_places(x, n) for x, n in zip(words.column("places"), words.column("counts"), strict=True)]
        of = np.repeat(np.array(words.column("bucket").to_pylist(), np.int64), [len(x) for x in narrowed])
        self.ids = _joined(narrowed, np.int64) * n_buckets + of
        self.counts = _joined(_column(words, "counts", np.int64), np.int64)
        self.seq, self.tokens = _joined(_column(t, "seq", np.int32), np.int32).astype(np.int64), _joined(_column(t, "tokens", np.int64), np.int64)
        self.begin = np.cumsum(self.tokens) - self.tokens
        front = np.roll(self.seq, 1)
        front[self.begin] = self.seq[-1]  # the end
        keys, pair = np.unique(front * len(self.ids) + self.seq, return_inverse=True)
        self.front, self.word = keys // len(self.ids), keys % len(self.ids)
        salts = np.maximum(-(-self.counts // config.hot), 1)[self.front]
        h = (self.ids[self.front] * 0x9E3779B1 >> 7) + (self.ids[self.word] * 0x85EBCA6B >> 9) % salts
        bucket = h % n_buckets
        order = np.lexsort((self.ids[self.word], self.ids[self.front], bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.front, self.word, self.bucket, self.pair = self.front[order], self.word[order], bucket[order], place[pair]


PAIRS = "home long, bucket long, fronts binary, front_counts binary, runs binary, words binary, word_counts binary, at binary, counts binary"


KINDS = (np.int64, np.int64, np.int32, np.int64, np.int64, np.int32, np.int32)


def _pairs(n_buckets: int, config: HpyConfig):
    def run(t: pa.Table, words: pa.Table) -> pa.Table:
        p = Pairs(t, words, n_buckets, config)
        train = np.repeat(~np.array(t.column("held")[0].as_py(), bool), p.tokens)
        n = np.bincount(p.pair[train], minlength=len(p.word)).astype(np.int64)
        rows, home = [], t.column("home")[0].as_py()
        cuts = np.append(np.flatnonzero(np.diff(p.bucket, prepend=-1)), len(p.bucket)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            front, word = p.front[a:b], p.word[a:b]
            first = np.flatnonzero(np.diff(front, prepend=-1))
            runs = np.diff(np.append(first, b - a))
            used, at = np.unique(word, return_inverse=True)
            each = (p.ids[front[first]], p.counts[front[first]], runs, p.ids[used], p.counts[used], at, n[a:b])
            rows.append((home, int(p.bucket[a]), *(squeezed(x.astype(kind)) for x, kind in zip(each, KINDS, strict=True))))
        return _table(rows, PAIRS)

    return run


#: Of a home: its pairs' shares. Of a bucket of words (home -1): tables that its words have as customers and as contexts.
SEATED = "home long, bucket long, shares binary, ids binary, customers binary, tables binary"


def _pair_seats(n_buckets: int, tokens: int, config: HpyConfig):
    def run(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        runs, used = _column(t, "runs", np.int32), _column(t, "words", np.int64)
        fronts = _joined([np.repeat(x, r) for x, r in zip(_column(t, "fronts", np.int64), runs, strict=True)], np.int64)
        of_front = _joined([np.repeat(x, r) for x, r in zip(_column(t, "front_counts", np.int64), runs, strict=True)], np.int64)
        at = _column(t, "at", np.int32)
        words = _joined([x[k] for x, k in zip(used, at, strict=True)], np.int64)
        of_word = _joined([x[k] for x, k in zip(_column(t, "word_counts", np.int64), at, strict=True)], np.int64)
        names, front = np.unique(fronts, return_inverse=True)
        seen, word = np.unique(words, return_inverse=True)
        _, first, pair = np.unique(front * len(seen) + word, return_index=True, return_inverse=True)
        n = np.bincount(pair, _joined(_column(t, "counts", np.int32), np.int32)).astype(np.int64)
        p = of_word[first] / max(1, tokens)
        # of a context dealt out, the words here stand for those elsewhere
        scale = np.ones(len(names))
        scale[front[first]] = np.maximum(-(-of_front[first] // config.hot), 1)
        rng = np.random.default_rng([config.seed, 1, bucket])
        kept = config.sweeps - config.burn_in
        tables = gibbs(n, front[first], scale, p, config.pair_discount, config.pair_strength, rng, config)
        share = np.maximum(n - config.pair_discount * tables / kept, 0).astype(np.float32)[pair]
        ends = np.cumsum([len(x) for x in at])
        rows = [(h, bucket, squeezed(x), None, None, None) for h, x in zip(t.column("home").to_pylist(), np.split(share, ends[:-1]), strict=True)]
        keys, where = np.unique(np.concatenate([names, seen]), return_inverse=True)
        as_front = np.bincount(where[: len(names)], np.bincount(front[first], tables, len(names)), len(keys)).astype(np.int64)
        customers = np.bincount(where[len(names) :], np.bincount(word[first], tables, len(seen)), len(keys)).astype(np.int64)
        to = keys % n_buckets
        order = np.argsort(to, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(to[order], prepend=-1)), len(order)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            k = order[a:b]
            rows.append((-1, int(to[k[0]]), None, *(squeezed(x[k]) for x in (keys, customers, as_front))))
        return _table(rows, SEATED)

    return run


WORDS = "home long, bucket long, shares binary, logs binary, fronts binary, customers long, tables double, spelled double"


def _word_seats(spelling, types: int, n_buckets: int, config: HpyConfig):
    def run(t: pa.Table, met: pa.Table) -> pa.Table:
        t = t.sort_by("home")
        bucket, kept = t.column("bucket")[0].as_py(), config.sweeps - config.burn_in
        words = zstandard.ZstdDecompressor().decompress(t.column("words")[0].as_py()).split(b"\n")
        counts = loosened(t.column("counts")[0].as_buffer(), np.int64)
        sums = np.zeros((2, len(words)), np.int64)
        place = _joined(_column(met, "ids", np.int64), np.int64) // n_buckets
        for into, c in zip(sums, ("customers", "tables"), strict=True):
            np.add.at(into, place, _joined(_column(met, c, np.int64), np.int64))
        customers = np.where(counts > 0, np.maximum(1, np.rint(sums[0] / kept)), 0).astype(np.int64)
        logs = spelling.value.log_probability(words)
        known = int((counts > 0).sum())
        rng = np.random.default_rng([config.seed, 2, bucket])
        tables = gibbs(customers, np.zeros(len(words), np.int64), np.array([types / max(1, known)]), np.power(10.0, logs), config.word_discount, config.word_strength, rng, config) / kept
        share = np.maximum(customers - config.word_discount * tables, 0)
        spelled = float(np.power(10.0, logs[counts > 0]).sum())
        out = [(-1, bucket, None, None, None, int(customers.sum()), float(tables.sum()), spelled)]
        for h, x, n in zip(t.column("home").to_pylist()[1:], t.column("places")[1:], t.column("counts")[1:], strict=True):
            k = _places(x, n)
            out.append((h, bucket, squeezed(share[k]), squeezed(logs[k]), squeezed(sums[1][k]), None, None, None))
        return _table(out, WORDS)

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, event_score double"


def _added(n: int, types: int, customers: int, tables: float, unseen: float, n_buckets: int, config: HpyConfig):
    def run(t: pa.Table, results: pa.Table) -> pa.Table:
        kinds = results.column("kind")
        part = lambda k: results.filter(pc.equal(kinds, k)).sort_by("bucket")
        of = lambda k, c, kind: _joined(_column(part(k), c, kind), kind)
        p = Pairs(t, part(0), n_buckets, config)
        spelled = np.power(10.0, of(2, "logs", np.float64))
        pair_share, share = of(1, "shares", np.float32).astype(np.float64), of(2, "shares", np.float64)
        left = config.pair_strength + config.pair_discount * of(2, "fronts", np.int64) / (config.sweeps - config.burn_in)
        over = config.word_strength + config.word_discount * tables

        def logs(mass: np.ndarray) -> np.ndarray:
            word = (share + over * mass) / (config.word_strength + customers)
            return np.log10((pair_share + left[p.front] * word[p.word]) / (config.pair_strength + p.counts[p.front]))

        known = p.counts > 0
        unigram = np.log10((p.counts + SMOOTHING) / (n + SMOOTHING * (types + 1)))
        add = lambda x: np.add.reduceat(x, p.begin)
        docs = t.column("docs")[0].as_py()
        return pa.table({
            "doc_id": pa.array(docs, pa.int64()), "held_out": pa.array(t.column("held")[0].as_py(), pa.bool_()), "n_tokens": pa.array(p.tokens),
            "n_known": pa.array(add(known[p.seq].astype(np.int64))), "train_tokens": pa.array(np.full(len(docs), n, np.int64)), "base_score": pa.array(add(unigram[p.seq])),
            "score": pa.array(add(logs(spelled)[p.pair])), "event_score": pa.array(add(logs(np.where(known, spelled, unseen))[p.pair])),
        })

    return run


def score(documents: DataFrame, held_out: Column, config: HpyConfig = HpyConfig()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, and base_score, score, event_score (log10), learned from rows not
    held out."""
    spark = documents.sparkSession
    total = documents.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_buckets = max(1, -(-total // BUCKET_BYTES))
    homes = materialise(documents.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(_homes(n_buckets), HOMES), "scoring-homes")
    sent = homes.select("home", "words", "buckets", "sizes", "counts").mapInArrow(_send, SENT)
    merged = materialise(sent.groupBy("bucket").applyInArrow(_merge, MERGED), "scoring-merged")
    totals = merged.filter("home < 0").select("words", "counts").mapInArrow(_totals, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    found = dict(zip(totals.key.tolist(), totals.n.tolist(), strict=True))
    n, types = found.get(N_TOKENS, 0), found.get(N_TYPES, 0)
    quad = totals[totals.key >= 0]
    spelling = fit_spelling(quad.key.to_numpy(np.int64), quad.n.to_numpy(np.int64), np.array([found.get(BYTES_FROM + b, 0) for b in range(256)], np.int64), config)
    shared = spark.sparkContext.broadcast(spelling)
    told = merged.filter("home >= 0").select("home", "bucket", "places", "counts")
    texts = homes.select("home", "docs", "held", "tokens", "seq")
    pairs = texts.groupBy("home").cogroup(told.groupBy("home")).applyInArrow(_pairs(n_buckets, config), PAIRS)
    seated = materialise(pairs.groupBy("bucket").applyInArrow(_pair_seats(n_buckets, n, config), SEATED), "scoring-pairs")
    met = seated.filter("home < 0").select("bucket", "ids", "customers", "tables")
    final = materialise(merged.groupBy("bucket").cogroup(met.groupBy("bucket")).applyInArrow(_word_seats(shared, types, n_buckets, config), WORDS), "scoring-words")
    sums = final.filter("home < 0").agg(*[F.sum(c).alias(c) for c in ("customers", "tables", "spelled")]).first()
    unseen = max(1.0 - (sums["spelled"] or 0.0), 1e-9)
    kind = lambda df, k: df.withColumn("kind", F.lit(k))
    results = kind(told, 0).unionByName(kind(seated.filter("home >= 0").select("home", "bucket", "shares"), 1), allowMissingColumns=True)
    results = results.unionByName(kind(final.filter("home >= 0").select("home", "bucket", "shares", "logs", "fronts"), 2), allowMissingColumns=True)
    added = _added(n, types, sums["customers"] or 0, sums["tables"] or 0.0, unseen, n_buckets, config)
    return texts.groupBy("home").cogroup(results.groupBy("home")).applyInArrow(added, SCORED)


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, tokens, and perplexity a token under the model and under unigrams, over the same events; and spelled, the
    model's where words not seen in training are spelled out."""
    ten = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), ten("event_score").alias("perplexity"), ten("base_score").alias("base_perplexity"), ten("score").alias("spelled"))
