"""Removing long byte strings that an earlier document has too, by suffix sorting in buckets.

A byte goes if a string of `length` bytes over it also starts in a document with a smaller doc_id. Texts are dealt into
homes, groups of documents of a few MB. Every window of `length` bytes is keyed by its minimizer, the least hash of its
20-byte strings, which equal windows share; windows that follow each other and share it are a run, and the bytes that
its windows cover are its context.

1. Homes send each minimizer once; the minimizers' buckets send back those that more than one document has.
2. For these alone, homes send each different context once, with the least of its documents. A bucket sorts all
   suffixes that start a window (see suffixes), so that equal windows meet, and finds the first document of each.
3. Buckets send that back, and homes take out what earlier documents have.

Each of a bucket's rows is one of a home, so a passage that many documents share weighs a row a home. Texts move once,
into their homes, and all steps read them there.

Cases: null and empty texts and those under `length` bytes lose nothing; documents of equal doc_id take nothing from
each other; a row without doc_id loses nothing and takes nothing; texts of any length are read whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import loosened, squeezed, utf8_slices
from .suffixes import SuffixOrder, words_at

U = np.uint64
#: A minimizer's hash is cut to so many bits, the lowest of which is free. Two that meet by chance cost a little work.
KEY_BITS = 48


@dataclass(frozen=True)
class RepeatConfig:
    length: int = 50
    gram: int = 20
    home_bytes: int = 1 << 20
    homes_a_partition: int = 8
    minimizer_bucket_bytes: int = 16 << 20
    context_bucket_bytes: int = 2 << 20
    sorted_bytes: int = 3 << 20
    most_partitions: int = 20_000  # of the homes; beyond it a partition has more homes, which are still read one by one


def minimizers(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Of each position: the least hash of the strings of gram bytes in the window of length bytes from there on."""
    n = len(data)
    w = words_at(np.concatenate([data, np.zeros(length + 16, np.uint8)]), n + length)
    h = w[: n + length - gram] * U(0x9E3779B97F4A7C15)
    for at in [*range(8, gram - 8, 8), gram - 8]:
        h ^= h >> U(29)
        h += w[at : at + len(h)]
        h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(32)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(29)
    wide, reach = length - gram + 1, 1
    while reach < wide:
        step = min(reach, wide - reach)
        h = np.minimum(h[: len(h) - step], h[step:])
        reach += step
    return h[:n]


def runs_of(data: np.ndarray, offsets: np.ndarray, config: RepeatConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows inside texts: document, first position, number of windows, minimizer."""
    m = minimizers(data, config.length, config.gram)
    count = np.maximum(np.diff(offsets) - config.length + 1, 0)
    document = np.repeat(np.arange(len(count)), count)
    within = np.arange(len(document)) - np.repeat(np.cumsum(count) - count, count)
    at = offsets[document] + within
    key = m[at] >> U(64 - KEY_BITS) & ~U(1)
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (document[1:] != document[:-1])
    start = np.flatnonzero(new)
    return document[start], at[start], np.diff(np.append(start, len(at))), key[start]


def _home(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, whether there is one, bytes and offsets of a home."""
    t = t.combine_chunks()
    batch = t.to_batches()[0] if t.num_rows else pa.RecordBatch.from_pylist([], schema=t.schema)
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), bool)
    _, _, data, offsets = next(utf8_slices(batch, limit=1 << 60))
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known, data, offsets


def _buckets(keys: np.ndarray, n: int) -> np.ndarray:
    """Minimizers are least hashes and so lie close to 0: they are mixed again before they are dealt out."""
    h = (keys & ~U(1)) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return ((h >> U(32)) * U(n)) >> U(32)


def _short(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].tobytes()


def _long(blob: bytes) -> np.ndarray:
    blob = memoryview(blob)
    out = np.zeros((blob.nbytes * 8 // KEY_BITS, 8), np.uint8)
    out[:, : KEY_BITS // 8] = np.frombuffer(blob, np.uint8).reshape(-1, KEY_BITS // 8)
    return out.view("<u8").reshape(-1).astype(U)


def _send(config: RepeatConfig, n_buckets: int):
    def run(t: pa.Table) -> pa.Table:
        ids, known, data, offsets = _home(t)
        document, _, _, key = runs_of(data, offsets, config)
        keep = known[document]
        document, key = ids[document[keep]], key[keep]
        order = np.lexsort((document, key))
        document, key = document[order], key[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        several = np.zeros(int(first.sum()), bool)
        other = np.flatnonzero(~first & (np.concatenate([[False], document[1:] != document[:-1]])))
        several[np.cumsum(first)[other] - 1] = True
        key = key[first] | several.astype(U)
        bucket = _buckets(key, n_buckets)
        order = np.argsort(bucket, kind="stable")
        key, (filled, begin) = key[order], np.unique(bucket[order], return_index=True)
        home = t.column("home")[0].as_py() if t.num_rows else 0
        parts = np.split(key, begin[1:]) if len(filled) else []
        return pa.table({"bucket": pa.array(filled.astype(np.int64)), "home": pa.array([home] * len(filled), pa.int64()), "keys": pa.array(map(_short, parts), pa.binary())})

    return run


def _shared(t: pa.Table) -> pa.Table:
    """Of a bucket of minimizers, for each home those that documents share."""
    blobs = [_long(x.as_buffer()) for x in t.column("keys")]
    every = np.concatenate(blobs)
    every.sort()
    bare = every & ~U(1)
    twice = (bare[1:] == bare[:-1])
    wanted = np.unique(np.concatenate([bare[1:][twice], bare[(every & U(1)) == 1]]))
    out = [_short((x & ~U(1))[_among(x & ~U(1), wanted)]) for x in blobs]
    return pa.table({"home": t.column("home"), "keys": pa.array(out, pa.binary())})


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(wanted, keys)
    return wanted[np.minimum(at, len(wanted) - 1)] == keys


def _contexts(config: RepeatConfig, n_buckets: int):
    def run(t: pa.Table, shared: pa.Table) -> pa.Table:
        wanted = np.sort(np.concatenate([np.zeros(0, U), *[_long(x.as_buffer()) for x in shared.column("keys")]]))
        ids, known, data, offsets = _home(t)
        document, at, count, key = runs_of(data, offsets, config)
        keep = known[document] & _among(key, wanted)
        document, at, count, key = ids[document[keep]].tolist(), at[keep].tolist(), count[keep].tolist(), key[keep]
        bucket, raw, more = _buckets(key, n_buckets).tolist(), data.tobytes(), config.length - 1
        found: defaultdict[int, dict[bytes, list[int]]] = defaultdict(dict)
        for d, a, c, b, k in zip(document, at, count, bucket, key.tolist(), strict=True):
            context = raw[a : a + c + more]
            x = found[b].get(context)
            if x is None:
                found[b][context] = [d, d, k]
            elif d < x[0]:
                x[0] = d
            elif d > x[1]:
                x[1] = d
        filled = sorted(found)
        home = t.column("home")[0].as_py() if t.num_rows else 0
        blob = lambda f, kind: pa.array([f(found[b], kind) for b in filled], pa.binary())
        of = lambda i: lambda x, kind: squeezed(np.array([y[i] for y in x.values()], kind))
        pressed = zstandard.ZstdCompressor(level=3)
        return pa.table({
            "bucket": pa.array(filled, pa.int64()), "home": pa.array([home] * len(filled), pa.int64()),
            "texts": blob(lambda x, _: pressed.compress(b"".join(x)), None), "sizes": blob(lambda x, kind: squeezed(np.array(list(map(len, x)), kind)), np.int32),
            "least": blob(of(0), np.int64), "several": blob(lambda x, kind: squeezed(np.array([y[1] > y[0] for y in x.values()], kind)), np.uint8),
            "keys": blob(lambda x, _: _short(np.array([y[2] for y in x.values()], U)), None),
        })

    return run


def first_documents(texts: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window of each text, in order, the least document of any text that has it; and where each text's begin."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    count = sizes - length + 1
    begin = np.cumsum(count) - count
    text = np.repeat(np.arange(len(texts)), count)
    positions = (np.cumsum(sizes) - sizes)[text] + np.arange(len(text)) - begin[text]
    suffixes = SuffixOrder(data, length)
    ordered = suffixes.order(positions)
    place = np.empty(len(data), np.int64)
    place[positions] = np.arange(len(positions))
    at = place[ordered]
    starts = np.flatnonzero(np.concatenate([[True], ~suffixes.equal_to_next(ordered)])) if len(ordered) else np.zeros(0, np.int64)
    out = np.empty(len(positions), np.int64)
    if len(ordered):
        out[at] = np.repeat(np.minimum.reduceat(least[text[at]], starts), np.diff(np.append(starts, len(ordered))))
    return out, begin


def _slices(keys: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Indexes by key, in runs of about `most` bytes that part no key."""
    order = np.argsort(keys, kind="stable")
    upto, ordered = np.cumsum(sizes[order]), keys[order]
    begin = 0
    while begin < len(order):
        end = max(begin, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + most, "right")) - 1)
        end = int(np.searchsorted(ordered, ordered[end], "right"))
        yield order[begin:end]
        begin = end


def _settle(config: RepeatConfig):
    def run(t: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        least: list[int] = []
        named: list[int] = []
        rows, keys = [], [_long(x.as_buffer()) for x in t.column("keys")]
        for r in range(t.num_rows):
            raw = zstandard.ZstdDecompressor().decompress(t.column("texts")[r].as_buffer())
            ends = np.cumsum(loosened(t.column("sizes")[r].as_buffer(), np.int32), dtype=np.int64)
            mine = []
            for a, b, d, key in zip([0, *ends[:-1].tolist()], ends.tolist(), loosened(t.column("least")[r].as_buffer(), np.int64).tolist(), keys[r].tolist(), strict=True):
                context = raw[a:b]
                k = number.get(context)
                if k is None:
                    k = number[context] = len(least)
                    least.append(d)
                    named.append(key)
                elif d < least[k]:
                    least[k] = d
                mine.append(k)
            rows.append(mine)
        texts, earliest = list(number), np.array(least, np.int64)
        low, high, smallest = (np.zeros(len(texts), np.int64) for _ in range(3))
        values, widths, done = [], [], 0
        # equal windows have equal keys, so keys can be sorted some at a time
        for some in _slices(np.array(named, U), np.fromiter(map(len, texts), np.int64, len(texts)), config.sorted_bytes):
            first, begin = first_documents([texts[k] for k in some.tolist()], earliest[some], config.length)
            new = np.ones(len(first), bool)
            new[1:] = first[1:] != first[:-1]
            new[begin] = True
            stretch = np.flatnonzero(new)
            values.append(first[stretch])
            widths.append(np.diff(np.append(stretch, len(first))))
            low[some] = done + np.searchsorted(stretch, begin)
            high[some] = done + np.searchsorted(stretch, np.append(begin[1:], len(first)))
            smallest[some] = np.minimum.reduceat(first, begin)
            done += len(stretch)
        value, width = np.concatenate([np.zeros(0, np.int64), *values]), np.concatenate([np.zeros(0, np.int64), *widths])
        digest = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in texts), U, len(texts))
        out = {"home": t.column("home"), "keys": [], "digests": [], "stretches": [], "values": [], "widths": []}
        for r, mine in enumerate(rows):
            k = np.array(mine, np.int64)
            cut = (smallest[k] < loosened(t.column("least")[r].as_buffer(), np.int64)) | (loosened(t.column("several")[r].as_buffer(), np.uint8) > 0)
            k = k[cut]
            n = high[k] - low[k]
            each = np.repeat(low[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out["keys"].append(_short(keys[r][cut]))
            out["digests"].append(digest[k].tobytes())
            out["stretches"].append(squeezed(n.astype(np.int32)))
            out["values"].append(squeezed(value[each]))
            out["widths"].append(squeezed(width[each].astype(np.int32)))
        return pa.table({c: x if c == "home" else pa.array(x, pa.binary()) for c, x in out.items()})

    return run


def _cut(config: RepeatConfig, with_text: bool):
    def run(t: pa.Table, results: pa.Table) -> pa.Table:
        ids, known, data, offsets = _home(t)
        column = lambda c, kind: np.concatenate([np.zeros(0, kind), *[(np.frombuffer if c == "digests" else loosened)(x.as_buffer(), kind) for x in results.column(c)]])
        keys = np.concatenate([np.zeros(0, U), *[_long(x.as_buffer()) for x in results.column("keys")]])
        digests, n = column("digests", U), column("stretches", np.int32).astype(np.int64)
        values, widths, begin = column("values", np.int64), column("widths", np.int32).astype(np.int64), np.cumsum(n) - n
        place = {x: i for i, x in enumerate(zip(keys.tolist(), digests.tolist(), strict=True))}
        document, at, count, key = runs_of(data, offsets, config)
        keep = known[document] & _among(key, np.unique(keys))
        document, at, count, key = ids[document[keep]], at[keep], count[keep], key[keep]
        raw, more = data.tobytes(), config.length - 1
        digest = [xxhash.xxh3_64_intdigest(raw[a : a + c + more]) for a, c in zip(at.tolist(), count.tolist(), strict=True)]
        which = np.fromiter((place.get(x, -1) for x in zip(key.tolist(), digest, strict=True)), np.int64, len(digest))
        document, at, which = document[which >= 0], at[which >= 0], which[which >= 0]
        m = n[which]
        owner = np.repeat(np.arange(len(which)), m)
        each = np.repeat(begin[which] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        width = widths[each]
        ahead = np.cumsum(width) - width
        ahead -= np.repeat(ahead[np.cumsum(m) - m] if len(m) else ahead[:0], m)
        gone = values[each] < document[owner]
        low = (at[owner] + ahead)[gone]
        edge = np.zeros(len(data) + 1, np.int64)
        np.add.at(edge, low, 1)
        np.add.at(edge, low + width[gone] + more, -1)
        removed = np.cumsum(edge[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(removed)])
        rise = removed.copy()
        rise[1:] &= ~removed[:-1]
        inner = offsets[:-1][np.diff(offsets) > 0]
        rise[inner] = removed[inner]
        spans = np.concatenate([[0], np.cumsum(rise)])
        sizes, cut = np.diff(offsets), total[offsets[1:]] - total[offsets[:-1]]
        digests, texts = [], []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            kept = data[a:b][~removed[a:b]].tobytes() if cut[i] else raw[a:b]
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept.decode(errors="ignore"))
        out = {"doc_id": t.column("doc_id"), "n_bytes": pa.array(sizes), "n_removed": pa.array(cut), "n_spans": pa.array(spans[offsets[1:]] - spans[offsets[:-1]]), "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(out | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}))

    return run


def remove_repeats(documents: DataFrame, config: RepeatConfig = RepeatConfig(), with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text adds kept_text, without bytes of characters cut in two."""
    total = documents.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    homes = max(1, -(-total // config.home_bytes))
    few = lambda size: max(1, -(-total // size))
    home = F.pmod(F.xxhash64("doc_id", "text"), F.lit(homes))
    base = documents.select("doc_id", "text").withColumn("home", home).repartition(min(few(config.home_bytes * config.homes_a_partition), config.most_partitions), "home")
    sent = base.groupBy("home").applyInArrow(_send(config, few(config.minimizer_bucket_bytes)), "bucket long, home long, keys binary")
    shared = sent.groupBy("bucket").applyInArrow(_shared, "home long, keys binary")
    n_buckets = few(config.context_bucket_bytes)
    contexts = base.groupBy("home").cogroup(shared.groupBy("home")).applyInArrow(_contexts(config, n_buckets), "bucket long, home long, texts binary, sizes binary, least binary, several binary, keys binary")
    results = contexts.groupBy("bucket").applyInArrow(_settle(config), "home long, keys binary, digests binary, stretches binary, values binary, widths binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    return base.groupBy("home").cogroup(results.groupBy("home")).applyInArrow(_cut(config, with_text), schema)
