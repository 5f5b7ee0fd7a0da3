"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its distinct shingles of five words. Its sketch has t coordinates. In round i each shingle falls
into a hashed bin and leaves there the pair (i, hash), the least of which stays; after t rounds a bin that is still
empty is given to every shingle in a round of its own. So each coordinate is filled, two sets agree in one with the
probability of their Jaccard similarity, and their agreement is concentrated about it. Bands of rows of the sketch are
bucket keys: with 24 bands of 5 rows a pair at similarity 0.85 shares none with a probability of 8e-7.

Documents of equal sets are one class, which has a number of its own, so rows that share a doc_id but not a text are kept
apart; such classes are linked with each other, being one document. A shingle that no other class in a bucket with company
has is in no intersection, so a class's other shingles, its solid ones, bound the size of each of its possible partners
from above. Buckets are split by size class, and a class goes only into those that hold sizes it can be linked with:
edited copies that have drifted too far from all others leave by this bound and are not compared.

What is left is settled in rounds: some pivots of a bucket, those met in most buckets first, are compared with its other
members that no chain of links ties to them yet; components are then joined, pivots leave, and buckets of one component
are done. Each round takes 64 times as many pivots, so every pair that shares a bucket is compared, tied by links, or
ruled out by a bound. The size of a symmetric difference is a metric, and an odd sketch of each set (the parities of how
many of its shingles fall into each of 1,024 cells) bounds it from below: two sketches differ in no more cells than the
sets differ in shingles. A pair whose sketches differ in more cells than a linked pair's sets may is dropped inside the
join, so what the join makes is little more than true links between components, however large a group of drifted copies
is. Only those are then compared on full sets. Where sets are much larger than sketches the bound says less, and pairs
are compared in full.

Cases: without words or text a set is empty and linked with nothing; with fewer than five words the whole sequence is
the only shingle; equal rows are equal members; rows of one doc_id and unlike texts are linked; a row without doc_id is
linked with nothing, has no component and is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, spread
from .graph import components

SHINGLE = 5
U = np.uint64
GOLD, MIX_A, MIX_B = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

#: Lists of ids alone are broadcast up to this many rows (8 bytes each); beyond it the join shuffles.
ID_ROWS = 250_000


@dataclass(frozen=True)
class NearDupConfig:
    similarity_percent: int = 85
    bands: int = 24
    rows: int = 5
    more_pivots: int = 64


class Words(dict):
    """64-bit hashes of words seen lately."""

    MOST = 60_000

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def hashes(self, text: str | None) -> np.ndarray:
        """Of the words of a text in order; A-Z lower-cased."""
        words = text.encode().lower().split() if text else []
        if len(self) > self.MOST:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), U, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct shingle hashes in order."""
    if not len(words):
        return words
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    h = np.full(n, GOLD)
    h *= U(width)
    for k in range(width):
        h ^= words[k : k + n]
        h *= MIX_A
        h ^= h >> U(32)
    h *= MIX_B
    h ^= h >> U(29)
    return np.unique(h)


def sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """t coordinates of a non-empty set: (round, hash) packed into 64 bits, the round on top."""
    out, n = np.full(t, np.iinfo(U).max), len(elements)
    i = 0
    while i < t:
        rounds = min(t - i, max(1, 4 * t // n))
        at = np.arange(i, i + rounds, dtype=U)[:, None]
        z = mixed(elements[None, :] + (at + U(1)) * GOLD)
        bins = ((z & U(0xFFFFFFFF)) * U(t)) >> U(32)
        np.minimum.at(out, bins.ravel().astype(np.intp), ((at << U(48)) | (z >> U(16))).ravel())
        i += rounds
        if out.max() < np.iinfo(U).max:
            return out
    for j in np.flatnonzero(out == np.iinfo(U).max).tolist():
        step = np.array([t + j + 1], U) * GOLD
        out[j] = (U(t + j) << U(48)) | (mixed(elements + step) >> U(16)).min()
    return out


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    rows = coordinates.reshape(bands, -1)
    h = np.arange(bands, dtype=U) * GOLD
    for k in range(rows.shape[1]):
        h = mixed((h ^ rows[:, k]) * MIX_A + U(k))
    return h


DIGEST = ("n_shingles", "digest1", "digest2")


def _digests(s: np.ndarray) -> tuple[int, int]:
    return mixed(s).sum().astype(np.int64), mixed(s + GOLD).sum().astype(np.int64)


def signatures(documents: DataFrame, config: NearDupConfig = NearDupConfig(), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, two halves of a digest of the set, and band keys (empty for an empty set); and the columns keep."""
    kept = documents.select("doc_id", "text", *keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, none = Words(), np.zeros(0, np.int64)
        for batch in batches:
            size, one, two, keys = [], [], [], []
            for text in batch.column(1):
                s = shingles(words.hashes(text.as_py()))
                size.append(len(s))
                a, b = _digests(s)
                one.append(a)
                two.append(b)
                keys.append(band_keys(sketch(s, config.bands * config.rows), config.bands).view(np.int64) if len(s) else none)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64())), *batch.columns[2:]],
                names=["doc_id", *DIGEST, "bands", *keep],
            )

    fields = [T.StructField(c, T.LongType()) for c in ("doc_id", *DIGEST)] + [T.StructField("bands", T.ArrayType(T.LongType()))]
    return kept.mapInArrow(run, T.StructType(fields + [kept.schema[c] for c in keep]))


#: Longs of an odd sketch.
ODD = tuple(f"odd{k}" for k in range(16))


def odd_sketch(elements: np.ndarray) -> np.ndarray:
    """Of each cell the parity of the elements in it, packed."""
    cells = 64 * len(ODD)
    h = mixed(elements ^ MIX_B) & U(cells - 1)
    return np.packbits(np.bincount(h.astype(np.intp), minlength=cells).astype(np.uint8) & 1).view(np.int64)


def _sets(documents: DataFrame) -> DataFrame:
    names = ["doc_id", *DIGEST, "set", *ODD]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 256):
                batch = whole.slice(at, 256)
                sets = [shingles(words.hashes(x.as_py())) for x in batch.column(1)]
                digests = [_digests(s) for s in sets]
                odd = np.array([odd_sketch(s) for s in sets], np.int64).reshape(-1, len(ODD))
                columns = [[len(s) for s in sets], [x for x, _ in digests], [y for _, y in digests]]
                ends = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]), pa.int32())
                flat = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, U), *sets]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns), flat, *(pa.array(c) for c in odd.T.copy())], names=names)

    return documents.select("doc_id", "text").mapInArrow(run, ", ".join(f"{c} {'array<long>' if c == 'set' else 'long'}" for c in names))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose full sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = x.values.to_numpy(), y.values.to_numpy()
                both = np.concatenate([p, q])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of = lambda c, s: sets.select(F.col("doc").alias(c), F.col("set").alias(s))
    return pairs.join(of("a", "set_a"), "a").join(of("b", "set_b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


#: Sizes of a class differ by this factor at most.
CLASS = 1.04


def _roles(members: DataFrame, percent: int) -> DataFrame:
    """members (bucket, doc, n, solid, ...) once for each size class in which they may have a partner.

    Of a pair the smaller is in the class of its size, if its bound reaches that size (`small`); the larger goes into
    all classes between the least size that the similarity allows and its own size or its bound.
    """
    # 100 * common >= percent * union and common <= solid: a partner's size is at most bound
    bound = F.floor(F.col("solid") * (100 + percent) / percent) - F.col("n")
    size_class = lambda n: F.floor(F.log(n.cast("double")) / float(np.log(CLASS)))
    low = F.ceil(F.col("n") * percent / 100)
    m = members.withColumn("bound", bound).withColumn("own", size_class(F.col("n")))
    top = F.least(F.col("own"), size_class(F.greatest("bound", F.lit(1))))
    m = m.filter(F.col("bound") >= low).withColumn("class", F.explode(F.sequence(F.least(size_class(low), top), top)))
    return m.withColumn("small", (F.col("class") == F.col("own")) & (F.col("bound") >= F.col("n"))).drop("own")


PIVOT = ("n", "solid", "component", "bands", *ODD)


def _first(active: DataFrame, pivots: int) -> DataFrame:
    """The pivots of each bucket; a large bucket is thinned in parts before it meets in one task."""
    rows = active.filter("small")
    if pivots == 1:
        top = rows.groupBy("bucket", "class").agg(F.max(F.struct("degree", (-F.col("doc")).alias("minus"), *PIVOT)).alias("x"))
        return top.select("bucket", "class", (-F.col("x.minus")).alias("pivot"), *[F.col(f"x.{c}").alias(f"pivot_{c}") for c in PIVOT])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(256)))
    for group in (["bucket", "class", "part"], ["bucket", "class"]):
        rows = rows.withColumn("at", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("degree"), "doc"))).filter(F.col("at") <= pivots)
    return rows.select("bucket", "class", F.col("doc").alias("pivot"), *[F.col(c).alias(f"pivot_{c}") for c in PIVOT])


def _settle(documents: DataFrame, classes: DataFrame, config: NearDupConfig) -> DataFrame | None:
    """node and component of all classes that are linked with another; None without any."""
    percent = config.similarity_percent
    buckets = classes.select(F.explode("bands").alias("bucket"), F.col("node").alias("doc"), F.col("n_shingles").alias("n"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = materialise(buckets.join(sizes, "bucket"), "neardup-buckets")
    degrees = materialise(shared.groupBy("doc").agg(F.sum("size").alias("degree"), F.sort_array(F.collect_set("bucket")).alias("bands")), "neardup-degrees")
    n = degrees.count()
    if not n:
        return None
    few = lambda df: F.broadcast(df) if n <= ID_ROWS else df
    met = materialise(classes.select(*DIGEST, "node", "class_id").join(few(degrees.select(F.col("doc").alias("node"))), "node", "left_semi"), "neardup-met")
    texts = documents.join(few(met.select(F.col("class_id").alias("doc_id")).distinct()), "doc_id", "left_semi")
    named = _sets(texts).join(few(met), [*DIGEST]).filter("doc_id = class_id").select(F.col("node").alias("doc"), "set", *ODD)
    sets = materialise(named.dropDuplicates(["doc"]), "neardup-sets")
    lone = sets.select("doc", F.explode("set").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("k"), F.min("doc").alias("doc")).filter("k = 1").groupBy("doc").agg(F.count(F.lit(1)).alias("lone"))
    bounds = degrees.join(lone, "doc", "left").join(sets.select("doc", *ODD), "doc").select("doc", "degree", "bands", *ODD, F.coalesce("lone", F.lit(0)).alias("lone"))
    members = shared.drop("size").join(bounds, "doc").withColumn("solid", F.col("n") - F.col("lone")).drop("lone")
    active = _roles(members, percent).withColumn("component", F.col("doc"))
    labels, pivots, key = None, 1, ["bucket", "class"]
    # 100 * common >= percent * union, so 100 + percent times the difference is at most 100 - percent times both sizes
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"pivot_{c}"))) for c in ODD), F.lit(0)).cast("long")
    near = differ * (100 + percent) <= (F.col("n") + F.col("pivot_n")) * (100 - percent)
    able = F.least("solid", "pivot_solid") * (100 + percent) >= (F.col("n") + F.col("pivot_n")) * percent
    # a pair is told of in the first bucket that it shares, and in no other
    here = F.array_min(F.array_intersect("bands", "pivot_bands")) == F.col("bucket")
    while True:
        # a bucket is open while small members are left and not all of its members are of one component
        open_ = active.groupBy(*key).agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.when(F.col("small"), F.col("n"))).alias("least")).filter("low <> high and least is not null")
        active = materialise(active.join(open_.select(*key, "least"), key).filter("bound >= least").drop("least"), "neardup-active")
        chosen = materialise(_first(active, pivots), "neardup-pivots")
        if chosen.isEmpty():
            return labels
        pairs = active.join(chosen, key).filter((F.col("component") != F.col("pivot_component")) & able & near & here)
        pairs = pairs.select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b")).distinct()
        found = materialise(_linked(pairs, sets, percent), "neardup-links")
        active = active.join(chosen.select(*key, F.col("pivot").alias("doc")), [*key, "doc"], "left_anti")
        if not found.isEmpty():
            # what is known is a star a component, not all of its links
            links = found if labels is None else found.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
            labels = components(links)
            active = active.drop("component").join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        pivots *= config.more_pivots


def _twins(filled: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links a, b between the classes of rows that share a doc_id; None without any."""
    several = materialise(filled.groupBy("doc_id").agg(F.min("digest1").alias("low"), F.max("digest1").alias("high")).filter("low <> high").select("doc_id"), "neardup-twins")
    if several.isEmpty():
        return None
    rows = filled.join(several, "doc_id", "left_semi").select("doc_id", *DIGEST).distinct().join(classes.select(*DIGEST, "node"), [*DIGEST]).select("doc_id", "node")
    return rows.join(rows.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b")).filter("a <> b")


def near_duplicates(documents: DataFrame, config: NearDupConfig = NearDupConfig(), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and the columns keep of documents, which may not be named like these."""
    signed = materialise(signatures(spread(documents.select("doc_id", "text", *keep)), config, keep), "neardup-signatures")
    filled = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy(*DIGEST).agg(F.min("doc_id").alias("class_id"), F.first("bands").alias("bands"))
    # numbers are given while the table is written, and stay
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "neardup-classes")
    labels, twins = _settle(documents, classes, config), _twins(filled, classes)
    if twins is not None:
        labels = components(twins if labels is None else twins.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    named = classes.select(*DIGEST, "class_id", "node")
    if labels is None:
        named = named.select(*DIGEST, F.col("class_id").alias("least_id"))
    else:
        tied = materialise(named.join(labels, "node"), "neardup-components")
        least = tied.groupBy("component").agg(F.min("class_id").alias("least_id"))
        few = tied.join(least, "component").select("node", "least_id")
        named = named.join(few, "node", "left").select(*DIGEST, F.coalesce("least_id", "class_id").alias("least_id"))
    rows = signed.drop("bands").join(named, [*DIGEST], "left")
    rows = rows.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("least_id", "doc_id")))
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *keep)
