"""Language identification by word-first backoff.

A word that the model knows scores its log10 relative frequency in each language, or a fixed penalty where a language
lacks it. An unknown word is scored by its character n-grams, padded with spaces, of the longest length of which the
model knows any; a word without a known n-gram says nothing. A text's score in a language is the mean over its words.
Words are runs of letters, lower-cased.

The model is fitted on a sample of labelled rows that is bounded for each language (LanguageConfig.sample_docs) and keeps
every word and n-gram of it. Words are counted first, and n-grams are cut once a distinct word. The model is held as
arrays: hashes of its entries in order, and a row of scores each; entries are told apart by 64 bits of hash.

Cases: a null text, or one without a letter, is `und` with score 0, as is every text if nothing was learned; a text of
which the model knows nothing gets the most frequent language and its share; ties go to the first language by name;
texts are read whole; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, small, spread

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Resolution of the draw of the sample.
DRAWS = 1 << 40


@dataclass(frozen=True)
class LanguageConfig:
    sample_docs: int = 2_000  # labelled rows of a language that the model is fitted on, about so many at most
    longest: int = 5
    penalty: float = -7.0
    steady: int = 10


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", errors="surrogatepass"), np.uint32)


U, MIX = np.uint64, np.uint64(0x9E3779B97F4A7C15)


def _hashed(codes: np.ndarray, at: np.ndarray, kind: int) -> np.ndarray:
    """Of the n-grams of kind code points from the places at on."""
    h = np.full(len(at), kind, U) * MIX
    for k in range(kind):
        h = (h ^ codes[at + k]) * MIX
        h ^= h >> U(29)
    h *= U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


def grams(words: list[str], kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of kind code points of words, each padded with a space before and behind, and each one's word."""
    codes = codes_of(" " + "  ".join(words) + " ") if words else np.zeros(0, np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    count = np.maximum(sizes - kind + 1, 0)
    owner = np.repeat(np.arange(len(words)), count)
    at = (np.cumsum(sizes) - sizes)[owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
    return _hashed(codes, at, kind), owner


def entries(words: list[str]) -> np.ndarray:
    """Hashes of words."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w.encode(errors="surrogatepass")) for w in words), U, len(words))


def entry(kind: int, gram: str) -> int:
    """The hash of a word (kind 0) or n-gram (kind n)."""
    return int(entries([gram])[0] if kind == 0 else _hashed(codes_of(gram), np.zeros(1, np.int64), kind)[0])


class Model:
    """languages by name, shares of the documents, and of each kind (0: words, n: n-grams) log10 frequencies."""

    def __init__(self, languages: list[str], shares: list[float], tables: dict[int, dict[str, tuple[float, ...]]], config: LanguageConfig):
        flat = [(entry(kind, gram), row) for kind, table in tables.items() for gram, row in table.items()]
        keys = np.array([k for k, _ in flat], np.uint64)
        self._hold(languages, shares, keys, np.array([row for _, row in flat], np.float64).reshape(len(flat), len(languages)), config)

    @classmethod
    def of(cls, languages: list[str], shares: list[float], keys: np.ndarray, rows: np.ndarray, config: LanguageConfig) -> Model:
        model = cls.__new__(cls)
        model._hold(languages, shares, keys, rows, config)
        return model

    def _hold(self, languages, shares, keys, rows, config) -> None:
        order = np.argsort(keys, kind="stable")
        self.languages, self.shares, self.config = languages, np.array(shares), config
        # many entries have the same scores, as all that were met once in one language have
        whole = np.ascontiguousarray(rows, np.float64).view(np.dtype((np.void, 8 * max(1, rows.shape[1])))).reshape(-1) if rows.size else np.zeros(0)
        _, first, row = np.unique(whole, return_index=True, return_inverse=True)
        self.keys, self.row, self.rows = keys[order], row.reshape(-1)[order].astype(np.int32), rows[first]

    def _places(self, wanted: np.ndarray) -> np.ndarray:
        """Of hashes: their row, or -1."""
        if not len(self.keys):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.row[at], -1)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of scores for each word, and whether the model knows anything of it."""
        at = self._places(entries(words))
        told, rows = at >= 0, np.zeros((len(words), len(self.languages)))
        rows[told] = self.rows[at[told]]
        for kind in range(self.config.longest, 0, -1):
            left = np.flatnonzero(~told)
            if not len(left):
                break
            hashes, owner = grams([words[k] for k in left.tolist()], kind)
            at = self._places(hashes)
            owner, at = owner[at >= 0], at[at >= 0]
            n = np.bincount(owner, minlength=len(left))
            some = n > 0
            for c in range(rows.shape[1]):
                rows[left[some], c] = np.bincount(owner, self.rows[at, c], len(left))[some] / n[some]
            told[left[some]] = True
        return rows, told

    def word(self, word: str) -> tuple[float, ...] | None:
        rows, told = self.score([word])
        return tuple(rows[0].tolist()) if told[0] else None


class Scorer:
    """Predicts texts; remembers the scores of words met lately. Row 0 is for words that say nothing."""

    MOST = 50_000

    def __init__(self, model: Model):
        self.model, self.place, self.letters = model, {}, 0
        self.rows, self.told = np.zeros((1, len(model.languages))), np.zeros(1, bool)

    def _learn(self, texts: list[list[str]]) -> None:
        if len(self.place) > self.MOST or self.letters > 32 * self.MOST:
            self.__init__(self.model)
        new = list({w: None for words in texts for w in words if w not in self.place})
        if new:
            rows, told = self.model.score(new)
            self.place.update(zip(new, np.where(told, np.arange(len(self.rows), len(self.rows) + len(new)), 0).tolist(), strict=True))
            self.rows = np.concatenate([self.rows, rows])
            self.letters += sum(map(len, new))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [words_of(x) for x in texts]
        if self.model.languages:
            self._learn(split)
        return [self._one(words) for words in split]

    def _one(self, words: list[str]) -> tuple[str, float]:
        m = self.model
        if not m.languages or not any(any(map(str.isalpha, w)) for w in words):  # numerals such as ² stand among letters
            return UNKNOWN, 0.0
        ids = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        ids = ids[ids > 0]
        if not len(ids):
            best = int(m.shares.argmax())
            return m.languages[best], float(m.shares[best])
        mean = self.rows[ids].mean(0)
        best = int(mean.argmax())
        return m.languages[best], float(1 / np.power(10.0, (mean - mean[best]) * min(len(ids), m.config.steady)).sum())


#: Characters of texts that are split and looked up at once, one text at least.
TOGETHER = 1 << 20


def _groups(texts: pa.Array) -> Iterator[list[str | None]]:
    group, size = [], 0
    for x in texts:
        group.append(x.as_py())
        size += len(group[-1] or "")
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    yield group


def sample(labelled: DataFrame, config: LanguageConfig = LanguageConfig()) -> tuple[DataFrame, dict[str, int]]:
    """Rows to fit on, drawn for each language by a hash of all columns given; and the rows that each language has."""
    counts = materialise(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "language-counts")
    docs = {r.lang: r.rows for r in counts.collect()}  # a row a language: the model has a column for each
    if not docs:
        return labelled.select("lang", "text"), docs
    bound = counts.select("lang", (F.lit(DRAWS) * F.least(F.lit(1.0), config.sample_docs / F.col("rows"))).cast("long").alias("_below"))
    drawn = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in labelled.columns]), F.lit(DRAWS))
    return labelled.withColumn("_drawn", drawn).join(small(bound, len(docs)), "lang").filter("_drawn < _below").select("lang", "text"), docs


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words by language, summed as far as fits."""
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        keys, n = list(counts), pa.array(counts.values(), pa.int64())
        columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(2)]
        counts.clear()
        return pa.RecordBatch.from_arrays([*columns, n], names=["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for word, n in Counter(words_of(text)).items():
                counts[lang, word] += n
            if len(counts) >= 100_000:
                yield rows()
    yield rows()


def _entries(longest: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of words and n-grams by their hashes; n-grams are cut once a word."""
        for batch in batches:
            langs, words = batch.column(0).dictionary_encode(), batch.column(1).to_pylist()
            lang, n = langs.indices.to_numpy(), batch.column(2).to_numpy()
            for kind in range(longest + 1):
                hashes, owner = grams(words, kind) if kind else (entries(words), np.arange(len(words)))
                order = np.lexsort((hashes, lang[owner]))
                hashes, of, weight = hashes[order], lang[owner][order], n[owner][order]
                first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])])) if len(hashes) else np.zeros(0, np.int64)
                total = np.add.reduceat(weight, first) if len(first) else np.zeros(0, np.int64)
                columns = [langs.dictionary.take(pa.array(of[first])), pa.array(np.full(len(first), kind, np.int32)), pa.array(hashes[first].view(np.int64)), pa.array(total, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "kind", "entry", "n"])

    return run


def fit(labelled: DataFrame, config: LanguageConfig = LanguageConfig()) -> Model:
    """labelled: text and lang, both non-null, and columns that tell rows apart, if there are any."""
    rows, docs = sample(labelled, config)
    words = materialise(rows.mapInArrow(_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    counted = spread(words).mapInArrow(_entries(config.longest), "lang string, kind int, entry long, n long")
    found = counted.groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n")).toArrow()  # bounded by the sample's rows
    languages, everything = sorted(docs), sum(docs.values())
    lang = found.column("lang").combine_chunks().dictionary_encode()
    place = np.array([languages.index(x) for x in lang.dictionary.to_pylist()], np.int64)
    at = place[lang.indices.to_numpy()] if len(lang) else np.zeros(0, np.int64)
    kind, n = found.column("kind").to_numpy(), found.column("n").to_numpy().astype(np.float64)
    of = at * (config.longest + 1) + kind
    sums = np.bincount(of, n, max(1, len(languages)) * (config.longest + 1))
    known, row = np.unique(found.column("entry").to_numpy().view(U), return_inverse=True)
    scores = np.full((len(known), len(languages)), config.penalty)
    scores[row, at] = np.maximum(config.penalty, np.log10(n / sums[of]))
    return Model.of(languages, [docs[x] / everything for x in languages], known, scores, config)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """documents with lang_pred and lang_score; the model travels as a broadcast, its size being bounded by the sample."""
    documents = documents.drop("lang_pred", "lang_score")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*documents.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index("text"))
            found = [x for group in _groups(col) for x in scorer.predict(group)]
            names = [*batch.schema.names, "lang_pred", "lang_score"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], names=names)

    return documents.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))
