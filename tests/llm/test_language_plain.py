"""Language identification, fit and prediction, against a plain version over whole tables."""

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from aerolith.llm import language

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def grams(word, n):
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def plain_fit(rows, longest=5):
    counts = defaultdict(Counter)  # (lang, kind)
    docs = Counter(lang for _, lang in rows)
    for text, lang in rows:
        for w in words(text):
            counts[lang, 0][w] += 1
            for n in range(1, longest + 1):
                for g in grams(w, n):
                    counts[lang, n][g] += 1
    return docs, counts


def plain_predict(text, docs, counts, longest=5, penalty=-7.0):
    languages = sorted(docs)
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    per_word = []
    for w in words(text):
        for n in (0, *range(longest, 0, -1)):
            known = [g for g in ([w] if n == 0 else grams(w, n)) if any(g in counts[x, n] for x in languages)]
            if known:
                of = lambda x, g: max(penalty, math.log10(counts[x, n][g] / sum(counts[x, n].values()))) if g in counts[x, n] else penalty  # noqa: E731, B023
                per_word.append([sum(of(x, g) for g in known) / len(known) for x in languages])
                break
    if not per_word:
        best = max(languages, key=lambda x: docs[x])
        return best, docs[best] / sum(docs.values())
    mean = [sum(x) / len(per_word) for x in zip(*per_word, strict=True)]
    best = max(range(len(languages)), key=lambda k: mean[k])
    return languages[best], 1 / sum(10 ** ((m - mean[best]) * min(len(per_word), 10)) for m in mean)


def test_fit_and_prediction_equal_a_plain_version(spark):
    sf = spark.read.parquet(f"{SF}/documents.parquet").withColumn("h", language.held_out(F.col("doc_id"), 5))
    rows = sf.filter("lang is not null and text is not null").select("doc_id", "text", "lang", "h").collect()
    few = sorted((r for r in rows if not r.h), key=lambda r: len(r.text))[:60]
    labelled = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in few], "doc_id long, text string, lang string")
    docs, counts = plain_fit([(r.text, r.lang) for r in few])
    ask = [r.text for r in sorted(rows, key=lambda r: len(r.text))[:120]] + [None, "", "12 ²", "ꙮ", "q" * 300, "日本語"]
    asked = spark.createDataFrame(list(enumerate(ask)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in language.predict(asked, language.fit(labelled)).collect()}
    for i, text in enumerate(ask):
        lang, score = plain_predict(text, docs, counts)
        assert got[i][0] == lang and abs(got[i][1] - score) < 1e-9, (i, text, got[i], lang, score)


def test_sample_is_bounded_for_each_language(spark):
    rows = [(i, "same text", "hot") for i in range(3000)] + [(i, f"word{i}", "cold") for i in range(20)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn, docs = language.sample(labelled, language.LanguageConfig(sample_docs=100))
    n = Counter(r.lang for r in drawn.collect())
    assert docs == {"hot": 3000, "cold": 20} and n["cold"] == 20 and 60 <= n["hot"] <= 140
