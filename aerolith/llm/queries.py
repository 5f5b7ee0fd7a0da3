"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixity, language, mixing, neardup, packing, quality, repeats, scoring, secrets, topk
from .common import spread, table

LANGUAGE_FOLDS = 5
SCORING_FOLDS = 10


def op1_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).withColumn("held_out", language.held_out(F.col("doc_id"), LANGUAGE_FOLDS))
    model = language.fit(documents.filter("not held_out and text is not null and lang is not null").select("doc_id", "text", "lang"))
    return language.predict(documents.drop("lang"), model).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))


def op5_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.audit_pages(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), public_tokenizers.path("byte_bpe_50k.json"))


def packing_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction data, where limits on examples and loss-bearing tokens bind."""
    return packing.pack_conversations(spread(table(spark, sf_dir, "conversations")), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("failed_rule")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), language.held_out(F.col("doc_id"), SCORING_FOLDS))


QUERIES = {
    "op1_neardup": op1_neardup,
    "op2_language": op2_language,
    "op3_secrets": op3_secrets,
    "op4_mixing": op4_mixing,
    "op5_fixity": op5_fixity,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_repeats": op8_repeats,
    "op9_topk": op9_topk,
    "op10_scoring": op10_scoring,
    "packing_conversations": packing_conversations,
}

#: DuckDB's SQL for those that SQL can express over whole tables.
ORACLES: dict[str, str] = {
    "op5_fixity": r"""
        WITH r AS (
            SELECT page_id, coalesce(CAST(page_id AS VARCHAR), '') AS id,
                   'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
                   || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
                   || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
                   || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
            FROM pages
        ), d AS (
            SELECT page_id, CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % greatest(1, CAST(ceil((SELECT count(*) FROM pages) / 1024.0) AS BIGINT)) AS archive,
                   CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest,
                   CAST('0x' || substr(md5(id), 9, 8) AS BIGINT) % 97 <> 0
                   OR CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % greatest(1, CAST(ceil((SELECT count(*) FROM pages) / 1024.0) AS BIGINT)) % 4 <> 0 AS intact
            FROM r
        )
        SELECT page_id, archive,
               CAST(sum(length) OVER (PARTITION BY archive ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS "offset",
               length, digest, intact
        FROM d
    """,
    "op7_quality": r"""
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (
            SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM t
        ), g AS (
            SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 4], ' ')) AS n
            FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
        ), c AS (
            SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM g WHERE n > 1) GROUP BY r
        ), m AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                   CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
                   len(l) AS n_lines, len(regexp_extract_all(t, '!')) AS n_marks,
                   len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '\p{Ll}')) AS n_lower
            FROM w LEFT JOIN c USING (r)
        ), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR n_symbols * 10 > n_words OR n_dup_lines * 2 > n_lines OR word_chars < n_words * 2
                    OR word_chars > n_words * 12 OR n_marks * 2 > n_words OR n_upper * 3 > (n_upper + n_lower) * 2) AS kept
        FROM b
    """,
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
            WHERE a.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
