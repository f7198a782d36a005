"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audio, divergence, fim, lattice, licenses, merkle, neardup, packing, quality, tokenstore, toxicity, warc, webtext
from .common import read


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: Shingle length and similarity that the contract of this query fixes.
OP8_WORDS, OP8_PERCENT = 3, 85


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), OP8_WORDS, OP8_PERCENT)


OP8_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {OP8_WORDS} THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {OP8_PERCENT} * (a.n + b.n - count(*))),
m AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM m UNION SELECT r.a, m.b FROM r JOIN m ON r.b = m.a),
c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept FROM s LEFT JOIN c ON doc_id = a
"""


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.store_and_read(read(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.sample(read(spark, sf_dir, "documents"))


def op4_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.store_and_describe(read(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(read(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_edits(read(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(read(spark, sf_dir, "pages"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.cut_and_restore(read(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES = (
    op1_packing, op2_quality, op3_sentencepiece, op4_audio, op5_token_store, op6_warc, op7_toxicity, op8_near_duplicates,
    op9_fingerprints, op10_licenses, op11_main_text, op12_fill_in_middle, op13_source_divergence,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_warc": warc.ORACLE_SQL, "op8_near_duplicates": OP8_SQL, "op9_fingerprints": merkle.ORACLE_SQL,
        "op12_fill_in_middle": fim.ORACLE_SQL, "op13_source_divergence": divergence.ORACLE_SQL,
    }
