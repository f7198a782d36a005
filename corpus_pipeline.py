"""Corpus pipeline: quality, toxicity, near-duplicates, packing. Each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import neardup, packing, quality, toxicity
from sluice.llm.common import read, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model is fitted on labelled rows of `documents`.

    Null text is scored as the empty text; repeated rows stay or go together; an empty table stays empty; all columns
    are kept, whatever their names.
    """
    model = quality.fit_model(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, "__quality")
    return scored.filter(F.col("__quality") >= quality.THRESHOLD).select(*docs.columns)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the model is fitted on labelled rows of `documents`.

    Nulls, empty and repeated rows and other columns as for quality.
    """
    model = toxicity.fit_model(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, "__toxicity")
    return scored.filter(F.col("__toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, five-word shingles at a similarity of 0.8 or more.

    The smallest doc_id of a group stays. Rows without text or words, and rows without an id, are no one's duplicates and
    stay; rows that repeat the id that stays all stay.
    """
    return neardup.deduplicate(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one piece of the end id; repeated rows are packed each; a null id is kept; an empty table gives
    no piece.
    """
    return packing.pack_documents(docs)


STAGES = [("quality", keep_quality), ("toxicity", keep_civil), ("near_duplicates", keep_one_of_each), ("packing", pack_windows)]

#: Compression, learned weights and token ids are beyond SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
