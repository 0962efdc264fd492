"""The corpus pipeline: raw documents to token ids in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``, so a lost executor costs
at most one stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudmart.llm import decontam, exact_dedup, language_id, near_dedup, sentencepiece_codec
from fraudmart.llm.shared import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a language of at least even odds."""
    return language_id.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.keep_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the smallest id stays."""
    return near_dedup.keep_one(docs, n=5, share=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip, n_differing``."""
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: tokenization and language models have no SQL form; tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
