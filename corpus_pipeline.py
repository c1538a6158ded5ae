"""A corpus made ready for training: language, exact copies, near copies, benchmark leaks, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from layerwright.llm import bpe, decontaminate, exact_dedup, langid, minhash
from layerwright.session import cut_lineage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, by a model learned from the labelled ones among them."""
    return langid.known_rows(docs, langid.train(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.unique_rows(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles of similarity 0.8 or more.

    Candidates come from the fingerprints of ``op6`` and from bands; all are verified on whole sets.
    """
    return minhash.first_rows(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of its tokens, and digests of the ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language", known_language),
    ("exact_copies", without_copies),
    ("near_copies", without_near_copies),
    ("benchmark_leaks", without_leaks),
    ("tokens", tokens),
]

#: SQL can express neither the language model, nor components of near copies, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
