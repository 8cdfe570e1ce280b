"""A training-data pipeline over ``documents``: from raw texts to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All
but the last return documents with their columns unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, exact_dedup, jaccard, language, packing
from millrace.llm.tables import stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; it is fitted on labelled documents of the input."""
    return language.keep_known(docs, language.train(docs, F.lit(True)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity, the one with the smallest id."""
    return jaccard.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left and their places in sequences."""
    return packing.pack_pieces(packing.cut_pieces(docs, TOKENIZER))


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("decontaminate", benchmark_leaks),
    ("packing", packed),
]

#: Alignment, a trained model and packing aren't SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
