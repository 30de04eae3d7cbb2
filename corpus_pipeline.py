"""Corpus pipeline: documents to packed training sequences, in five stages.

Each stage works on all rows that its predecessor kept and is written as
Parquet and reread.  The first three filter documents, the fourth repeats
documents to meet the sources' targets, the last packs their tokens; all but
the last return the columns of ``documents`` (extra columns pass through).
Null, empty and very long texts, repeated rows and empty tables have the
results that the operators' modules state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from echolens.llm import mixing, near_dedup, packing, quality_classifier, quality_rules
from echolens.llm.base import table, write_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.filter_documents(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near_dedup.keep_one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the training sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [("quality_classifier", classify), ("quality_rules", rules), ("near_dedup", dedup), ("mixing", mix), ("packing", pack)]

# The classifier, the near duplicates' signatures, the random rounding and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
