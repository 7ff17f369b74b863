"""A training corpus from `documents`: stages of the llm operators, each over all rows that the one before kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame. `run` writes each result as Parquet to the shared folder
and reads it again as the next stage's docs; all but the last return the columns of documents.

Null, blank and short texts fail the quality rules; later stages take them as their operators state. Repeated rows stay once in the
near-duplicate stage. Empty tables give empty results of the same columns. Extra columns pass through to the last stage, which
gives token pieces; the operators' own helper columns never clash with them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from setstride.llm import decontaminate, near_join, packing, quality_rules, secrets
from setstride.llm.tables import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio stay."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays, the one with the smallest id."""
    return near_join.one_of_each(docs, near_join.Similarity(words=5, per_hundred=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, their secrets masked."""
    return secrets.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of at most 4096 tokens."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_masking", secret_masking),
    ("sequence_packing", sequence_packing),
]

#: The stages cannot be stated in SQL; tests/llm holds the operators behind them against brute force, and the stages against what each must keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
