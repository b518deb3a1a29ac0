"""A training corpus from ``documents``: quality rules, exact deduplication,
near-deduplication, mixing to target weights, packing into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``, rows unchanged; the last returns the
packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wafercast.llm import exact_dedup, mixing, near_dedup, packing, quality
from wafercast.llm.common import read_table, shared_table
from wafercast.llm.token_counts import vocabulary_path

#: The mix of the pipeline: nine tenths of the tokens, no document twice.
MIX = mixing.Mix(budget_permille=900, max_epochs=1)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original (then smallest doc_id) stays."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return near_dedup.keep_one(docs, k=5, threshold=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fill the sources' token budgets stay."""
    return mixing.keep_mix(docs, MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per packed piece."""
    return packing.pack(docs, vocabulary_path())


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix),
          ("packing", pack)]

#: Token ids, MinHash and the packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
