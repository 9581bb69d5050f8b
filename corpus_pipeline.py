"""Corpus pipeline: quality, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``; the last adds the shard and the position in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowtables.llm import decontaminate, kdtree, minhash, mixing, quality
from flowtables.llm.common import read_table, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BLOCK_BYTES = 1 << 20
SHARD_BYTES = 4 << 20


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.accepted(docs.select(*COLUMNS), read_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 on five-word shingles)."""
    return minhash.without_near_duplicates(docs.select(*COLUMNS), percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which the sources are mixed to their weights."""
    return mixing.in_mixed_order(docs.select(*COLUMNS), block_bytes=BLOCK_BYTES)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard of about SHARD_BYTES and, as ``position``, their place in the mixture that the files are in."""
    placed = mixing.with_position(docs.select(*COLUMNS))
    return kdtree.with_shard(placed, SHARD_BYTES)


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("kdtree_sharding", sharding_stage),
]

ORACLE_SQL = None  # a learned score, a schedule and a tree of medians are not SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
