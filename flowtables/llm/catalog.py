"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables.llm import anchors, decontaminate, hamming, importance, kdtree, minhash, mixing, quality, suffixes, surrogates, trainorder, warc, whitening
from flowtables.llm.common import read_table
from flowtables.llm.oracles import LLM_ORACLES  # noqa: F401
from flowtables.session import scratch_dir


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(read_table(spark, sf_dir, "documents")).drop("removed")


def op2_kdtree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.shards(read_table(spark, sf_dir, "documents"), leaves=40)


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(read_table(spark, sf_dir, "pages")))


def op4_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of every sequence, from the files written."""
    written = trainorder.materialise(read_table(spark, sf_dir, "documents"), scratch_dir(spark, "shards"), key=1, length=2048, per_shard=4096)
    return written.select("slot", "sequence", "shard", F.crc32("record").alias("crc32"))


def op6_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read_table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(read_table(spark, sf_dir, "documents"), secret="a key that the caller keeps").select("doc_id", "text", "n_entities")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every 50th vector, among all."""
    codes = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code"))
    return hamming.nearest(codes, codes.where("id % 50 = 0"), k=10)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the words of the benchmark."""
    docs, target = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return importance.resampled(docs, target, runs=1, buckets=10_000, percent=10, min_words=20, seed=2024).drop("n_words")


def op12_choleskyqr_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"), count=8)


def op13_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.without_repeats(read_table(spark, sf_dir, "documents"), window=35).drop("removed")


LLM_QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_kdtree_sharding, op3_warc_derivatives, op4_mil_quality, op5_training_order, op6_benchmark_containment,
    op7_pfair_mixing, op8_pii_surrogates, op9_minhash_near_dedup, op10_exact_topk,
    op11_importance_resampling, op12_choleskyqr_whitening, op13_anchor_dedup)}
