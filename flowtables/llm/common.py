"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowtables.session import scratch_dir


def ship_functions(module_name: str) -> None:
    """Send the functions of a module to Python workers by value.

    Workers need not find this package on their path; only numpy, pandas and
    pyarrow must be installed there.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def id_text(name: str = "doc_id") -> Column:
    """An id for a Python task. As a number it would become a double, and large ones rounded, wherever a null is among them."""
    return F.col(name).cast("long").cast("string").alias(name)


def with_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """``df`` with :func:`id_text` undone."""
    return df.withColumn(name, F.col(name).cast("long"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to a new folder of the shared scratch folder and read that.

    Cuts the lineage and fixes the rows, so that two branches over the result
    see the same ones even after an executor is lost.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, unlike ``lower``."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space, in order; empty for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", -1)
    return F.filter(parts, lambda w: w != "")


def bucketed_rank(df: DataFrame, groups: list[str], order: list[str], rows_per_bucket: int = 200_000,
                  weight: str | None = None) -> DataFrame:
    """Add ``_rank``: gapless from 0 in each group, in an order fixed by hash.

    A group is cut into hash buckets of about ``rows_per_bucket`` rows, so that
    no task sorts a whole group; the buckets' sizes are then added up. The
    order is by (hash bucket, ``order``); ``order`` should tell rows apart, and
    rows equal in it may swap places. With ``weight`` also adds
    ``_before``, the sum of the weight of the rows that come first.
    """
    total = df.count()
    buckets = max(1, -(-total // rows_per_bucket))
    key = F.xxhash64(*order)
    # one struct serves grouping, window and join, so the join leaves the rows where the window needs them; null keys are equal inside it
    place = F.struct(F.struct(*groups, F.lit(0).alias("_one")).alias("of"), F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"))
    rows = df.withColumn("_place", place)
    amount = F.col(weight).cast("long") if weight else F.lit(0).cast("long")
    sizes = rows.groupBy("_place").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_w"))
    earlier = Window.partitionBy("_place.of").orderBy("_place.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_place",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"),
        F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_place").orderBy(key, *order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_row", F.row_number().over(within) - 1)
    if weight:
        ranked = ranked.withColumn("_sum", F.coalesce(F.sum(amount).over(before), F.lit(0)))
    extra = [(F.col("_sum") + F.col("_base")).alias("_before")] if weight else []
    return ranked.join(offsets, "_place").select(*df.columns, (F.col("_row") + F.col("_first")).cast("long").alias("_rank"), *extra)


BLOOM_BITS = 2**26  # at most; 8 MB


def may_contain(df: DataFrame, column: str) -> Callable[[Column], Column]:
    """A test that is true for every hash in ``column`` (long) of ``df``, and false for most others.

    A Bloom filter of bounded size, built by an aggregate and sent to the Python
    workers. It saves shuffling rows that a join would drop anyway. Beyond the
    bound it lets more pass; results never depend on it.
    """
    spark = df.sparkSession
    bits = min(BLOOM_BITS, 1 << max(10, (16 * df.count()).bit_length()))
    h = F.col(column)
    places = F.array(*[F.expr(f"cast((({column} & 2147483647) + {i} * ((shiftrightunsigned({column}, 31) & 2147483647) | 1)) % {bits} as int)") for i in range(4)])
    words = df.where(h.isNotNull()).select(F.explode(places).alias("p")).select(F.expr("p div 64").cast("int").alias("w"), F.expr("shiftleft(1L, p % 64)").alias("b"))
    table = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    filled = np.zeros(bits // 64, np.uint64)
    filled[table["w"].to_numpy()] = table["b"].to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(filled)

    def test(values: pd.Series) -> pd.Series:
        v, words_of = values.fillna(0).to_numpy(np.int64), sent.value
        ok = values.notna().to_numpy()
        low, step = v & 0x7FFFFFFF, v >> 31 & 0x7FFFFFFF | 1
        for i in range(4):
            p = (low + i * step) % (len(words_of) * 64)
            ok &= (words_of[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
        return pd.Series(ok)

    return lambda value: F.pandas_udf(test, "boolean")(value)


ship_functions(__name__)
