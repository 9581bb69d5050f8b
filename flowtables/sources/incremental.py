"""Incremental reading of a table by a growing integer id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# --- fixed values: outcomes of a listener step --------------------------------
EXECUTABLE = "executable"
NOT_EXECUTABLE = "nonExecutable"
ERROR = "error"
# ------------------------------------------------------------------------------


def plan_batch(
    df: DataFrame, id_col: str, partition_size: int, offset: int | None = None, start_index: int | None = None,
) -> DataFrame:
    """One row that says what to read next.

    Start is the saved ``offset``, else ``start_index``, else the largest id
    minus ``partition_size``. Columns: outcome, reason, max_index (before the
    batch size is applied), start_index, from_id, to_id, next_offset.
    """
    top = df.agg(F.max(id_col).cast("long").alias("max_index"))
    given = offset if offset is not None else start_index
    first = F.lit(given).cast("long") if given is not None else F.col("max_index") - partition_size
    planned = top.withColumn("start_index", first)
    mx, st = F.col("max_index"), F.col("start_index")
    ready = mx > st
    upper = F.when(ready, F.least(mx, st + partition_size))
    return planned.select(
        F.when(mx.isNull() | (mx < st), ERROR).when(mx == st, NOT_EXECUTABLE).otherwise(EXECUTABLE).alias("outcome"),
        F.when(mx.isNull(), "maxIndex == null").when(mx < st, "maxIndex < startIndex")
        .when(mx == st, "maxIndex == startIndex").alias("reason"),
        mx.alias("max_index"),
        st.alias("start_index"),
        F.when(ready, st + 1).alias("from_id"),
        upper.alias("to_id"),
        F.coalesce(upper, st).alias("next_offset"),
    )


def read_batch(df: DataFrame, id_col: str, partition_size: int, offset: int | None = None, start_index: int | None = None) -> DataFrame:
    """Rows of the planned id range; no rows when there is nothing to do.

    The range bounds are scalar subqueries, so the scan still gets a range filter.
    """
    plan = plan_batch(df, id_col, partition_size, offset, start_index)
    low, high = plan.select("from_id").scalar(), plan.select("to_id").scalar()
    return df.where((F.col(id_col) >= low) & (F.col(id_col) <= high))


@dataclass
class Step:
    outcome: str
    reason: str | None
    offset: int | None
    rows: DataFrame | None


def read_offset(spark: SparkSession, path: str) -> int | None:
    """Saved offset of a listener; None before the first step."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.schema("next_offset long").json(path).agg(F.max("next_offset")).first()[0]


def save_offset(spark: SparkSession, path: str, offset: int) -> None:
    """Add the offset to its log; the largest one counts."""
    spark.range(1).select(F.lit(offset).cast("long").alias("next_offset")).coalesce(1).write.mode("append").json(path)


def next_step(spark: SparkSession, df: DataFrame, id_col: str, partition_size: int, offsets: str, start_index: int | None = None) -> Step:
    """One step of the listener; call it on a schedule.

    The caller writes ``rows`` and then saves ``offset``, so a failed step is
    repeated and nothing is lost.
    """
    plan = plan_batch(df, id_col, partition_size, read_offset(spark, offsets), start_index).first()
    rows = None
    if plan.outcome == EXECUTABLE:
        rows = df.where(F.col(id_col).between(plan.from_id, plan.to_id))
    return Step(plan.outcome, plan.reason, plan.next_offset, rows)
