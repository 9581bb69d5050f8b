"""Folders written once per micro-batch: ``<root>/batch=<id>``.

A repeated batch overwrites its own folder only, so a restart changes nothing.
Only folders with a success marker count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch={batch_id}"


def complete_batches(spark: SparkSession, root: str) -> list[int]:
    """Ids of the complete folders, ascending. Reads folder names only."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/batch=*/_SUCCESS")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern)
    ids = [int(s.getPath().getParent().getName().split("=")[1]) for s in (found or [])]
    return sorted(ids)


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_path(root, batch_id))


def read_batches(spark: SparkSession, root: str, ids: list[int], schema) -> DataFrame:
    """Rows of the given folders with their ``batch`` id."""
    reader = spark.read.schema(schema).option("basePath", root)
    if not ids:
        return spark.createDataFrame([], schema)
    return reader.parquet(*[batch_path(root, i) for i in ids])


def remove_batches(spark: SparkSession, root: str, ids: list[int]) -> None:
    """Remove folders that a newer one replaces; the success marker goes first, so no half of one is ever read."""
    for i in ids:
        path = spark._jvm.org.apache.hadoop.fs.Path(batch_path(root, i))
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"), False)
        fs.delete(path, True)
