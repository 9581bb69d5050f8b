"""Keyed documents as files, and path deletion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: compression names and the writer option they stand for -----
COMPRESSION = {
    "NONE": "none", "DEFAULT": "deflate", "BZIP": "bzip2", "GZIP": "gzip",
    "LZ4": "lz4", "SNAPPY": "snappy",
}
# ------------------------------------------------------------------------------


def write_documents(df: DataFrame, path: str, compression: str = "NONE", mode: str = "errorifexists") -> None:
    """Documents as JSON lines; the folder is created when missing."""
    df.write.mode(mode).option("compression", COMPRESSION[compression]).json(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all below it; False when there was none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
