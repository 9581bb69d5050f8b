"""Database tables through JDBC. The driver jar comes from the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_query(
    spark: SparkSession, url: str, query: str, session_statements: Sequence[str] = (), fetch_size: int = 1000,
    timeout: int = 300, **options: str,
) -> DataFrame:
    """Result of a source query. ``session_statements`` run first on each connection."""
    reader = (
        spark.read.format("jdbc").option("url", url).option("query", query)
        .option("fetchsize", fetch_size).option("queryTimeout", timeout).options(**options)
    )
    if session_statements:
        reader = reader.option("sessionInitStatement", ";".join(session_statements))
    return reader.load()


def read_table(
    spark: SparkSession, url: str, table: str, id_col: str, low: int, high: int, partitions: int,
    session_statements: Sequence[str] = (), **options: str,
) -> DataFrame:
    """A large table in parallel: one id range per task."""
    reader = (
        spark.read.format("jdbc").option("url", url).option("dbtable", table)
        .option("partitionColumn", id_col).option("lowerBound", low).option("upperBound", high)
        .option("numPartitions", partitions).options(**options)
    )
    if session_statements:
        reader = reader.option("sessionInitStatement", ";".join(session_statements))
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**options).mode(mode).save()
