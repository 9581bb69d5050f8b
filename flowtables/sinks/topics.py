"""Topic frames: (topic, key, value) rows with a target partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.ordered import row_position

# --- fixed values -------------------------------------------------------------
ROUTES = ("RoundRobin", "Single", "Custom")
COMPRESSION = {"NONE": "none", "LZ4": "lz4", "ZLIB": "deflate"}
# ------------------------------------------------------------------------------


def topic_payload(df: DataFrame, topic: str | Column, value: str = "value", key: str | None = None) -> DataFrame:
    """Frame for a message writer. ``topic`` may differ from row to row."""
    name = topic if isinstance(topic, Column) else F.lit(topic)
    return df.select(
        name.cast("string").alias("topic"),
        (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
        F.col(value).alias("value"),
    )


def route(
    df: DataFrame, mode: str, partitions: int, pos: str | None = None, key: Column | None = None,
    width: int | None = None,
) -> DataFrame:
    """Add ``partition_id``.

    RoundRobin deals rows out in ``pos`` order, Single sends all to one
    partition, Custom uses an integer ``key`` modulo the number of partitions.
    """
    if mode not in ROUTES:
        raise ValueError(f"mode must be one of {ROUTES}: {mode!r}")
    if mode == "RoundRobin":
        if pos is None:
            raise ValueError("RoundRobin needs a position column")
        df = row_position(df, [], pos, "_n", width=width)
        return df.withColumn("partition_id", F.pmod("_n", F.lit(partitions)).cast("int")).drop("_n")
    if mode == "Single":
        return df.withColumn("partition_id", F.lit(0))
    if key is None:
        raise ValueError("Custom needs a key")
    return df.withColumn("partition_id", F.pmod(key.cast("long"), F.lit(partitions)).cast("int"))


def write_topic_files(df: DataFrame, path: str, compression: str = "NONE", partition_by: tuple[str, ...] = ("topic",)) -> None:
    """File form of a topic: JSON lines in one folder per topic (and partition).

    Rows are not moved first, so a topic of any size is written by every task
    that holds some of it.
    """
    df.write.mode("append").option("compression", COMPRESSION[compression]).partitionBy(*partition_by).json(path)


def write_kafka(df: DataFrame, servers: str, **options: str) -> None:
    """Send the frame to Kafka; needs the Spark Kafka package on the class path."""
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).options(**options).save()
