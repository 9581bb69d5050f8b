"""Topics held as an ordered log table: topic, msg_id, payload."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

BATCH_MESSAGES = 100


def read_from(
    df: DataFrame, topic: str, position: int | None = None, initial: int | None = None, max_messages: int = BATCH_MESSAGES,
) -> DataFrame:
    """Next messages of one topic after a position, in order. Each topic has a position of its own.

    The saved ``position`` is exclusive; without one, ``initial`` is used
    (exclusive too); without both, reading starts at the earliest message.
    """
    start = position if position is not None else initial
    df = df.where(F.col("topic") == topic)
    if start is not None:
        df = df.where(F.col("msg_id") > start)
    return df.orderBy("msg_id").limit(max_messages).withColumn("message_id", message_id(F.col("msg_id")))


def next_position(read: DataFrame, position: int | None) -> DataFrame:
    """One row ``position``: last id read; unchanged when nothing was read."""
    return read.agg(F.coalesce(F.max("msg_id"), F.lit(position).cast("long")).alias("position"))


def message_id(col):
    """Message id as base64 text."""
    return F.base64(F.encode(col.cast("string"), "UTF-8"))


def subscribe(df: DataFrame, topics: str | None = None, pattern: str | None = None) -> DataFrame:
    """Non-empty messages of a topic list or of all topics matching a pattern.

    ``topics`` is separated by commas or blanks. Exactly one of the two is given;
    a pattern must match the whole topic name.
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or pattern")
    if topics is not None:
        names = [t for t in re.split(r"[,\s]+", topics) if t]
        if not names:
            raise ValueError("the topic list is empty")
        chosen = F.col("topic").isin(*names)
    else:
        chosen = F.col("topic").rlike(f"^(?:{pattern})$")
    return df.where(chosen & (F.length("payload") > 0)).withColumn("message_id", message_id(F.col("msg_id")))


def read_kafka_stream(spark, servers: str, topics: str | None = None, pattern: str | None = None, **options: str) -> DataFrame:
    """Live subscription; needs the Spark Kafka package on the class path."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or pattern")
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).options(**options)
    reader = reader.option("subscribe", topics) if topics else reader.option("subscribePattern", pattern)
    return reader.load()
