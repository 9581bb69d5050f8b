"""Keyed documents and snapshots kept up to date by changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from flowtables.functions.documents import document

KEYS = ("database", "table_name", "row_id")


def to_documents(events: DataFrame) -> DataFrame:
    """Change events as (database, table_name, row_id, seq, operation, doc).

    ``operation`` is ``delete`` or ``insert``; ``doc`` is the flat JSON document.
    """
    return events.select(
        *KEYS,
        F.col("seq").cast("long").alias("seq"),
        F.when(F.col("type") == "delete", "delete").otherwise("insert").alias("operation"),
        document(F.col("columns")).alias("doc"),
    )


def latest_by_key(df: DataFrame, keys: Sequence[str] = KEYS, seq: str = "seq") -> DataFrame:
    """Last change of every key.

    The rank filter is also applied before the shuffle, so a hot key sends one
    row per task.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(seq).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def is_delete(op: str = "operation"):
    return F.lower(op) == "delete"


def merge_snapshot(
    current: DataFrame, changes: DataFrame, keys: Sequence[str] = KEYS, seq: str = "seq", op: str = "operation",
) -> DataFrame:
    """Snapshot after ``changes``: one row per key, deleted keys gone.

    Of a key's rows, snapshot and changes, the one of highest ``seq`` counts, so
    a repeated or late change undoes nothing; a change goes before a snapshot row
    of the same ``seq``. Deletes of absent keys do nothing. Parts of keys may be null. The
    snapshot and the changes meet in one shuffle, of one row per key and task.
    """
    columns = current.columns
    old = current.withColumns({"_new": F.lit(0), "_gone": F.lit(False)})
    new = changes.withColumns({"_new": F.lit(1), "_gone": F.coalesce(is_delete(op), F.lit(False))})
    rows = old.unionByName(new.select(*old.columns))
    w = Window.partitionBy(*keys).orderBy(F.col(seq).desc_nulls_last(), F.col("_new").desc())
    last = rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1 and not _gone")
    return last.select(*columns)
