"""Snapshot kept up to date by a stream of keyed changes.

Each micro-batch adds one delta folder with the last change per key; its cost
follows the size of the batch, not of the snapshot. Readers merge base and
deltas. ``compact`` folds the deltas into a new base when it is called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowtables.operators.snapshot import KEYS, latest_by_key, merge_snapshot
from flowtables.streaming.versions import complete_batches, read_batches, write_batch


def start_apply(
    changes: DataFrame, root: str, checkpoint: str, keys: Sequence[str] = KEYS, seq: str = "seq",
    trigger: dict | None = None,
) -> StreamingQuery:
    def step(rows: DataFrame, batch_id: int) -> None:
        write_batch(latest_by_key(rows, keys, seq), f"{root}/delta", batch_id)

    return (
        changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_snapshot(
    spark: SparkSession, root: str, schema, keys: Sequence[str] = KEYS, seq: str = "seq", op: str = "operation",
    upto: int | None = None,
) -> DataFrame:
    """Current rows: newest base plus the deltas after it."""
    bases = [b for b in complete_batches(spark, f"{root}/base") if upto is None or b <= upto]
    base_id = bases[-1] if bases else -1
    live = [d for d in complete_batches(spark, f"{root}/delta") if d > base_id and (upto is None or d <= upto)]
    base = read_batches(spark, f"{root}/base", bases[-1:], schema).select(*schema.names)
    deltas = read_batches(spark, f"{root}/delta", live, schema).select(*schema.names)
    return merge_snapshot(base, deltas, keys, seq, op)


def compact(spark: SparkSession, root: str, schema, **options) -> int | None:
    """Write the current rows as a new base; returns its batch id."""
    deltas = complete_batches(spark, f"{root}/delta")
    if not deltas:
        return None
    upto = deltas[-1]
    if upto not in complete_batches(spark, f"{root}/base"):
        write_batch(read_snapshot(spark, root, schema, upto=upto, **options), f"{root}/base", upto)
    return upto
