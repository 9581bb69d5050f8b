"""Audit of message numbers on a stream: as ``fix.sequence_gaps``, over batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from flowtables.functions.ordered import previous_value
from flowtables.streaming.keyed_store import Store, lookup, tidy, write_run
from flowtables.streaming.versions import write_batch


def start_sequence_audit(
    messages: DataFrame, session: Sequence[str], seq: str, out: str, state: str, checkpoint: str,
    pos: str | None = None, reset: Column | None = None, buckets: int = 64, fold_every: int = 20, trigger: dict | None = None,
) -> StreamingQuery:
    """Breaks in the numbering of each session, per batch into ``out/batch=<id>``: session, ``seq``, ``prev_seq``, ``missing``.

    Messages are in order of ``pos`` (``seq``) inside a batch; a later batch comes after an earlier one. The last
    number of each session is kept in a store below ``state``. ``missing`` counts the skipped numbers; -1 marks a repeated
    number, less a number that goes back. Where ``reset`` holds (a logon, say) numbering starts anew with the message's
    own number. Messages without a number are passed over; a session may be null.

    A session of any size is checked in parallel: only its last number is carried.
    """
    fields = [StructField(s, messages.schema[s].dataType) for s in session]
    store = Store(state, StructType([*fields, StructField("last", LongType())]), keys=tuple(session), order=(), op=None, buckets=buckets)
    number = F.col(seq).cast("long")

    def step(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        plain = rows.where(F.col(seq).isNotNull()).select(
            *session, number.alias("_number"), F.col(pos or seq).alias("_pos"), F.coalesce(reset if reset is not None else F.lit(False), F.lit(False)).alias("_reset"))
        new = plain.withColumn("_new", F.lit(1)).persist()
        try:
            old = lookup(store, new.select(*session), before=batch_id)
            # without a position the number carried over comes first in its session
            carried = old.select(*session, F.col("last").alias("_number"), F.lit(None).cast(new.schema["_pos"].dataType).alias("_pos"), F.lit(False).alias("_reset"), F.lit(0).alias("_new"))
            prev = previous_value(carried.unionByName(new), session, "_pos", "_number", "prev_seq", ties=("_new", "_number"))
            breaks = prev.where((F.col("_new") == 1) & ~F.col("_reset") & (F.col("_number") - F.col("prev_seq") != 1))
            write_batch(breaks.select(*session, F.col("_number").alias(seq), "prev_seq", (F.col("_number") - F.col("prev_seq") - 1).alias("missing")), out, batch_id)
            last = new.groupBy(*session).agg(F.max_by("_number", F.struct("_pos", "_number")).alias("last"))
            write_run(store, last, batch_id)
            tidy(spark, store, batch_id, fold_every)
        finally:
            new.unpersist()

    return (
        messages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
