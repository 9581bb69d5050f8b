"""Commit gate on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from flowtables.operators.gate import decide
from flowtables.sources.changelog import COMMIT_CODE, ROLLBACK_CODE
from flowtables.streaming.versions import batch_path, complete_batches, write_batch


def start_committed(
    stream: DataFrame, out: str, pending: str, checkpoint: str, trigger: dict | None = None, **options,
) -> StreamingQuery:
    """Release committed changes batch by batch into ``out/batch=<id>``.

    Changes of undecided transactions wait in ``pending`` until a later batch
    decides them. Every batch is the batch operator over the waiting rows and the
    new ones, so a huge transaction is spread over tasks like in a batch job, and
    a lost executor only repeats tasks.
    """
    def step(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        earlier = [i for i in complete_batches(spark, pending) if i < batch_id]
        if earlier:
            waiting = spark.read.schema(rows.schema).parquet(batch_path(pending, earlier[-1]))
            rows = waiting.unionByName(rows)
        is_change = ~F.col("operation_code").isin(COMMIT_CODE, ROLLBACK_CODE)
        decided = decide(rows, **options).where(is_change).persist()
        try:
            released = decided.where(F.col("decision.code") == COMMIT_CODE)
            write_batch(released.withColumn("commit_scn", F.col("decision.scn")).drop("decision"), out, batch_id)
            write_batch(decided.where(F.col("decision").isNull()).drop("decision"), pending, batch_id)
        finally:
            decided.unpersist()

    return (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
