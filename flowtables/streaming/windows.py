"""Window aggregates on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from flowtables.operators.snapshot import latest_by_key
from flowtables.operators.windows import hop_aggregate
from flowtables.streaming.versions import complete_batches, read_batches, write_batch


def start_closed_windows(
    events: DataFrame, out: str, checkpoint: str, groups: Sequence[str], watermark: str = "0 seconds",
    trigger: dict | None = None, **options,
) -> StreamingQuery:
    """Write each window once, after the watermark has passed its end."""
    result = hop_aggregate(events, groups, watermark=watermark, **options)
    return (
        result.writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def start_running_windows(
    events: DataFrame, out: str, checkpoint: str, groups: Sequence[str], watermark: str | None = None,
    trigger: dict | None = None, **options,
) -> StreamingQuery:
    """Write the new state of every window touched by a batch."""
    result = hop_aggregate(events, groups, watermark=watermark, **options)

    def step(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, out, batch_id)

    return (
        result.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_running_windows(spark: SparkSession, out: str, schema, groups: Sequence[str]) -> DataFrame:
    """Newest state of every window written by :func:`start_running_windows`."""
    rows = read_batches(spark, out, complete_batches(spark, out), schema.add("batch", "long"))
    return latest_by_key(rows, [*groups, "begin_date", "end_date"], "batch").drop("batch")
