"""The caller's window aggregates on a stream, from pane states kept in a table.

Each micro-batch adds the states of its own rows: its cost follows the batch, and late
rows of any age count. Readers merge what there is. ``fold`` merges all batches into
one base, removes what the base replaces, and can let old panes go, so neither
the folder nor the number of files grows with the age of the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from flowtables.operators.pane_aggregates import PANE, Aggregate, merge_states, pane_states, window_results
from flowtables.streaming.versions import batch_path, complete_batches, read_batches, remove_batches, write_batch


def start_pane_states(
    events: DataFrame, root: str, checkpoint: str, groups: Sequence[str], aggregates: Sequence[Aggregate],
    trigger: dict | None = None, **windows,
) -> StreamingQuery:
    """Add the pane states of each micro-batch to ``root``; ``windows`` are window, hop and time_col."""
    def step(rows: DataFrame, batch_id: int) -> None:
        write_batch(pane_states(rows, groups, aggregates, **windows), f"{root}/delta", batch_id)

    return (
        events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_states(spark: SparkSession, root: str) -> DataFrame | None:
    """Newest base and the batches after it; a pane may be in several rows. None before the first batch."""
    bases = complete_batches(spark, f"{root}/base")[-1:]
    live = [b for b in complete_batches(spark, f"{root}/delta") if not bases or b > bases[0]]
    if not bases and not live:
        return None
    newest = batch_path(f"{root}/delta", live[-1]) if live else batch_path(f"{root}/base", bases[0])
    schema = spark.read.parquet(newest).schema
    parts = [read_batches(spark, f"{root}/{kind}", ids, schema).select(*schema.names) for kind, ids in (("base", bases), ("delta", live)) if ids]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_windows(
    spark: SparkSession, root: str, groups: Sequence[str], aggregates: Sequence[Aggregate], window: int, hop: int, separator: str = "",
) -> DataFrame | None:
    """All windows as of the last complete micro-batch, as :func:`window_results` gives them."""
    states = read_states(spark, root)
    return None if states is None else window_results(states, groups, aggregates, window, hop, separator)


def fold(
    spark: SparkSession, root: str, groups: Sequence[str], aggregates: Sequence[Aggregate], keep_from: int | None = None,
) -> int | None:
    """Merge everything into a new base and remove what it replaces; returns the last batch in it.

    ``keep_from`` (seconds) lets panes that begin earlier go. Call it between runs of the stream or beside it: a batch
    that comes meanwhile is newer than the base. The old parts are removed after the new base is complete, so a
    failure on the way leaves the states whole; run it again then. Without a new batch nothing is done but that removal.
    """
    deltas = complete_batches(spark, f"{root}/delta")
    bases = complete_batches(spark, f"{root}/base")
    upto = max([*deltas[-1:], *bases[-1:]], default=None)
    if upto is None:
        return None
    if upto not in bases:
        states = merge_states(read_states(spark, root), groups, aggregates)
        if keep_from is not None:
            states = states.where(F.col(PANE) >= keep_from)
        write_batch(states, f"{root}/base", upto)
    remove_batches(spark, f"{root}/delta", [b for b in deltas if b <= upto])
    remove_batches(spark, f"{root}/base", [b for b in bases if b < upto])
    return upto
