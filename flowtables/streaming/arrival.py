"""Windows over arrival time on a stream: a row counts from when it comes in, and no longer than a window.

All rows of a micro-batch arrive at the time that the clock gives for it. That time is
written down before anything else, so a batch that is repeated after a failure keeps
the time it had. A window is written once, by the first batch at or after its end; later
rows arrive later, so it is whole then. Groups without rows in a window give no row.

States are kept per group and pane, not per row, and panes that no open window
needs are let go: what is stored follows the groups seen within a window, not the age of
the stream. A group of any size is aggregated before it is shuffled.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from flowtables.operators.pane_aggregates import PANE, Aggregate, pane_states, window_results
from flowtables.operators.windows import HOP_SECONDS, WINDOW_SECONDS
from flowtables.streaming.panes import fold, read_states
from flowtables.streaming.versions import batch_path, complete_batches, remove_batches, write_batch

Clock = Callable[[DataFrame], float]


def system_clock(rows: DataFrame) -> float:
    return time.time()


def next_end(after: float, window: int, hop: int) -> int:
    """The first end of a window later than ``after`` (seconds)."""
    phase = 0 if hop > window else window % hop
    return phase + (int((after - phase) // hop) + 1) * hop


def _free_name(taken: Sequence[str]) -> str:
    name = "_beat"
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def with_beats(events: DataFrame, mark: str) -> DataFrame:
    """The events and one marked row a second without values, so that batches come when no event does."""
    beats = events.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]
    return events.withColumn(mark, F.lit(False)).unionByName(beats.select(*empty, F.lit(True).alias(mark)))


def _time_of(spark: SparkSession, root: str, batch_id: int) -> float:
    return spark.read.schema("seconds double").parquet(batch_path(root, batch_id)).first()["seconds"]


def start_arrival_windows(
    events: DataFrame, groups: Sequence[str], aggregates: Sequence[Aggregate], out: str, state: str, checkpoint: str,
    window: int = WINDOW_SECONDS, hop: int = HOP_SECONDS, clock: Clock = system_clock, separator: str = "",
    heartbeat: bool = False, fold_every: int = 20, trigger: dict | None = None,
) -> StreamingQuery:
    """Write the windows that end at or before a batch's time and after that of the batch before to ``out/batch=<id>``.

    Rows are as :func:`window_results` gives them. ``clock`` gives the seconds since the epoch at which a batch
    arrives; a time before that of an earlier batch counts as that. The aggregates see the events' own columns. A batch that
    ends no window writes nothing; with ``heartbeat`` there is a batch at least every second (or every trigger), so
    windows end on time without events. States are folded every ``fold_every`` batches.
    """
    mark = _free_name(events.columns)
    source = with_beats(events, mark) if heartbeat else events
    clocks, panes = f"{state}/clock", f"{state}/panes"

    def arrival(rows: DataFrame, batch_id: int) -> tuple[float | None, float]:
        """Time of the batch before, if any, and of this batch."""
        spark = rows.sparkSession
        known = complete_batches(spark, clocks)
        earlier = [b for b in known if b < batch_id][-1:]
        before = _time_of(spark, clocks, earlier[0]) if earlier else None
        if batch_id in known:
            return before, _time_of(spark, clocks, batch_id)
        now = float(clock(rows))
        now = now if before is None else max(now, before)
        write_batch(spark.range(1).select(F.lit(now).alias("seconds")), clocks, batch_id)
        # the one before stays: a repeat of this batch asks for it
        remove_batches(spark, clocks, [b for b in known if b < batch_id and b not in earlier])
        return before, now

    def step(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        if heartbeat:
            rows = rows.where(~F.col(mark)).drop(mark)
        before, now = arrival(rows, batch_id)
        oldest = None if before is None else next_end(before, window, hop) - window
        if oldest is not None and batch_id % fold_every == 0:
            fold(spark, panes, groups, aggregates, keep_from=oldest)
        stamp = _free_name(rows.columns)
        stamped = rows.withColumn(stamp, F.timestamp_seconds(F.lit(now)))
        write_batch(pane_states(stamped, groups, aggregates, window, hop, stamp), f"{panes}/delta", batch_id)
        if before is not None and next_end(before, window, hop) <= now:
            states = read_states(spark, panes).where(F.col(PANE) >= oldest)
            write_batch(window_results(states, groups, aggregates, window, hop, separator, ends=(before, now)), out, batch_id)

    return (
        source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ({"processingTime": "1 second"} if heartbeat else {"availableNow": True}))).start()
    )
