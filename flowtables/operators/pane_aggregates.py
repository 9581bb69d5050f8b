"""Any list of aggregates over hopping windows, as states that can be merged.

Events are aggregated once, into panes: stretches of time that lie in or out of
every window as a whole. A pane's states are merged into each window that it
belongs to, so an event is read once however many windows overlap. States can be
stored and merged later too, which is how ``streaming/panes.py`` uses them.

An :class:`Aggregate` names its states; the functions below make the common ones, and
callers can write their own from any aggregates that merge.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.text import WINDOW_BOUND_FORMAT
from flowtables.operators.windows import HOP_SECONDS, WINDOW_SECONDS, aggregation_id

PANE = "pane_start"


@dataclass(frozen=True)
class Aggregate:
    """``states``: an aggregate of rows and one that merges its results, per state; ``result`` reads the merged states in that order."""

    name: str
    states: Sequence[tuple[Column, Callable[[Column], Column]]]
    result: Callable[..., Column]

    def columns(self) -> list[str]:
        return [f"_{self.name}_{i}" for i in range(len(self.states))]

    def over_rows(self) -> list[Column]:
        return [made.alias(c) for c, (made, _) in zip(self.columns(), self.states, strict=True)]

    def merged(self) -> list[Column]:
        return [merge(F.col(c)).alias(c) for c, (_, merge) in zip(self.columns(), self.states, strict=True)]

    def value(self) -> Column:
        return self.result(*[F.col(c) for c in self.columns()]).alias(self.name)


def _itself(state: Column) -> Column:
    return state


def total(name: str, value: Column) -> Aggregate:
    """Sum of the non-null values; null without any."""
    return Aggregate(name, [(F.sum(value), F.sum)], _itself)


def count(name: str, value: Column | None = None) -> Aggregate:
    """Rows, or non-null values."""
    return Aggregate(name, [(F.count(F.lit(1) if value is None else value), F.sum)], _itself)


def mean(name: str, value: Column) -> Aggregate:
    return Aggregate(name, [(F.sum(value.cast("double")), F.sum), (F.count(value), F.sum)], lambda s, n: s / F.when(n > 0, n))


def least(name: str, value: Column) -> Aggregate:
    return Aggregate(name, [(F.min(value), F.min)], _itself)


def greatest(name: str, value: Column) -> Aggregate:
    return Aggregate(name, [(F.max(value), F.max)], _itself)


def first(name: str, value: Column, *order: Column) -> Aggregate:
    """The value that comes first by ``order``; of rows alike in it the smallest value."""
    return Aggregate(name, [(F.min(F.struct(*order, value.alias("_value"))), F.min)], lambda s: s["_value"])


def last(name: str, value: Column, *order: Column) -> Aggregate:
    """The value that comes last by ``order``; of rows alike in it the largest value."""
    return Aggregate(name, [(F.max(F.struct(*order, value.alias("_value"))), F.max)], lambda s: s["_value"])


def distinct(name: str, value: Column, lg_k: int = 12) -> Aggregate:
    """About how many different values: a sketch of at most 2 ** lg_k registers, relative error about 0.8 / sqrt(2 ** lg_k).

    Exact, but for rare collisions, while there are few values. ``value`` is a whole number, text or binary.
    """
    return Aggregate(name, [(F.hll_sketch_agg(value, lg_k), F.hll_union_agg)], F.hll_sketch_estimate)


def quantile(name: str, value: Column, rank: float, k: int = 200) -> Aggregate:
    """A value whose rank is ``rank`` (0 to 1) to within about 1.65 / k, from a sketch of bounded size; null without values."""
    made = F.kll_sketch_agg_double(value.cast("double"), F.lit(k))
    some = (F.count(value), F.sum)
    return Aggregate(name, [(made, F.kll_merge_agg_double), some], lambda s, n: F.when(n > 0, F.kll_sketch_get_quantile_double(s, F.lit(float(rank)))))


def _seconds(time: Column) -> Column:
    return F.floor(F.unix_micros(time.cast("timestamp")) / F.lit(1_000_000)).cast("long")


def _floored(seconds: Column, step: int) -> Column:
    return seconds - F.pmod(seconds, F.lit(step).cast("long"))


def _check(aggregates: Sequence[Aggregate], window: int, hop: int) -> None:
    names = [a.name for a in aggregates]
    if not names or len(set(names)) < len(names):
        raise ValueError("give one aggregate or more, each with a name of its own")
    if window <= 0 or hop <= 0:
        raise ValueError("window and hop are positive numbers of seconds")


def pane_states(
    df: DataFrame, groups: Sequence[str], aggregates: Sequence[Aggregate],
    window: int = WINDOW_SECONDS, hop: int = HOP_SECONDS, time_col: str = "ts",
) -> DataFrame:
    """Groups, ``pane_start`` (seconds) and the states of every pane that has rows.

    Panes are as long as the greatest common divisor of window and hop. Of a hop longer than the
    window only its last ``window`` seconds count. Rows without a time are left out; null is a group.
    """
    _check(aggregates, window, hop)
    at = _seconds(F.col(time_col))
    width = gcd(window, hop)
    rows = df.where(F.col(time_col).isNotNull())
    if hop > window:
        rows = rows.where(F.pmod(at, F.lit(hop).cast("long")) >= hop - window)
    keys = [F.col(g).cast("string").alias(g) for g in groups]
    return rows.groupBy(*keys, _floored(at, width).alias(PANE)).agg(*[s for a in aggregates for s in a.over_rows()])


def merge_states(states: DataFrame, groups: Sequence[str], aggregates: Sequence[Aggregate]) -> DataFrame:
    """One row per group and pane, from states of any number of parts of the input."""
    return states.groupBy(*groups, PANE).agg(*[s for a in aggregates for s in a.merged()])


def window_results(
    states: DataFrame, groups: Sequence[str], aggregates: Sequence[Aggregate],
    window: int = WINDOW_SECONDS, hop: int = HOP_SECONDS, separator: str = "", ends: tuple[float, float] | None = None,
) -> DataFrame:
    """Groups, one column per aggregate, begin_date, end_date, aggregation_id: a row per group and window with rows.

    A pane may be in several rows of ``states``. Windows begin at multiples of ``hop`` seconds, or end there if hops are
    longer than windows; they are closed at their begin and open at their end. ``ends`` (seconds) takes
    only windows that end after the first and not after the second.
    """
    _check(aggregates, window, hop)
    width = gcd(window, hop)
    pane = F.col(PANE)
    latest = _floored(pane, hop) + (hop - window if hop > window else 0)
    begins = F.transform(F.sequence(F.lit(0), F.lit(max(0, -(-window // hop) - 1))), lambda i: latest - i * hop)
    inside = F.filter(begins, lambda b: (b <= pane) & (b + window >= pane + width))
    if ends is not None:
        inside = F.filter(inside, lambda b: (b + window > F.lit(ends[0])) & (b + window <= F.lit(ends[1])))
    merged = (
        states.withColumn("_begin", F.explode(inside)).groupBy(*groups, "_begin")
        .agg(*[s for a in aggregates for s in a.merged()])
    )
    bound = lambda seconds: F.date_format(F.timestamp_seconds(seconds), WINDOW_BOUND_FORMAT)
    return merged.select(
        *groups, *[a.value() for a in aggregates],
        bound(F.col("_begin")).alias("begin_date"), bound(F.col("_begin") + window).alias("end_date"),
        aggregation_id(groups, separator).alias("aggregation_id"),
    )


def hop_aggregate_by(
    df: DataFrame, groups: Sequence[str], aggregates: Sequence[Aggregate],
    window: int = WINDOW_SECONDS, hop: int = HOP_SECONDS, time_col: str = "ts", separator: str = "",
) -> DataFrame:
    """The caller's aggregates per group and window of ``window`` seconds, every ``hop`` seconds."""
    states = pane_states(df, groups, aggregates, window, hop, time_col)
    return window_results(states, groups, aggregates, window, hop, separator)
