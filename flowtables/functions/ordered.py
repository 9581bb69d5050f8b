"""Order-dependent columns that stay parallel inside one hot key.

A window partitioned by key alone puts a whole key into one task. The helpers
here cut every key into ranges of a numeric position first. A window then runs
over (key, range), and one summary row per (key, range) carries what must cross
a range border. The summary has ``rows / range`` rows, so its own window by key
stays small even when one key holds a third of the table.

By default the borders of the ranges are quantiles of the positions, so a range has
about ``RANGE_ROWS`` rows and never twice as many, however uneven the positions
are; rows that share one position stay in one range. Where positions are known to be even, ``width``
gives the length of a range in units of the position column and spares that pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

RANGE_ROWS = 1_000_000
MAX_RANGES = 10_000  # borders that are held; beyond it ranges have more rows

_SLOT = "_slot"
_CARRY = "_carry"


def fitting_width(df: DataFrame, pos: str, rows: int = RANGE_ROWS) -> int:
    """Length of a range that holds about ``rows`` rows if positions are even; reads the position column once."""
    found = df.agg(F.count(pos).alias("n"), F.min(pos).alias("low"), F.max(pos).alias("high")).first()
    if not found["n"]:
        return 1
    return max(1, -(-(int(found["high"]) - int(found["low"]) + 1) * rows // found["n"]))


def splitters(df: DataFrame, pos: str, rows: int = RANGE_ROWS) -> list[float]:
    """Inner borders of ranges of about ``rows`` rows: quantiles to within a quarter of a range, none if all rows fit one."""
    known = df.where(F.col(pos).isNotNull()).select(F.col(pos).cast("double").alias("p"))
    ranges = min(MAX_RANGES, -(-known.count() // rows))
    if ranges <= 1:
        return []
    return sorted(set(known.approxQuantile("p", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))


def _with_range(df: DataFrame, pos: str, borders: list[float]) -> DataFrame:
    """Add ``_range``, which a position's place among the borders gives by binary search; a null goes with the lowest."""
    if not borders:
        return df.withColumn("_range", F.lit(0.0))
    placed = df.withColumn("_place", F.coalesce(F.col(pos).cast("double"), F.lit(float("-inf"))))
    cut = Bucketizer(splits=[float("-inf"), *borders, float("inf")], inputCol="_place", outputCol="_range", handleInvalid="keep")
    return cut.transform(placed).drop("_place")


def _with_slot(df: DataFrame, keys: Sequence[str], pos: str, width: int | None) -> DataFrame:
    """Add the (keys, range) a row belongs to.

    One struct serves grouping, join and window, so the join leaves the rows
    where the window needs them; null keys are equal inside a struct.
    """
    if width is None:
        df, start = _with_range(df, pos, splitters(df, pos)), F.col("_range").alias("range")
    else:
        start = (F.col(pos) - F.pmod(F.col(pos), F.lit(width).cast("long"))).alias("range")
    return df.withColumn(_SLOT, F.struct(F.struct(*[F.col(k) for k in keys], F.lit(0).alias("all")).alias("key"), start)).drop("_range")


def _ranges(desc: bool = False) -> WindowSpec:
    order = F.col(f"{_SLOT}.range")
    return Window.partitionBy(f"{_SLOT}.key").orderBy(order.desc() if desc else order)


def _rows(pos: str, ties: Sequence[str], desc: bool = False) -> WindowSpec:
    cols = [F.col(c) for c in (pos, *ties)]
    return Window.partitionBy(_SLOT).orderBy(*[c.desc() if desc else c for c in cols])


def row_position(
    df: DataFrame, keys: Sequence[str], pos: str, name: str = "row_pos",
    ties: Sequence[str] = (), width: int | None = None,
) -> DataFrame:
    """Add the 0-based rank of each row inside its key, in position order."""
    slotted = _with_slot(df, keys, pos, width)
    before = _ranges().rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        slotted.groupBy(_SLOT).agg(F.count("*").alias("_n"))
        .select(_SLOT, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_CARRY))
    )
    rank = F.row_number().over(_rows(pos, ties))
    return slotted.join(carry, _SLOT).withColumn(name, F.col(_CARRY) + rank - 1).drop(_SLOT, _CARRY)


def previous_value(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, name: str,
    ties: Sequence[str] = (), width: int | None = None,
) -> DataFrame:
    """Add ``value`` of the row before, inside the key; null on the first row."""
    slotted = _with_slot(df, keys, pos, width)
    carry = (
        slotted.groupBy(_SLOT).agg(F.max_by(value, F.struct(pos, *ties)).alias("_last"))
        .select(_SLOT, F.lag("_last").over(_ranges()).alias(_CARRY))
    )
    inside = _rows(pos, ties)
    return (
        slotted.join(carry, _SLOT)
        .withColumn("_rn", F.row_number().over(inside))
        .withColumn(name, F.when(F.col("_rn") == 1, F.col(_CARRY)).otherwise(F.lag(value).over(inside)))
        .drop(_SLOT, _CARRY, "_rn")
    )


def next_value(
    df: DataFrame, keys: Sequence[str], pos: str, value: Column, name: str,
    ties: Sequence[str] = (), width: int | None = None,
) -> DataFrame:
    """Add the first non-null ``value`` at or after each row, inside the key.

    The running window goes backwards: a frame that grows from its start is
    linear, one that ends at the partition end is quadratic.
    """
    slotted = _with_slot(df.withColumn("_value", value), keys, pos, width)
    after = _ranges(desc=True).rowsBetween(Window.unboundedPreceding, -1)
    marked = F.when(F.col("_value").isNotNull(), F.struct(pos, *ties))
    carry = (
        slotted.groupBy(_SLOT).agg(F.min_by("_value", marked).alias("_first"))
        .select(_SLOT, F.last("_first", ignorenulls=True).over(after).alias(_CARRY))
    )
    inside = _rows(pos, ties, desc=True).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        slotted.join(carry, _SLOT)
        .withColumn(name, F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col(_CARRY)))
        .drop(_SLOT, _CARRY, "_value")
    )
