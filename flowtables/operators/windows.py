"""Sum, count and average per group over tumbling, hopping and sampled windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowtables.functions.text import WINDOW_BOUND_FORMAT

# --- fixed values -------------------------------------------------------------
AGGREGATIONS = ("sum", "count", "avg")
WINDOW_SECONDS = 300
HOP_SECONDS = 60
# ------------------------------------------------------------------------------

def aggregation_id(groups: Sequence[str], separator: str = "") -> Column:
    """Base64 of the group values joined by ``separator``.

    Without a separator the groups (1, 12) and (11, 2) get the same id.
    """
    texts = [F.coalesce(F.col(g).cast("string"), F.lit("null")) for g in groups]
    return F.base64(F.encode(F.concat_ws(separator, *texts), "UTF-8"))


def _check(how: str, fields: Sequence[str], window: int, hop: int) -> None:
    if how not in AGGREGATIONS:
        raise ValueError(f"aggregation must be one of {AGGREGATIONS}: {how!r}")
    if how != "count" and not fields:
        raise ValueError(f"{how} needs at least one field")
    if window <= 0 or hop <= 0:
        raise ValueError("window and hop are positive numbers of seconds")


def _amount(df: DataFrame, field: str) -> Column:
    """A field as what it is added up as: whole numbers and decimals exactly, all else as doubles."""
    kind = df.schema[field].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(field)
    return F.col(field).cast("decimal(38,0)" if isinstance(kind, T.IntegralType) else "double")


def _partials(df: DataFrame, how: str, fields: Sequence[str]) -> dict[str, Column]:
    """Parts that can be added up again: sums, and counts of non-null values."""
    parts: dict[str, Column] = {}
    if not fields:
        parts["_rows"] = F.count("*")
    for f in fields:
        parts[f"_s_{f}"] = F.sum(_amount(df, f))
        if how == "avg":
            parts[f"_n_{f}"] = F.count(f)
    return parts


def _results(how: str, fields: Sequence[str]) -> list[Column]:
    if not fields:
        return [F.col("_rows").alias("count")]
    if how == "count":
        # count with fields is a weighted count; the last field gives the weight
        return [F.col(f"_s_{fields[-1]}").alias("count")]
    if how == "sum":
        return [F.col(f"_s_{f}").alias(f"{f}_sum") for f in fields]
    return [
        (F.col(f"_s_{f}").cast("double") / F.when(F.col(f"_n_{f}") > 0, F.col(f"_n_{f}"))).alias(f"{f}_avg")
        for f in fields
    ]


def hop_aggregate(
    df: DataFrame,
    groups: Sequence[str],
    fields: Sequence[str] = (),
    how: str = "sum",
    window: int = WINDOW_SECONDS,
    hop: int = HOP_SECONDS,
    time_col: str | None = "ts",
    watermark: str | None = None,
    start_time: str | None = None,
    panes: bool | None = None,
    null_as_text: bool = False,
    separator: str = "",
) -> DataFrame:
    """Aggregate per group and window of ``window`` seconds, every ``hop`` seconds.

    ``hop == window`` tumbles, ``hop < window`` overlaps, ``hop > window`` looks
    only at the last ``window`` seconds of each hop. Sums keep the kind of their
    field: decimals and whole numbers are exact, text is read as a double.
    Windows are closed at their
    begin and open at their end. ``time_col=None`` stamps events on arrival. On a
    stream, ``watermark`` bounds the state and closes windows.

    ``panes`` (batch, window a multiple of hop): aggregate hop-wide panes first
    and expand those instead of the rows. Default: on for batch input.
    """
    _check(how, fields, window, hop)
    if time_col is None:
        time_col = "_arrival"
        df = df.withColumn(time_col, F.current_timestamp())
    if watermark is not None:
        df = df.withWatermark(time_col, watermark)
    if panes is None:
        panes = not df.isStreaming
    keys = [
        (F.coalesce(F.col(g).cast("string"), F.lit("null")) if null_as_text else F.col(g).cast("string")).alias(g)
        for g in groups
    ]
    parts = _partials(df, how, fields)
    aggs = [c.alias(n) for n, c in parts.items()]
    start = start_time or "0 seconds"

    if hop > window:
        slot = F.window(time_col, f"{hop} seconds", startTime=start)
        out = (
            df.withColumn("_w", slot)
            .where(F.col(time_col) >= F.col("_w.end") - _seconds(window))
            .groupBy("_w", *keys).agg(*aggs)
        )
        begin, end = F.col("_w.end") - _seconds(window), F.col("_w.end")
    elif panes and window > hop and window % hop == 0:
        pane = F.window(time_col, f"{hop} seconds", startTime=start)
        per_pane = df.groupBy(pane.alias("_w"), *keys).agg(*aggs)
        shifts = F.array(*[F.lit(i * hop) for i in range(window // hop)])
        out = (
            per_pane.withColumn("_shift", F.explode(shifts))
            .withColumn("_begin", F.col("_w.start") - F.make_dt_interval(secs=F.col("_shift")))
            .groupBy("_begin", *groups)
            .agg(*[F.sum(n).alias(n) for n in parts])
        )
        begin, end = F.col("_begin"), F.col("_begin") + _seconds(window)
    else:
        slide = F.window(time_col, f"{window} seconds", f"{hop} seconds", start)
        out = df.groupBy(slide.alias("_w"), *keys).agg(*aggs)
        begin, end = F.col("_w.start"), F.col("_w.end")

    return out.select(
        *groups,
        *_results(how, fields),
        F.date_format(begin, WINDOW_BOUND_FORMAT).alias("begin_date"),
        F.date_format(end, WINDOW_BOUND_FORMAT).alias("end_date"),
        aggregation_id(groups, separator).alias("aggregation_id"),
    )


def _seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))
