"""Bundling of messages by count, size and time, and splitting of contents."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.ordered import row_position

# --- fixed values: default limits ---------------------------------------------
BUNDLE_RECORDS = 100
BUNDLE_MESSAGES = 100
BUNDLE_BYTES = 10_485_760
# ------------------------------------------------------------------------------


def _join_bundle(record: str, demarcator: str) -> Column:
    """Records of one bundle in order, each followed by the demarcator."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_pos", record))), lambda x: x[record])
    return F.concat(F.array_join(ordered, demarcator, ""), F.lit(demarcator))


def bundle_by_count(
    df: DataFrame, keys: Sequence[str], pos: str, record: str, size: int = BUNDLE_RECORDS,
    demarcator: str = "\n", dense: bool = False, width: int | None = None, also: Sequence[Column] = (),
) -> DataFrame:
    """Bundles of ``size`` records per key, in order; the last may be smaller. ``also``: further aggregates of a bundle.

    ``dense`` says that ``pos`` already counts 0, 1, 2, .. inside each key. A
    bundle holds at most ``size`` records, so no group grows with the data.
    """
    if dense:
        numbered = df.withColumn("_pos", F.col(pos).cast("long"))
    else:
        numbered = row_position(df, keys, pos, "_pos", width=width)
    return (
        numbered.withColumn("bundle", F.floor(F.col("_pos") / size).cast("long"))
        .groupBy(*keys, "bundle")
        .agg(F.count("*").alias("records"), _join_bundle(record, demarcator).alias("content"), *also)
    )


def split_messages(df: DataFrame, content: str, demarcator: str) -> DataFrame:
    """One row per section between demarcators, with its 0-based ``pos``."""
    sections = F.split(F.col(content), r"\Q" + demarcator + r"\E")
    keep = [c for c in df.columns if c != content]
    return df.select(*keep, F.posexplode(sections).alias("pos", "message"))


# ---- greedy bundles -----------------------------------------------------------
#
# Where a greedy bundle ends depends on where it started, so the rule looks
# sequential. It is still parallel: no bundle is longer than ``messages``, so the
# first bundle that starts inside a chunk of messages starts at one of the first
# ``messages`` positions. Each chunk works out, for every such entry, at which
# entry of the next chunk the bundles come out. Only these small maps are then
# followed from chunk to chunk, and each chunk marks its own bundle starts.


def _ends(sizes: np.ndarray, times: np.ndarray | None, messages: int, nbytes: int, seconds: float | None) -> np.ndarray:
    """For each message: index of the first message after a bundle starting there."""
    n = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    index = np.arange(n)
    # last message that keeps the bundle within the byte limit
    fit = np.searchsorted(total, total[:-1] + nbytes, side="right") - 1
    end = np.minimum(fit, index + messages)
    if times is not None and seconds is not None:
        end = np.minimum(end, np.searchsorted(times, times + seconds, side="left"))
    return np.maximum(end, index + 1)  # a single larger message is its own bundle


def bundle_greedy(
    df: DataFrame, keys: Sequence[str], pos: str, size: str, messages: int = BUNDLE_MESSAGES,
    nbytes: int = BUNDLE_BYTES, seconds: float | None = None, time: str | None = None,
    chunk: int = 1_000_000, width: int | None = None, ties: Sequence[str] = (),
) -> DataFrame:
    """Add ``bundle_start``: position (in the key) of the first message of the bundle.

    A bundle takes messages in order as long as it holds at most ``messages``
    messages and ``nbytes`` bytes and, if ``seconds`` is given, spans less than
    that from its first ``time``. A message above the byte limit stands alone.
    ``size`` names the column with the message size. ``time``, when used, must
    not decrease in position order. Messages with one position are ordered by
    ``ties``; those that ``ties`` does not tell apart follow one another in any order.
    """
    if chunk < messages:
        raise ValueError("a chunk holds at least one bundle")
    key_text = F.to_json(F.struct(*keys)) if keys else F.lit("")
    stamp = (F.unix_micros(F.col(time).cast("timestamp")) / 1e6) if time else F.lit(None).cast("double")
    ranked = row_position(df.withColumn("_key", key_text), ["_key"], pos, "_pos", ties=ties, width=width)
    slim = ranked.select("_key", "_pos", F.col(size).cast("long").alias("_size"), stamp.alias("_time"))
    slim = slim.withColumn("_chunk", F.floor(F.col("_pos") / chunk).cast("long"))
    # a chunk also sees the head of the next one: bundles may cross the border
    borders = slim.where(F.col("_pos") % chunk < messages).where("_chunk > 0").withColumn("_chunk", F.col("_chunk") - 1)
    seen = slim.unionByName(borders)

    def entry_map(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        own = _own_rows(pdf, chunk)
        end = _chunk_ends(pdf, messages, nbytes, seconds)
        at = np.arange(min(own, messages))  # all entries step together
        while (inside := at < own).any():
            at[inside] = end[at[inside]]
        head = pdf[["_key", "_chunk"]].iloc[:1]
        return head.assign(_exits=[(at - own).tolist()])

    maps = seen.groupBy("_key", "_chunk").applyInPandas(entry_map, "_key string, _chunk long, _exits array<int>")

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        entries, entry = [], 0
        for exits in pdf["_exits"]:
            entries.append(entry)
            # only the last chunk can be shorter than one bundle
            entry = int(exits[entry]) if entry < len(exits) else 0
        return pdf[["_key", "_chunk"]].assign(_entry=entries)

    entries = maps.groupBy("_key").applyInPandas(follow, "_key string, _chunk long, _entry int")

    def mark(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        pdf = left.sort_values("_pos")
        own = _own_rows(pdf, chunk)
        end = _chunk_ends(pdf, messages, nbytes, seconds)
        positions = pdf["_pos"].to_numpy()
        starts = np.full(len(pdf), -1, dtype=np.int64)
        i = int(right["_entry"].iloc[0])
        while i < own:
            starts[i : end[i]] = positions[i]
            i = int(end[i])
        # rows left at -1 belong to a bundle that another chunk marks
        out = pdf[["_key"]].assign(position=positions, bundle_start=starts)
        return out[out["bundle_start"] >= 0]

    marked = (
        seen.groupBy("_key", "_chunk")
        .cogroup(entries.groupBy("_key", "_chunk"))
        .applyInPandas(mark, "_key string, position long, bundle_start long")
    )
    numbered = ranked.withColumnRenamed("_pos", "position")
    return numbered.join(marked, ["_key", "position"]).select(*df.columns, "position", "bundle_start")


def _own_rows(pdf: pd.DataFrame, chunk: int) -> int:
    c = int(pdf["_chunk"].iloc[0])
    return int((pdf["_pos"] < (c + 1) * chunk).sum())


def _chunk_ends(pdf: pd.DataFrame, messages: int, nbytes: int, seconds: float | None) -> np.ndarray:
    times = pdf["_time"].to_numpy(dtype=float) if seconds is not None else None
    return _ends(pdf["_size"].to_numpy(dtype=np.int64), times, messages, nbytes, seconds)


# workers get these functions by value and need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
