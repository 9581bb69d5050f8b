"""Importance resampling towards a target distribution of hashed n-grams.

Words and runs of words are hashed into buckets. What the target holds of a bucket
against what the corpus holds is the bucket's gain; a document weighs the mean gain
of its features. A fixed share of the documents is drawn without replacement by
Gumbel noise from a keyed hash of the id, so the draw can be repeated.

Texts are counted by batch, not one by one: the texts of a batch are joined with
separator sentinels, one pass of a regular expression finds all words, searchsorted
over the texts' offsets tells whose each word is, runs that cross two texts are
masked, and one bincount adds up the batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from flowtables.llm.common import id_text, ship_functions, stored, with_id

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
SENTINEL = b"\0"
BATCH_BYTES = 1 << 21  # a longer text is cut between words


class _Buckets(dict):
    """Bucket of each feature, remembered; emptied when it holds many."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        bucket = self[feature] = crc32(feature) % self.buckets
        return bucket


def _pieces(texts: list[bytes], runs: int, limit: int) -> Iterator[tuple[int, bytes, int]]:
    """(number of the text, piece, words it repeats from the piece before) of at most about ``limit`` bytes each."""
    for number, text in enumerate(texts):
        at, carried = 0, []
        while at < len(text) or not at:
            gap = NO_WORD.search(text, min(at + limit, len(text)))
            end = gap.start() if gap else len(text)
            piece = text[at:end]
            yield number, b" ".join([*carried, piece]), len(carried)
            at = max(end, 1)
            if runs > 1 and at < len(text):
                carried = [*carried, *WORD.findall(piece)][1 - runs :]


def batches(texts: list[bytes], runs: int, limit: int) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    numbers, parts, carried, size = [], [], [], 0
    for number, piece, words in _pieces(texts, runs, limit):
        if parts and size + len(piece) > limit:
            yield numbers, parts, carried
            numbers, parts, carried, size = [], [], [], 0
        numbers.append(number)
        parts.append(piece)
        carried.append(words)
        size += len(piece)
    if parts:
        yield numbers, parts, carried


def features(texts: list[bytes], runs: int, known: _Buckets, limit: int = BATCH_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(run length, text number of each feature, bucket of each feature), batch by batch."""
    for numbers, parts, carried in batches(texts, runs, limit):
        joined = SENTINEL.join(parts)
        offsets = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        starts, words = [], []
        for m in WORD.finditer(joined):
            starts.append(m.start())
            words.append(m.group())
        if not words:
            continue
        whose = np.searchsorted(offsets, np.array(starts), side="right") - 1
        place = np.arange(len(words)) - np.searchsorted(whose, np.arange(len(parts)))[whose]
        fresh = place >= np.array(carried)[whose]  # its last word is not one that an earlier piece had
        number = np.array(numbers)[whose]
        for run in range(1, runs + 1):
            last = np.arange(run - 1, len(words))
            if run == 1:
                buckets = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            else:
                grams = map(b" ".join, zip(*[islice(words, i, None) for i in range(run)], strict=False))
                buckets = np.fromiter(map(known.__getitem__, grams), np.int64, max(0, len(words) - run + 1))
            inside = fresh[last] & (whose[last] == whose[last - run + 1])
            yield run, number[last][inside], buckets[inside]


def _texts(column: pd.Series) -> list[bytes]:
    return [b"" if t is None else bytes(t).lower() for t in column]  # bytes.lower knows A-Z only


def bucket_counts(table: DataFrame, runs: int, buckets: int) -> DataFrame:
    """bucket, n: features of all texts of ``table`` (text); each task gives one row per bucket that it saw."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, known = np.zeros(buckets, np.int64), _Buckets(buckets)
        for frame in frames:
            for _, _, found in features(_texts(frame["data"]), runs, known):
                total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    data = table.select(F.col("text").cast("string").cast("binary").alias("data"))
    return data.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, rounded down, from the features in it; one more is counted everywhere."""
    buckets, s, t = len(corpus), corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, runs: int) -> DataFrame:
    """doc_id, n_words, n_features, weight: one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Buckets(len(sent.value))
        for frame in frames:
            n = len(frame)
            words, count, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for run, whose, found in features(_texts(frame["data"]), runs, known):
                here = np.bincount(whose, minlength=n)
                count += here
                if run == 1:
                    words += here
                np.add.at(total, whose, sent.value[found])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_words": words, "n_features": count, "weight": total // np.maximum(count, 1)})

    data = docs.select(id_text(), F.col("text").cast("string").cast("binary").alias("data"))
    return with_id(data.mapInPandas(weigh, "doc_id string, n_words long, n_features long, weight long"))


def resampled(
    docs: DataFrame, target: DataFrame, runs: int = 2, buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: one row per row of ``docs`` (doc_id, text).

    Of the documents with ``min_words`` words or more, the ``percent`` of highest score
    (rounded down) are drawn and ranked from 1, ties by smaller doc_id, null ids first;
    ``rank`` is null for the others. Features are runs of 1 to ``runs`` words.

    A null or empty text has no features and weight 0. Rows that repeat an id are documents
    of their own with the same noise; rows alike in score and id are ranked in any order. A null id
    is hashed as an empty one. Other columns are ignored. An empty target gives all
    buckets no count; an empty table gives an empty table. The driver holds two numbers per bucket.
    """
    corpus_n, target_n = (np.zeros(buckets, np.int64) for _ in range(2))
    for held, table in ((corpus_n, docs), (target_n, target)):
        for r in bucket_counts(table, runs, buckets).collect():  # one row per bucket
            held[r["bucket"]] = r["n"]
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = weighted(docs, gains(corpus_n, target_n), runs).withColumn("score", F.col("weight") + noise)
    return _ranked(stored(scored.withColumn("row", F.monotonically_increasing_id()), "scores"), percent, min_words)


def _ranked(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """Ranks of the drawn rows, from range partitions and their sizes; no task holds more than its range.

    Scores are whole thousandths of logarithms of counts, so there are some ten thousand
    different ones however large the corpus is; the row counts per score find the last one drawn.
    """
    able = F.col("n_words") >= min_words
    per_score = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    running = per_score.withColumn("upto", F.sum("n").over(Window.orderBy(F.col("score").desc()))).withColumn("all", F.sum("n").over(Window.partitionBy()))
    wanted = F.expr(f"all * {percent} div 100")
    last = running.where(wanted > 0).where(F.col("upto") >= wanted).agg(F.max("score").alias("score"), F.max(wanted).alias("k")).first()
    unranked = F.lit(None).cast("long").alias("rank")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    if last["k"] is None:
        return scored.select(*columns, unranked)
    high = able & (F.col("score") >= last["score"])
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("row").asc()]
    tasks = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stored(scored.where(high).repartitionByRange(tasks, *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = ranges.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    ranked = inside.join(F.broadcast(before), F.col("part") == F.col("of"))  # one row per task
    place = (F.col("before") + F.col("rank")).cast("long")
    ranked = ranked.select(*columns, F.when(place <= last["k"], place).alias("rank"))
    return ranked.unionByName(scored.where(~high).select(*columns, unranked))


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; options as in :func:`resampled`.

    Rows that repeat an id are drawn together: each draws for the id.
    """
    chosen = resampled(docs, target, **options).where("rank is not null").select("doc_id").distinct()
    kept = docs.alias("d").join(chosen.alias("c"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("c.doc_id")), "left_semi")
    return kept.select("d.*")


ship_functions(__name__)
