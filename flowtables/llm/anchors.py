"""Repeated runs of words, found from fixed blocks as anchors.

A document's words are cut into blocks of half a window, one after the other. Any
window covers one block of its document whole, so a window that repeats has its block
somewhere else too, at any offset.

1. Index and probe. The blocks are the index; every rolling run of a block's length
   probes it. Both go by hash to buckets, a few bytes each, and a task first merges
   what it sees, so a passage that is everywhere arrives once per batch of words.
2. Hits. The blocks that a second run meets go back to their documents. Documents
   with a hit, one of each text, are put into packs that every later step reads alike.
3. Extension. Each hit is extended over all windows through its block; a digest
   of the whole window's words tells whether the extension holds at a second
   place. A pack asks about each different window once and is answered by one bit.
   Neighbouring windows that hold make the maximal repeat.

Groups are never paired: an anchor with a million places costs its places.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from flowtables.llm.common import id_text, may_contain, ship_functions, stored, with_id

BATCH_WORDS = 1 << 21  # merged before they are sent
BUCKET_WORDS = 1 << 20  # about so many probes or windows to a bucket
PACK_WORDS = 1 << 19
SLICE = 1 << 20
LOW = 40  # bits of a hash that are sent; the others are the bucket
DIGEST = 12  # bytes of a window's digest

BLANKS = bytes(32 if 9 <= b <= 13 else b for b in range(256))
VALUES = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], np.uint64)
BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 16), np.uint64(base))
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def normalised(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and where each begins and ends."""
    joined = re.sub(rb"  +", b" ", text.translate(BLANKS)).strip(b" ")
    if not joined:
        return b"", np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return joined, np.concatenate([[0], gaps + 1]), np.append(gaps, len(joined))


def word_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, side="right")))
        first, last = int(starts[at]), int(ends[stop - 1])
        up, down = powers(last - first + 1)
        total = np.zeros(last - first + 1, np.uint64)
        np.cumsum(VALUES[np.frombuffer(joined, np.uint8, last - first, first)] * up[:-1], out=total[1:])
        out[at:stop] = mixed((total[ends[at:stop] - first] - total[starts[at:stop] - first]) * down[starts[at:stop] - first])
        at = stop
    return out


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    out = np.empty(max(0, len(words) - width + 1), np.uint64)
    for at in range(0, len(out), SLICE):
        part = words[at : at + SLICE + width - 1]
        up, down = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:-1], out=total[1:])
        out[at : at + SLICE] = mixed((total[width:] - total[:-width]) * down[: len(part) - width + 1])
    return out


def as_keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and low bits of hashes in one number."""
    return ((h >> np.uint64(LOW)) % np.uint64(buckets) << np.uint64(LOW)) | (h & np.uint64((1 << LOW) - 1))


def _packed(low: np.ndarray) -> bytes:
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : LOW // 8].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, LOW // 8)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, : LOW // 8] = raw
    return out.view("<u8").ravel()


def _grouped(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each group of equal values, and its size."""
    first = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return first, np.diff(np.append(first, len(sorted_values)))


KINDS = ["once", "once_block", "twice", "twice_block"]  # met once or more in the batch; 1: as a block


def _probes(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """bucket and one binary column per kind: hashes of all rolling runs of a batch, each once."""
    block = (window + 1) // 2

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def merged() -> pd.DataFrame:
            marked = np.sort(np.concatenate(held))
            keys = marked >> np.uint64(1)
            first, count = _grouped(keys)
            kind = np.bitwise_or.reduceat(marked & np.uint64(1), first).astype(np.int64) + 2 * (count > 1)
            keys = keys[first]
            bucket = (keys >> np.uint64(LOW)).astype(np.int64)
            low = keys & np.uint64((1 << LOW) - 1)
            rows = []
            ends = np.searchsorted(bucket, np.arange(buckets), side="right")
            for b, (i, j) in enumerate(zip(np.append(0, ends[:-1]), ends, strict=True)):
                if i < j:
                    rows.append((b, *[_packed(low[i:j][kind[i:j] == k]) for k in range(4)]))
            return pd.DataFrame(rows, columns=["bucket", *KINDS])

        for frame in frames:
            for data in frame["data"]:
                joined, starts, ends = normalised(data)
                if len(starts) < window:
                    continue
                runs = as_keys(rolling(word_hashes(joined, starts, ends), block), buckets) << np.uint64(1)
                runs[::block] |= np.uint64(1)
                for at in range(0, len(runs), BATCH_WORDS):
                    held.append(runs[at : at + BATCH_WORDS])
                    size += len(held[-1])
                    if size >= BATCH_WORDS:
                        yield merged()
                        held, size = [], 0
        if held:
            yield merged()

    return docs.select("data").mapInPandas(work, "bucket int, " + ", ".join(f"{k} binary" for k in KINDS))


def _met_twice(probes: DataFrame) -> DataFrame:
    """key: blocks that two or more runs meet, of which the block itself is one."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        marked = [_unpacked(data) << np.uint64(2) | np.uint64(k) for k, name in enumerate(KINDS) for data in frame[name]]
        marked = np.sort(np.concatenate(marked))
        keys = marked >> np.uint64(2)
        first, count = _grouped(keys)
        kind = np.bitwise_or.reduceat(marked & np.uint64(3), first).astype(np.int64)
        found = keys[first][(kind & 1 > 0) & ((count > 1) | (kind & 2 > 0))]
        return pd.DataFrame({"key": found.astype(np.int64) | int(frame["bucket"].iloc[0]) << LOW})

    return probes.groupBy("bucket").applyInPandas(work, "key long")


def _blocks(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """near_mark, key: the blocks of each document that has a window."""
    block = (window + 1) // 2

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 500):
                marks, keys = [], []
                for mark, data in zip(frame["near_mark"][at : at + 500], frame["data"][at : at + 500], strict=True):
                    joined, starts, ends = normalised(data)
                    if len(starts) >= window:
                        keys.append(np.unique(as_keys(rolling(word_hashes(joined, starts, ends), block)[::block], buckets)))
                        marks.append(np.full(len(keys[-1]), mark, np.int64))
                if keys:
                    yield pd.DataFrame({"near_mark": np.concatenate(marks), "key": np.concatenate(keys).astype(np.int64)})

    return docs.select("near_mark", "data").mapInPandas(work, "near_mark long, key long")


def _packs(texts: DataFrame) -> DataFrame:
    """pack, body: texts (mark, data, copies, keys) in binary bodies of about ``PACK_WORDS``; once stored, every step sees the same ones."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0

        def body() -> pd.DataFrame:
            name = xxhash.xxh128_hexdigest(b"".join(h[0] for h in held))
            return pd.DataFrame({"pack": [name], "body": [pickle.dumps(held, 5)]})

        for frame in frames:
            for mark, data, copies, keys in zip(frame["mark"], frame["data"], frame["copies"], frame["keys"], strict=True):
                held.append((bytes(mark), bytes(data), int(copies), np.sort(np.asarray(keys, np.int64))))
                size += len(data) // 6 + 1
                if size >= PACK_WORDS:
                    yield body()
                    held, size = [], 0
        if held:
            yield body()

    return texts.select("mark", "data", "copies", "keys").mapInPandas(work, "pack string, body binary")


class Asked:
    """The windows through hits of one pack: per text, and as different digests in order of bucket."""

    def __init__(self, body: bytes, window: int, buckets: int, window_buckets: int) -> None:
        block = (window + 1) // 2
        self.texts = []
        digests = []
        for mark, data, copies, keys in pickle.loads(body):
            joined, starts, ends = normalised(data)
            hits = np.isin(as_keys(rolling(word_hashes(joined, starts, ends), block)[::block], buckets).astype(np.int64), keys)
            places = np.arange(len(starts) - window + 1)
            places = places[hits[-(-places // block)]]
            self.texts.append((mark, copies, joined, starts, ends, places))
            for at in range(0, len(places), 65536):
                some = places[at : at + 65536]
                digests.append(b"".join([xxhash.xxh128_digest(joined[a:b])[:DIGEST] for a, b in zip(starts[some].tolist(), ends[some + window - 1].tolist(), strict=True)]))
        raw = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, DIGEST)
        high = np.ascontiguousarray(raw[:, :8]).view("<u8").ravel()
        low = np.ascontiguousarray(raw[:, 8:]).view("<u4").ravel()
        bucket = (high % np.uint64(window_buckets)).astype(np.int64)
        order = np.lexsort((low, high, bucket))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
        first = np.flatnonzero(fresh)
        self.number = np.empty(len(order), np.int64)  # which different window each window is
        self.number[order] = np.cumsum(fresh) - 1
        self.digests, self.bucket = raw[order[first]], bucket[order[first]]
        self.twice = np.diff(np.append(first, len(order))) > 1


def _questions(packs: DataFrame, window: int, buckets: int, window_buckets: int) -> DataFrame:
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for pack, body in zip(frame["pack"], frame["body"], strict=True):
                asked = Asked(body, window, buckets, window_buckets)
                first, count = _grouped(asked.bucket) if len(asked.bucket) else ([], [])
                rows = [(int(asked.bucket[i]), pack, asked.digests[i : i + n].tobytes(), np.packbits(asked.twice[i : i + n]).tobytes()) for i, n in zip(first, count, strict=True)]
                yield pd.DataFrame(rows, columns=["bucket", "pack", "digests", "twice"])

    return packs.mapInPandas(work, "bucket int, pack string, digests binary, twice binary")


def _answers(questions: DataFrame) -> DataFrame:
    """pack, bucket, held: a bit for each digest that was asked, set if the window has a second place."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        raw = np.frombuffer(b"".join(frame["digests"]), np.uint8).reshape(-1, DIGEST)
        sizes = np.array([len(d) // DIGEST for d in frame["digests"]])
        twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(frame["twice"], sizes, strict=True)]).astype(bool)
        high = np.ascontiguousarray(raw[:, :8]).view("<u8").ravel()
        low = np.ascontiguousarray(raw[:, 8:]).view("<u4").ravel()
        order = np.lexsort((low, high))
        same = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        ends = np.cumsum(sizes)
        held = [np.packbits(twice[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)]
        return pd.DataFrame({"pack": frame["pack"], "bucket": frame["bucket"], "size": sizes, "held": held})

    return questions.groupBy("bucket").applyInPandas(work, "pack string, bucket int, size int, held binary")


SPANS = "array<struct<start: long, end: long>>"


def _cut(packs: DataFrame, window: int, buckets: int, window_buckets: int) -> DataFrame:
    """mark, n_removed, kept_sha256, removed of each text, from packs with their ``answers``."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for body, answers in zip(frame["body"], frame["answers"], strict=True):
                asked = Asked(body, window, buckets, window_buckets)
                listed = sorted(answers, key=lambda a: a["bucket"]) if answers is not None else []
                held = [np.unpackbits(np.frombuffer(a["held"], np.uint8), count=a["size"]) for a in listed]
                held = np.concatenate([np.empty(0, np.uint8), *held]).astype(bool) | asked.twice
                rows, at = [], 0
                for mark, copies, joined, starts, ends, places in asked.texts:
                    gone = places if copies > 1 else places[held[asked.number[at : at + len(places)]]]
                    at += len(places)
                    step = np.zeros(len(starts) + 1, np.int64)
                    step[gone] += 1
                    step[gone + window] -= 1
                    covered = np.cumsum(step[:-1]) > 0
                    edge = np.diff(np.pad(covered.astype(np.int8), 1))
                    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    keep = zip(np.append(0, last), np.append(first, len(starts)), strict=True)
                    kept = b" ".join([joined[starts[i] : ends[j - 1]] for i, j in keep if i < j])
                    spans = [{"start": int(i), "end": int(j)} for i, j in zip(first, last, strict=True)]
                    rows.append((mark, int(covered.sum()), hashlib.sha256(kept).hexdigest(), spans))
                yield pd.DataFrame(rows, columns=["mark", "n_removed", "kept_sha256", "removed"])

    return packs.mapInPandas(work, f"mark binary, n_removed long, kept_sha256 string, removed {SPANS}")


def _whole(docs: DataFrame) -> DataFrame:
    """doc_id, mark, n_words, all_sha256 of each document."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for data in frame["data"]:
                joined = normalised(data)[0]
                rows.append((joined.count(b" ") + 1 if joined else 0, hashlib.sha256(joined).hexdigest()))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "mark": frame["mark"], "n_words": [r[0] for r in rows], "all_sha256": [r[1] for r in rows]})

    return with_id(docs.select(id_text(), "mark", "data").mapInPandas(work, "doc_id string, mark binary, n_words long, all_sha256 string"))


def _buckets(n: int | None) -> int:
    return 1 << max(0, (n or 0) // BUCKET_WORDS).bit_length()


def _mark(data: Column) -> Column:
    return F.substring(F.unhex(F.sha2(data, 256)), 1, 16)


def without_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, removed: one row per row of ``docs`` (doc_id, text).

    Words are runs without ASCII white space, as they are. Each word goes that a run of ``window`` words covers which
    also starts elsewhere, in the same document or another; runs are judged on the input. ``removed`` lists
    the maximal repeats as (start, end) in words. Equality is of 96-bit digests of the windows' words.

    Rows that repeat a document are documents of their own, so long ones lose all. Null and
    empty texts have no words; short ones lose nothing. Null ids are ids. Other columns are
    ignored; an empty table gives an empty table. A task holds one batch, pack or bucket: some
    million words, or one text if that is longer. A bucket has every probe that any batch sent it, so a
    run that is everywhere costs as many entries as there are batches.
    """
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), data.alias("data"))
    rows = rows.withColumn("mark", _mark(F.col("data"))).withColumn("near_mark", F.xxhash64("data"))
    buckets = _buckets((rows.agg(F.sum(F.octet_length("data")).alias("n")).first()["n"] or 0) // 6)
    hits = stored(_met_twice(_probes(rows, window, buckets)), "hits")
    of_documents = _blocks(rows, window, buckets).join(hits, "key", "left_semi")
    lists = stored(of_documents.groupBy("near_mark").agg(F.collect_set("key").alias("keys")), "hit_documents")

    near = rows.where(may_contain(lists, "near_mark")(F.col("near_mark")))
    texts = near.groupBy("mark").agg(F.first("data").alias("data"), F.first("near_mark").alias("near_mark"), F.count(F.lit(1)).alias("copies"))
    packs = stored(_packs(texts.join(lists, "near_mark")), "packs")

    window_buckets = _buckets((lists.agg(F.sum(F.size("keys")).alias("n")).first()["n"] or 0) * window // 2)
    answers = stored(_answers(_questions(packs, window, buckets, window_buckets)), "answers")
    listed = answers.groupBy("pack").agg(F.collect_list(F.struct("bucket", "size", "held")).alias("answers"))
    cut = stored(_cut(packs.join(listed, "pack", "left").select("body", "answers"), window, buckets, window_buckets), "cut")

    joined = _whole(rows).alias("w").join(cut.alias("c"), F.col("w.mark") == F.col("c.mark"), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"),
        F.coalesce("removed", F.array().cast(SPANS)).alias("removed"))


ship_functions(__name__)
