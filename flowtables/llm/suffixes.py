"""Repeated strings of at least 400 bytes, by sorting sampled suffixes.

A full suffix array of a corpus has a row for each byte, several times over. Here
only what a string of ``LENGTH`` bytes needs is sorted:

1. Cover. Suffixes are sampled so that two equal strings always have a sampled
   suffix at the same offset, which is what a difference cover is for. Residues
   modulo a number would sample every region of the corpus; instead a position is
   sampled where the hash of the 16 bytes there is the smallest of 256 in a row,
   about 1 position in 128, so that equal strings agree on it by themselves.
2. Names. A sampled suffix is named by three strings: 144 bytes from it on, its
   whole right side up to 400 bytes, and the 255 bytes before it. Names are sorted
   and counted by Spark. A first name that occurs once ends all work on its suffix;
   suffixes whose names all agree repeat in every string through them.
3. Merge. Suffixes with one first name and different other names are sorted by
   their bytes, to the right and to the left, and neighbours' common prefixes give
   classes of strings. The suffix ``l`` bytes before a sampled one sorts by those
   l bytes and then by the sampled one's rank, so its string of 400 bytes occurs
   elsewhere if one more suffix of the group has the same l bytes before it and
   the same 400 - l bytes after it.

Only documents with a named repeat are read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from flowtables.llm.common import id_text, may_contain, ship_functions, stored, with_id

LENGTH, REACH, GRAM = 400, 256, 16  # 2 * REACH positions hold a sample of every string
FIRST = LENGTH - REACH
MANY = 8192  # a first name with more contexts is not merged in one task, its strings are counted by Spark


def sample(data: bytes) -> np.ndarray:
    """Positions of smallest hash (the last of equals) in any run of ``REACH``; ``data`` has LENGTH bytes or more."""
    n = len(data) - GRAM + 1
    raw = np.frombuffer(data, np.uint8)
    spread = raw.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n, np.uint64)
    for i in range(0, GRAM, 4):  # four bytes at a time
        word = spread[i : i + n] | spread[i + 1 : i + 1 + n] << np.uint64(9) | spread[i + 2 : i + 2 + n] << np.uint64(18) | spread[i + 3 : i + 3 + n] << np.uint64(27)
        h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    keyed = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    # minima of all runs: suffix minima of one block and prefix minima of the next
    blocks = -(-n // REACH)
    padded = np.full(blocks * REACH, np.uint64(2**64 - 1))
    padded[:n] = keyed
    grid = padded.reshape(blocks, REACH)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    runs = n - REACH + 1
    lowest = np.minimum(behind[:runs], ahead[REACH - 1 : REACH - 1 + runs])
    return np.unique(np.uint64(0xFFFFFFFF) - (lowest & np.uint64(0xFFFFFFFF))).astype(np.int64)


def reach_of(position: int, size: int) -> tuple[int, int]:
    """The offsets l, first and last, for which a string of LENGTH that starts l before ``position`` lies in the text."""
    return max(0, position + LENGTH - size), min(REACH - 1, position)


def named_suffixes(docs: DataFrame) -> DataFrame:
    """doc_id, mark, key, context, places: sampled suffixes by name, one row per document and name.

    ``key`` is the first name (64 bits, checked on the bytes later), ``context`` all three (128 bits).
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 500):
                rows = []
                part = frame.iloc[at : at + 500]
                for doc_id, mark, data in zip(part["doc_id"], part["mark"], part["data"], strict=True):
                    if len(data) < LENGTH:
                        continue
                    seen: dict = {}
                    for s in sample(data).tolist():
                        low, high = reach_of(s, len(data))
                        if low > high:
                            continue
                        left = s - max(0, s - REACH + 1)
                        context = xxhash.xxh128_digest(data[s - left : s + LENGTH] + left.to_bytes(2, "little"))
                        seen.setdefault(context, []).append(s)
                    for context, places in seen.items():
                        key = xxhash.xxh64_intdigest(data[places[0] : places[0] + FIRST])
                        rows.append((doc_id, mark, key - (1 << 63), context, places))
                yield pd.DataFrame(rows, columns=["doc_id", "mark", "key", "context", "places"])

    return with_id(docs.withColumn("doc_id", id_text()).mapInPandas(work, "doc_id string, mark long, key long, context binary, places array<int>"))


def repeated_offsets(lefts: list[bytes], rights: list[bytes], groups: np.ndarray) -> np.ndarray:
    """For each suffix, at which offsets l = 0..REACH-1 its string occurs at another suffix of its group.

    ``lefts`` are the bytes before the suffixes, ``rights`` those from them on.
    """
    n = len(groups)

    def ranked(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted order by group and bytes, bytes shared with the one before, own length."""
        size = np.array([len(t) for t in texts])
        grid = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(n, width)
        order = np.array(sorted(range(n), key=lambda i: (groups[i], texts[i])))
        differ = grid[order[1:]] != grid[order[:-1]]
        shared = np.where(differ.any(1), differ.argmax(1), width)
        shared = np.minimum(shared, np.minimum(size[order[1:]], size[order[:-1]]))
        shared[groups[order[1:]] != groups[order[:-1]]] = -1
        return order, shared, size

    right_order, right_shared, right_size = ranked(rights, LENGTH)
    left_order, left_shared, left_size = ranked([t[::-1] for t in lefts], REACH - 1)
    out = np.zeros((n, REACH), bool)
    a, b = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(REACH):  # noqa: E741
        fits = (left_size >= l) & (right_size >= LENGTH - l)
        if not fits.any():
            continue
        a[right_order] = np.concatenate([[0], np.cumsum(right_shared < LENGTH - l)])
        b[left_order] = np.concatenate([[0], np.cumsum(left_shared < l)])
        where = np.flatnonzero(fits)
        both = a[where] * n + b[where]
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        twice = np.zeros(len(where), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        out[where[twice], l] = True
    return out


def _merged(contexts: DataFrame, batch: int = 8192) -> DataFrame:
    """key, context, lows, highs: runs of repeated offsets of each context (key, context, before, after), groups whole."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def finish(rows: list[tuple]) -> pd.DataFrame:
            keys = np.array([r[0] for r in rows], np.int64)
            found = repeated_offsets([bytes(r[2]) for r in rows], [bytes(r[3]) for r in rows], keys)
            edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            out = []
            for r, e in zip(rows, edge, strict=True):
                low, high = np.flatnonzero(e == 1), np.flatnonzero(e == -1) - 1
                if len(low):
                    out.append((r[0], r[1], low, high))
            return pd.DataFrame(out, columns=["key", "context", "lows", "highs"])

        for frame in frames:
            held.extend(zip(frame["key"], frame["context"], frame["before"], frame["after"], strict=True))
            if len(held) >= batch:
                last = held[-1][0]
                cut = next((i for i in range(len(held) - 1, -1, -1) if held[i][0] != last), -1) + 1
                if cut:
                    yield finish(held[:cut])
                    held = held[cut:]
        if held:
            yield finish(held)

    return contexts.sortWithinPartitions("key").mapInPandas(work, "key long, context binary, lows array<int>, highs array<int>")


def _counted(contexts: DataFrame) -> DataFrame:
    """What :func:`_merged` gives, by counting: each context is spread to its strings, no task holds a group.

    A digest is of a string and its offset; these fix the first name too. Counts
    are partial before the shuffle, and a context has each digest once.
    """

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 200):
                part, rows = frame.iloc[at : at + 200], []
                for key, context, before, after in zip(part["key"], part["context"], part["before"], part["after"], strict=True):
                    data, place = before + after, len(before)
                    for l in range(max(0, LENGTH - len(after)), min(place, REACH - 1) + 1):  # noqa: E741
                        rows.append((key, context, l, xxhash.xxh128_digest(data[place - l : place - l + LENGTH] + l.to_bytes(2, "little"))))
                yield pd.DataFrame(rows, columns=["key", "context", "l", "digest"])

    strings = stored(contexts, "surroundings").mapInPandas(spread, "key long, context binary, l int, digest binary")
    twice = stored(strings.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "repeated")
    known = may_contain(twice.select(F.xxhash64("digest").alias("h")), "h")
    hits = strings.where(known(F.xxhash64("digest"))).join(twice, "digest", "left_semi")
    listed = hits.groupBy("key", "context").agg(F.collect_set("l").alias("ls")).withColumn("ls", F.array_sort("ls"))
    return listed.selectExpr("key", "context", "filter(ls, x -> not array_contains(ls, x - 1)) as lows", "filter(ls, x -> not array_contains(ls, x + 1)) as highs")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed: one row per row of ``docs`` (doc_id, text).

    Texts are taken as UTF-8 (null: empty). Each byte goes that a string of 400
    bytes covers which also starts elsewhere, in the same document or another;
    strings are judged on the input. ``removed`` lists the runs as (start, end).

    Rows that repeat a document are documents of their own, so long ones lose all.
    Empty and short texts lose nothing. Null ids are ids. Other columns are
    ignored; an empty table gives an empty table. A task holds the distinct
    surroundings (655 bytes each) of the suffixes that share 144 bytes if there are at
    most ``MANY``; more are counted string by string, see :func:`_counted`.
    """
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), data.alias("data"))
    named = stored(named_suffixes(rows), "suffixes")

    counted = named.select("key", F.size("places").alias("n")).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    keys = stored(counted, "names")
    shared = named.where(may_contain(keys, "key")(F.col("key"))).join(keys, "key")
    shared = stored(shared, "shared")
    contexts = shared.groupBy("key", "context").agg(
        F.sum(F.size("places")).alias("n"), F.min(F.struct("doc_id", "mark", F.element_at("places", 1).alias("place"))).alias("at"))
    contexts = stored(contexts.select("key", "context", "n", "at.*"), "contexts")
    mixed = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1")
    mixed = stored(mixed.select("key", (F.col("m") > MANY).alias("many")), "mixed")

    def surroundings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text, listed in zip(frame["data"], frame["wanted"], strict=True):
                yield pd.DataFrame(
                    [(w["key"], w["context"], text[max(0, w["place"] - REACH + 1) : w["place"]], text[w["place"] : w["place"] + LENGTH]) for w in listed],
                    columns=["key", "context", "before", "after"])

    def around(chosen: DataFrame) -> DataFrame:
        wanted = contexts.join(chosen.select("key"), "key").groupBy("doc_id", "mark").agg(F.collect_list(F.struct("key", "context", "place")).alias("wanted"))
        found_in = _of_documents(rows, stored(wanted, "wanted"))
        return found_in.select("data", "wanted").mapInPandas(surroundings, "key long, context binary, before binary, after binary").dropDuplicates(["key", "context"])

    merged = _merged(around(mixed.where("not many")).repartition("key"))
    if not mixed.where("many").isEmpty():
        merged = merged.union(_counted(around(mixed.where("many"))))

    # strings through a suffix: all that fit if its names occur twice, else those that the merge found
    twice = contexts.where("n > 1").select("key", "context", F.array(F.lit(0)).alias("lows"), F.array(F.lit(REACH - 1)).alias("highs"))
    once = merged.join(contexts.where("n = 1").select("key", "context"), ["key", "context"], "left_semi")
    offsets = stored(twice.union(once), "offsets")
    per_doc = shared.join(offsets, ["key", "context"]).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("places", "lows", "highs")).alias("offsets"))
    per_doc = stored(per_doc, "per_document")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, listed in zip(frame["doc_id"], frame["data"], frame["offsets"], strict=True):
                gone = np.zeros(len(text) + 1, np.int32)
                for w in listed if listed is not None else ():
                    for s in w["places"]:
                        first, last = reach_of(int(s), len(text))
                        for low, high in zip(w["lows"], w["highs"], strict=True):
                            if max(low, first) <= min(high, last):
                                gone[s - min(high, last)] += 1
                                gone[s - max(low, first) + LENGTH] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                edge = np.diff(np.pad(covered.astype(np.int8), 1))
                starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends, strict=True)]
                out.append((doc_id, len(text), int(covered.sum()), len(starts), hashlib.sha256(kept).hexdigest(), spans))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    schema = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start: long, end: long>>"
    hit = may_contain(per_doc, "mark")(F.col("mark"))
    flagged = rows.withColumn("_hit", hit)
    joined = flagged.where("_hit").alias("r").join(per_doc.alias("p"), F.expr("r.doc_id <=> p.doc_id and r.mark = p.mark"), "left").select(id_text("r.doc_id").alias("doc_id"), "r.data", "p.offsets")
    whole = flagged.where("not _hit").select(
        "doc_id", F.octet_length("data").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("data", 256).alias("kept_sha256"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("removed"))
    return with_id(joined.mapInPandas(cut, schema)).union(whole)


def _of_documents(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows that ``wanted`` (doc_id, mark, ...) names, once each, with its columns."""
    near = rows.where(may_contain(wanted, "mark")(F.col("mark")))
    joined = near.alias("r").join(wanted.alias("w"), F.expr("r.doc_id <=> w.doc_id and r.mark = w.mark"))
    return joined.select("r.data", *[f"w.{c}" for c in wanted.columns])


ship_functions(__name__)
