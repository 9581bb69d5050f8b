"""Near-duplicate documents: signature coordinates posted in an inverted index.

1. Each document's set of word shingles gives a signature of ``coordinates``
   minima. Equal sets are one class from here on, so exact copies cost nothing.
2. Every class is posted under each of its coordinate-value pairs. Pairs that
   only one class has cannot collide and are skipped.
3. Two classes as similar as asked share ``needed`` pairs but for a chance below
   1e-6. With the pairs of a class in one order, rarest first, two such classes
   must meet within the first (shared - needed + 1) pairs of both: only this
   prefix is merged, and the long lists behind it are skipped.
4. Collisions of the pairs that met are counted on the whole signatures; those
   with ``needed`` or more are confirmed on the full sets.

Lists are not expanded into all pairs. Each class is held against the most central
class of each list it is in (its pivot); confirmed links give components. After
that only classes of *different* components that meet in a list are open. Their
known differences from the pivot bound how alike they can be (see
:func:`_open_pairs`), and only pairs that pass the bound are made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowtables.llm.common import id_text, may_contain, ship_functions, stored, with_id
from flowtables.llm.components import components
from flowtables.llm.shingles import WordHashes, shingle_set


def needed_collisions(coordinates: int, percent: int) -> int:
    """Collisions that a pair at the threshold has, less 5.2 standard deviations."""
    j = percent / 100
    return max(1, math.floor(coordinates * j - 5.2 * math.sqrt(coordinates * j * (1 - j))))


def signatures(docs: DataFrame, coordinates: int = 48, width: int = 5) -> DataFrame:
    """doc_id, text, n_shingles, cls (16 bytes, equal for equal sets), signature (array of long)."""
    rng = np.random.default_rng(20240229)
    factors = rng.integers(1, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salts = rng.integers(0, 2**63, coordinates, dtype=np.uint64)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            sizes, classes, signs = [], [], []
            for text in frame["text"]:
                s = shingle_set(text, hashes, width)
                sizes.append(len(s))
                classes.append(xxhash.xxh128_digest(s.tobytes()))
                low = np.full(coordinates, np.uint64(2**64 - 1))
                for start in range(0, len(s), 4096):
                    part = (s[start : start + 4096] ^ (s[start : start + 4096] >> np.uint64(31)))[:, None] * factors
                    low = np.minimum(low, (part ^ (part >> np.uint64(32))).min(axis=0))
                # the salt makes a value of one coordinate differ from that of another
                signs.append(((low ^ salts) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64) if len(s) else None)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "text": frame["text"], "n_shingles": sizes, "cls": classes, "signature": signs})

    rows = docs.select(id_text(), F.col("text").cast("string").alias("text"))
    return with_id(rows.mapInPandas(work, "doc_id string, text string, n_shingles long, cls binary, signature array<long>"))


def compared(pairs: DataFrame, texts: DataFrame, width: int, differing: bool) -> DataFrame:
    """(a, b) with the sizes of both full shingle sets, ``na`` and ``nb``, and ``d``, the number of shingles in only one.

    ``texts``: cls, text. With ``differing`` also ``delta``, those shingles.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        last, kept = None, None
        for frame in frames:
            rows = []
            for a, b, text_a, text_b in zip(frame["a"], frame["b"], frame["text_a"], frame["text_b"], strict=True):
                if bytes(b) != last:
                    last, kept = bytes(b), shingle_set(text_b, hashes, width)
                other = shingle_set(text_a, hashes, width)
                delta = np.setxor1d(other, kept, assume_unique=True)
                rows.append((a, b, len(other), len(kept), len(delta), delta.view(np.int64) if differing else None))
            yield pd.DataFrame(rows, columns=["a", "b", "na", "nb", "d", "delta"])

    first = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    second = first.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    return second.select("a", "b", "text_a", "text_b").mapInPandas(work, "a binary, b binary, na long, nb long, d long, delta array<long>")


def linked(percent: int) -> str:
    """Similarity reaches ``percent``, put by na, nb and d: intersection and union are half of (na + nb -+ d)."""
    return f"d * {100 + percent} <= {100 - percent} * (na + nb)"


def near_duplicates(docs: DataFrame, percent: int = 80, coordinates: int = 48, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs`` (doc_id, text).

    Documents are linked when 100 * |A and B| >= percent * |A or B| for their sets
    of ``width``-word shingles. ``component_id`` is the smallest doc_id reachable;
    ``kept`` marks rows whose doc_id it is.

    Null or empty texts, or texts without words, have an empty set and are linked
    with nothing. Rows that repeat a doc_id are all returned. A null doc_id takes
    part; its component is named by the other ids, or null if there are none, and
    only then is it kept. An empty table gives an empty table; other columns are ignored.
    """
    signed, rooted = _rooted(docs, percent, coordinates, width)
    named = rooted.groupBy("root").agg(F.min("min_id").alias("component_id"))
    names = rooted.join(named, "root").select("cls", "component_id")
    out = signed.select("doc_id", "n_shingles", "cls").join(names, "cls", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _rooted(docs: DataFrame, percent: int, coordinates: int, width: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and (cls, min_id, root) of each class that is not empty; classes of one root are a group."""
    needed = needed_collisions(coordinates, percent)
    signed = stored(signatures(docs, coordinates, width), "signatures")
    filled = signed.where("n_shingles > 0")
    first = Window.partitionBy("cls").orderBy(F.col("doc_id").asc_nulls_last())
    classes = filled.select("cls", "doc_id", "signature").withColumn("r", F.row_number().over(first)).where("r = 1").select("cls", "signature", F.col("doc_id").alias("min_id"))

    posted = classes.select("cls", F.explode("signature").alias("key"))
    common = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = Window.partitionBy("cls")
    shared = posted.join(common, "key").withColumn("m", F.count(F.lit(1)).over(own)).where(f"m >= {needed}")
    prefix = shared.withColumn("r", F.row_number().over(own.orderBy("n", "key"))).where(f"r <= m - {needed} + 1")
    central = F.sum("n").over(own)
    prefix = stored(prefix.withColumn("central", central).select("key", "cls", "central"), "prefixes")

    met = prefix.select("cls").distinct()
    known = may_contain(met.select(F.xxhash64("cls").alias("h")), "h")
    rows = filled.where(known(F.xxhash64("cls"))).join(met, "cls", "left_semi").select("cls", "text", "signature", "doc_id")
    texts = stored(rows.withColumn("r", F.row_number().over(first)).where("r = 1").select("cls", "text", "signature"), "texts")

    pivots = prefix.groupBy("key").agg(F.max(F.struct("central", "cls")).alias("p"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.col("p.cls").alias("pivot"))
    listed = prefix.select("key", "cls").join(pivots, "key")
    pairs = listed.where("cls != pivot").select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct()
    held = stored(compared(pairs, texts, width, differing=True), "compared")

    # a pair held against one pivot is surely linked if its slacks add up to 0 or more: the largest slack of a pivot will do
    slack = F.expr(f"{100 - percent} * n - {100 + percent} * d")
    ends = held.select(F.col("a").alias("cls"), F.col("b").alias("pivot"), F.col("na").alias("n"), "d")
    itself = held.select(F.col("b").alias("cls"), F.col("b").alias("pivot"), F.col("nb").alias("n"), F.lit(0).cast("long").alias("d")).distinct()
    members = ends.union(itself).withColumn("slack", slack)
    widest = members.groupBy("pivot").agg(F.max(F.struct("slack", "cls")).alias("w")).select("pivot", F.col("w.slack").alias("most"), F.col("w.cls").alias("b"))
    sure = members.join(widest, "pivot").where("cls != b and slack + most >= 0").select(F.col("cls").alias("a"), "b")
    links = held.where(linked(percent)).select("a", "b").union(sure)
    parts = stored(components(links), "parts")

    open_rows = listed.join(parts.withColumnRenamed("node", "cls"), "cls", "left").select("key", "cls", "pivot", F.coalesce("root", "cls").alias("root"))
    open_keys = open_rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key")
    open_rows = stored(open_rows.join(open_keys, "key"), "open")
    counted = _open_pairs(open_rows, members, held, texts.select("cls", "signature"), percent, needed)
    more = compared(counted, texts, width, differing=False).where(linked(percent)).select("a", "b")
    found = parts.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    whole = stored(components(found.union(more)), "parts")

    return signed, classes.select("cls", "min_id").join(whole.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "min_id", F.coalesce("root", "cls").alias("root"))


def _open_pairs(open_rows: DataFrame, members: DataFrame, held: DataFrame, signed: DataFrame, percent: int, needed: int) -> DataFrame:
    """Pairs (a, b) of different components that meet in a list, collide ``needed`` times and may be linked.

    Two members x and y of a pivot's lists differ in d_x + d_y - 2 * (what their
    deltas share) shingles, and what a delta shares is at most ``s``, its elements
    that some other delta of the pivot has too. So a pair is possible only if
    slack_x + slack_y + 2 * (100 + percent) * min(s_x, s_y) >= 0. A member that
    fails this with the best of its list leaves the list before any pair is made.
    A pair is made in the first list that it has in common only.
    """
    wanted = open_rows.select("cls", "pivot").distinct()
    deltas = held.select(F.col("a").alias("cls"), F.col("b").alias("pivot"), "delta").join(wanted, ["cls", "pivot"])
    elements = deltas.select("cls", "pivot", F.explode("delta").alias("e"))
    twice = elements.groupBy("pivot", "e").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("pivot", "e")
    common = elements.join(twice, ["pivot", "e"]).groupBy("cls", "pivot").agg(F.count(F.lit(1)).alias("s"))
    known = members.join(wanted, ["cls", "pivot"]).join(common, ["cls", "pivot"], "left").select("cls", "pivot", "n", "slack", F.coalesce("s", F.lit(0)).alias("s"))
    gain = 2 * (100 + percent)
    rows = open_rows.join(known, ["cls", "pivot"]).select("key", "cls", "root", "n", "slack", "s")
    best = rows.groupBy("key").agg(F.max(F.expr(f"slack + {gain} * s")).alias("best"))
    rows = rows.join(best, "key").where("slack + best >= 0").drop("best")
    lists = rows.groupBy("cls").agg(F.collect_list("key").alias("keys"))  # no more than a prefix
    rows = stored(rows.join(lists, "cls").join(signed, "cls"), "possible")
    x, y = rows.alias("x"), rows.alias("y")
    possible = F.expr(f"x.key = y.key and x.root != y.root and x.cls > y.cls and x.slack + y.slack + {gain} * least(x.s, y.s) >= 0 "
                      f"and {percent} * greatest(x.n, y.n) <= 100 * least(x.n, y.n) and x.key = array_min(array_intersect(x.keys, y.keys)) "
                      f"and size(array_intersect(x.signature, y.signature)) >= {needed}")
    return x.join(y, possible).select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))


def _row_name(doc_id: Column, text: Column) -> Column:
    """Equal for rows with one doc_id (or none) and one text; one column, so that joining and dropping repeats share a shuffle."""
    return F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.lit("|"), F.md5(text.cast("string").cast("binary")))


def without_near_duplicates(docs: DataFrame, percent: int = 80, coordinates: int = 48, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay when each group keeps one, all columns.

    A group keeps its row of smallest doc_id, null ids last; of several such rows
    the one of smallest set digest, then of smallest text digest. So what groups
    keep does not depend on ids: different groups may keep rows with one doc_id or
    with none. Rows equal in doc_id and text count once; documents with an empty set all stay.
    """
    signed, rooted = _rooted(docs, percent, coordinates, width)
    # the class of a group's row of smallest id, then the row in it
    order = F.struct(F.col("min_id").isNull().alias("none"), "min_id", "cls")
    chosen = rooted.groupBy("root").agg(F.min(order).alias("first")).select("first.cls")
    members = signed.where("n_shingles > 0").select("cls", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _row_name(F.col("doc_id"), F.col("text")).alias("name")).alias("row"))
    first = members.groupBy("cls").agg(F.min("row").alias("row"))
    stay = stored(first.join(chosen, "cls", "left_semi").select(F.col("row.name").alias("_stay")), "kept")
    filled = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # one shuffle of the texts serves the join and the repeated rows
    named = docs.where(filled).select(_row_name(F.col("doc_id"), F.col("text")).alias("_name"), F.struct("*").alias("_all"))
    rows = named.join(stay, F.col("_name") == F.col("_stay"), "left_semi").dropDuplicates(["_name"])
    return rows.select("_all.*").unionByName(docs.where(~filled))


ship_functions(__name__)
