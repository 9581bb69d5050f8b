"""Benchmark items inside documents: size-partitioned MinHash containment search.

A short item in a long document has a tiny Jaccard similarity, so equal numbers
of minima on both sides would miss it. Documents are therefore partitioned by the
size of their shingle set, and each partition has its own number of MinHash bins,
2 ** ``spare_bits`` for each shingle of its largest document: the minimum of each
filled bin is the document's sketch, and an item is sketched with the same bins.
A shared shingle is then the minimum on both sides but for a chance of about
2 ** -``spare_bits``, whatever the sizes. Items whose minima meet often enough are
candidates, and those are verified on the shingles themselves.

DataFrame functions only. Items are broadcast while they are few (checked), and
are joined by shuffle beyond that; a document's text is never shuffled for the
search. Only candidate documents are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.once import with_columns_once
from flowtables.llm.common import stored

WIDTH = 5
BROADCAST_ROWS = 1_000_000  # minima of items; 24 bytes each


def tokens(text: Column) -> Column:
    """Lower-cased runs without ASCII white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def _starts(words: str) -> Column:
    """First positions of the shingles: one for a sequence shorter than the width, none for no words."""
    return F.when(F.size(words) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.greatest(F.size(words) - WIDTH + 1, F.lit(1))))


def shingle_hashes(df: DataFrame, text: str) -> DataFrame:
    """Add ``_hashes``: sorted distinct 64-bit hashes of the shingles of ``text``."""
    df = with_columns_once(df, {"_words": tokens(F.col(text))})
    hashed = F.transform(_starts("_words"), lambda i: F.xxhash64(F.slice("_words", i, WIDTH)))
    return with_columns_once(df, {"_hashes": F.sort_array(F.array_distinct(hashed))}).drop("_words")


def shingle_texts(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: the distinct shingles of ``text`` as strings."""
    df = with_columns_once(df, {"_words": tokens(F.col(text))})
    made = F.transform(_starts("_words"), lambda i: F.array_join(F.slice("_words", i, WIDTH), " "))
    return with_columns_once(df, {name: F.array_distinct(made)}).drop("_words")


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 80, spare_bits: int = 16) -> DataFrame:
    """doc_id, item_id, n_item, n_shared: items of which ``percent`` % of the shingles are in a document.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are
    ignored. One row for each pair of ids; of rows that repeat an id the one with
    the largest share counts. A null id is an id like any other. Null or empty
    texts, or texts without words, have no shingles and are in no row. An item
    of fewer than five words is one shingle, found only in a document of the
    same words. Empty tables give an empty table.
    """
    doc_rows = docs.select("doc_id", F.col("text").alias("doc_text"))
    item_rows = items.select("item_id", F.col("text").alias("item_text")).distinct()

    minima = shingle_hashes(item_rows, "item_text").where("size(_hashes) > 0")
    minima = minima.withColumn("n_item", F.size("_hashes")).select("item_id", "item_text", "n_item", F.posexplode("_hashes").alias("_i", "h"), "_hashes")
    minima = stored(minima.select("item_id", "item_text", "n_item", "h", F.when(F.col("_i") > 0, F.get("_hashes", F.col("_i") - 1)).alias("before")), "items")
    keys = minima.select("h", "before", F.xxhash64("item_id", "item_text").alias("item_key"), "n_item")
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)

    sketched = shingle_hashes(doc_rows.select("doc_id", "doc_text"), "doc_text").where("size(_hashes) > 0")
    bits = F.ceil(F.log2(F.size("_hashes").cast("double"))).cast("int") + spare_bits
    sketched = sketched.select("doc_id", "_hashes", (F.lit(64) - bits).alias("_shift"))
    bin_of = lambda h: F.expr("shiftright({0}, _shift)".format(h))
    lowest = F.filter("_hashes", lambda h, i: (i == 0) | (F.call_function("shiftright", h, F.col("_shift")) != F.call_function("shiftright", F.get("_hashes", i - 1), F.col("_shift"))))
    sketched = sketched.select("doc_id", "_shift", F.explode(lowest).alias("h"))
    met = sketched.join(keys, "h").where(F.col("before").isNull() | (bin_of("h") != bin_of("before")))
    often = F.greatest(F.lit(1), F.floor(F.col("n_item") * percent * 6 / 1000))
    pairs = met.groupBy("doc_id", "item_key", "n_item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often)
    pairs = stored(pairs.select(F.col("doc_id").alias("_doc"), "item_key").distinct(), "candidates")

    texts = shingle_texts(item_rows, "item_text", "_item").select("item_id", F.xxhash64("item_id", "item_text").alias("item_key"), "_item")
    wanted = doc_rows.join(pairs.select("_doc").distinct(), F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    wanted = shingle_texts(wanted, "doc_text", "_doc_set").select("doc_id", "_doc_set")
    checked = wanted.join(pairs, F.col("doc_id").eqNullSafe(F.col("_doc"))).join(texts, "item_key")
    checked = checked.select("doc_id", "item_id", F.size("_item").cast("long").alias("n_item"), F.size(F.array_intersect("_item", "_doc_set")).cast("long").alias("n_shared"))
    found = checked.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_item", "best.n_shared")


def without_contaminated(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` less the documents that hold an item; all columns, of any names, and other rows stay.

    All rows of an id go if one of them holds an item; null is an id. Documents without words hold none. Empty tables give empty tables.
    """
    hit = stored(contaminated(docs, items, percent).select("doc_id").distinct(), "contaminated")
    return docs.alias("d").join(hit.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")), "left_anti")
