"""Shards of near equal bytes: a K-d tree over metadata columns.

A node that stands for several leaves is cut along the dimension in which its
rows spread widest, at the weighted quantile that gives each side its number of
leaves. Cuts are found for all nodes of a level at once: rows are summed into
histogram bins of the node's key range, the bin with the wanted weight becomes
the new range, and so on until the bin is light enough or cannot be split.

A dimension's key is the value's place on a scale of 2**16 followed by 32 bits of
a hash of the row, so many equal values (a language, a source) can be cut
anywhere, and rows with one text and one id stay together. The tree is a few
comparisons per level: rows get their leaf by an expression, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowtables.llm.common import bucketed_rank, stored

DIMENSIONS = ("source", "lang", "n_chars", "doc_id")
OVERHEAD = 16  # bytes a row takes besides its text
_BIN_BITS = 14
_SCALE = 2**16 - 1


def row_bytes(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _position(df: DataFrame, name: str) -> Column:
    """A number that places the values of a column on a line; null for null."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value)
    if isinstance(kind, (T.TimestampType, T.DateType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.pmod(F.xxhash64(F.when(F.col(name).isNotNull(), F.col(name).cast("string"))), F.lit(2**20)).cast("double")


def dimension_keys(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, id_column: str = "doc_id", text: str = "text") -> list[Column]:
    """One long per dimension that is in ``docs``, aliased ``_k0``, ``_k1``, ...

    Reads the range of each dimension first; one row comes to the driver.
    """
    present = [d for d in dimensions if d in docs.columns] or [id_column]
    at = [_position(docs, d) for d in present]
    ends = docs.select(*[p.alias(f"p{i}") for i, p in enumerate(at)]).agg(
        *[f(f"p{i}").alias(f"{n}{i}") for i in range(len(at)) for n, f in (("low", F.min), ("high", F.max))]).first()
    tie = F.pmod(F.xxhash64(id_column, text), F.lit(2**32))
    keys = []
    for i, p in enumerate(at):
        low, high = ends[f"low{i}"], ends[f"high{i}"]
        if low is None or not high > low:
            level = F.lit(0)
        else:
            level = F.coalesce(F.floor((p - F.lit(low)) / F.lit(high - low) * _SCALE), F.lit(0))
        keys.append((level.cast("long") * F.lit(2**32) + tie).alias(f"_k{i}"))
    return keys


class Tree:
    """Cuts by node; node numbers as in a heap, the root is 1."""

    def __init__(self, leaves: int):
        self.leaves = {1: leaves}
        self.cuts: dict[int, tuple[int, int]] = {}
        self.first = {1: 0}

    def cut(self, node: int, dimension: int, key: int) -> None:
        left = self.leaves[node] // 2
        self.cuts[node] = (dimension, key)
        self.leaves[2 * node], self.leaves[2 * node + 1] = left, self.leaves[node] - left
        self.first[2 * node], self.first[2 * node + 1] = self.first[node], self.first[node] + left

    def place(self, node: int = 1, leaf: bool = True) -> Column:
        """The shard of a row (or the node it has come to)."""
        if node not in self.cuts:
            return F.lit(self.first[node] if leaf else node)
        dimension, key = self.cuts[node]
        return F.when(F.col(f"_k{dimension}") < key, self.place(2 * node, leaf)).otherwise(self.place(2 * node + 1, leaf))


def build_tree(rows: DataFrame, dimensions: int, leaves: int, tolerance: float = 0.002) -> Tree:
    """``rows`` has _k0.. and _size. A cut misses its weight by at most ``tolerance`` of a leaf, or by one key.

    What comes to the driver is a row per node of a level, never more than ``leaves``.
    """
    tree = Tree(leaves)
    total = rows.agg(F.sum("_size")).first()[0] or 0
    light = tolerance * total / leaves
    level = [1]
    while level := [n for n in level if tree.leaves[n] > 1]:
        here = rows.withColumn("_node", tree.place(leaf=False)).where(F.col("_node").isin(level))
        spread = here.groupBy("_node").agg(
            F.sum("_size").alias("_size"), *[f(f"_k{i}").alias(f"{n}{i}") for i in range(dimensions) for n, f in (("low", F.min), ("high", F.max))]).collect()
        open_cuts = {}
        for r in spread:
            widths = [(r[f"high{i}"] >> 32) - (r[f"low{i}"] >> 32) for i in range(dimensions)]
            widest = max(range(dimensions), key=lambda i: (widths[i], -i))
            share = tree.leaves[r["_node"]] // 2 / tree.leaves[r["_node"]]
            open_cuts[r["_node"]] = {"dim": widest, "low": r[f"low{widest}"], "high": r[f"high{widest}"] + 1, "want": r["_size"] * share}
        for n in level:  # no rows came here: any cut will do
            if n not in open_cuts:
                tree.cut(n, 0, 0)
        while open_cuts:
            open_cuts = _refine(here, open_cuts, tree, light)
        level = [c for n in level for c in (2 * n, 2 * n + 1)]
    return tree


def _refine(here: DataFrame, cuts: dict[int, dict], tree: Tree, light: float) -> dict[int, dict]:
    """One histogram pass for all open cuts; closes those that are near enough."""
    for c in cuts.values():
        c["width"] = max(1, -(-(c["high"] - c["low"]) // 2**_BIN_BITS))
    listed = ", ".join(f"({n}, {c['dim']}, {c['low']}L, {c['high']}L, {c['width']}L, {float(c['want'])!r}D)" for n, c in cuts.items())
    wanted = here.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS cuts(_node, _dim, _low, _high, _width, _want)")
    keys = F.array(*[c for c in here.columns if c.startswith("_k")])
    inside = here.join(F.broadcast(wanted), "_node").withColumn("_key", F.get(keys, F.col("_dim"))).where("_key >= _low and _key < _high")
    bins = inside.groupBy("_node", F.expr("(_key - _low) div _width").alias("_bin")).agg(F.sum("_size").alias("_w"), F.first("_want").alias("_want"))
    run = Window.partitionBy("_node").orderBy("_bin")
    crossing = bins.withColumn("_up", F.sum("_w").over(run)).where("_up >= _want").groupBy("_node").agg(F.min(F.struct("_bin", "_up", "_w")).alias("c")).select("_node", "c.*")
    found = {r["_node"]: r for r in crossing.collect()}
    still = {}
    for n, c in cuts.items():
        r = found[n]
        low, before = c["low"] + r["_bin"] * c["width"], r["_up"] - r["_w"]
        if r["_w"] <= light or c["width"] == 1:
            nearer_end = r["_up"] - c["want"] <= c["want"] - before
            tree.cut(n, c["dim"], low + c["width"] if nearer_end else low)
        else:
            still[n] = {"dim": c["dim"], "low": low, "high": min(low + c["width"], c["high"]), "want": c["want"] - before}
    return still


def leaves_for(total_bytes: int, target_bytes: int) -> int:
    return max(1, -(-total_bytes // target_bytes))


def shards(docs: DataFrame, leaves: int, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs``.

    ``size`` is the UTF-8 bytes of the text (none for null) plus 16, and shards
    have near equal sums of it. ``slot`` counts from 0 in each shard. A null in a
    dimension is its lowest value; dimensions that ``docs`` lacks are passed
    over. Rows alike in id and text are never parted. Empty tables give an empty table;
    other columns are ignored.
    """
    keys = dimension_keys(docs, dimensions)
    rows = stored(docs.select("doc_id", row_bytes().alias("_size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), *keys), "metadata")
    tree = build_tree(rows, len(keys), leaves)
    placed = rows.select("doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), tree.place().cast("int").alias("shard"))
    ranked = bucketed_rank(placed, ["shard"], ["doc_id", "text_crc32"])
    return ranked.select("doc_id", "size", "text_crc32", "law", "shard", F.col("_rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def with_shard(docs: DataFrame, target_bytes: int, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """``docs`` with a column ``shard`` (replaced if there is one), leaves of about ``target_bytes``.

    The text is read for its length and hash only and is not shuffled. Columns may have any names. A null in a
    dimension is its lowest value, and dimensions that ``docs`` lacks are passed over; rows alike are
    never parted, and an empty table gives an empty table.
    """
    keys = dimension_keys(docs, dimensions)
    rows = stored(docs.select(row_bytes().alias("_size"), *keys), "metadata")
    total = rows.agg(F.sum("_size")).first()[0] or 0
    tree = build_tree(rows, len(keys), leaves_for(total, target_bytes))
    kept = [c for c in docs.columns if c != "shard"]
    return docs.select(F.struct(*kept).alias("_all"), *keys).select("_all.*", tree.place().cast("int").alias("shard"))
