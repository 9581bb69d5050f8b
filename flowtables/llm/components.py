"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowtables.llm.common import stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b of any ordered type).

    Each round points every node to its smallest neighbour, first for larger
    neighbours and then for smaller ones, until nothing changes; paths halve per
    round. Minima are aggregated before the shuffle and joined back, so a node
    with very many links is no single task. Null ends and self links are left out.
    """
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = _digest(edges)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = up.groupBy("u").agg(F.min("v").alias("m"))
        moved = up.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.union(smallest.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _digest(edges: DataFrame):
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first()
    return tuple(row)
