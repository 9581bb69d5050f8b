"""Exact nearest binary codes: incremental multi-index hashing.

A code of 64 bits is cut into five segments, and every distinct code is posted
under the value of each segment. Two codes at distance d agree to within d // 5
bits in at least one segment, so probing all segment values within radius r finds
every code up to distance 5 * r + 4. The radius grows by one per round; a query
leaves once its k-th verified distance is covered. A pair is taken from the first
of its nearest segments only, so no round meets it twice.

Equal codes are one entry with their k + 1 smallest ids, on either side, so a
vector that is very common is probed once. (Whatever else has that code comes after
those ids.) What is kept and counted for a query are different ids, not codes.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowtables.llm.common import stored

BITS = 64
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit and width


def sign_code(vector: str = "embedding") -> Column:
    """Bit i is set where element i (of the first 64) is above 0; null for a null or empty vector.

    Null and NaN elements, and those a shorter vector lacks, give no bit.
    """
    item = lambda i: F.coalesce(F.get(vector, F.lit(i)) > 0, F.lit(False)) & ~F.coalesce(F.isnan(F.get(vector, F.lit(i))), F.lit(False))
    bits = sum((F.when(item(i), F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for i in range(1, BITS)), F.when(item(0), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(vector) > 0, bits)


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for chosen in combinations(range(width), radius)]


def _part(code: str, segment: int) -> str:
    first, width = SEGMENTS[segment]
    return f"cast(shiftrightunsigned({code}, {first}) & {(1 << width) - 1} as int)"


def _segments(code: str) -> Column:
    """(segment, value) of a code."""
    return F.array(*[F.struct(F.lit(i).alias("segment"), F.expr(_part(code, i)).alias("value")) for i in range(len(SEGMENTS))])


def _probes(waiting: DataFrame, radius: int) -> DataFrame:
    """(query, bound, segment, value) for all values at ``radius`` from a segment of the query."""
    masks = [F.array(*[F.lit(m) for m in _masks(width, radius)]).cast("array<int>") for _, width in SEGMENTS]
    near = F.array(*[F.struct(F.lit(i).alias("segment"), F.expr(_part("query", i)).alias("near"), m.alias("masks")) for i, m in enumerate(masks)])
    return waiting.select("query", "bound", F.inline(near)).select("query", "bound", "segment", "near", F.explode("masks").alias("mask")).select("query", "bound", "segment", F.expr("near ^ mask").alias("value"))


def nearest(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, id, distance, rank (from 1): the k nearest other ids of each query.

    ``codes`` and ``queries`` have id and code (long). Nearest means smallest Hamming
    distance, then smallest id; an id is no neighbour of itself. Null ids
    or codes have no part. Rows that repeat an id and code count once; an id with several
    codes counts as its nearest, and as a query it has each of its codes. With fewer
    than k others all are returned; empty tables give an empty table.
    """
    known = codes.where("id is not null and code is not null").select("id", "code").distinct()
    asked = stored(queries.where("id is not null and code is not null").select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct(), "queries")
    best_ids = known.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(f"r <= {k + 1}")
    codes_of = best_ids.groupBy("code").agg(F.collect_list("id").alias("ids"))
    index = stored(codes_of.select("code", "ids", F.inline(_segments("code"))), "index")

    far = F.array(*[F.expr(f"bit_count({_part('(query ^ code)', i)})") for i in range(len(SEGMENTS))])
    waiting = asked.select("query").distinct().withColumn("bound", F.lit(BITS))
    found, answers = None, []
    for radius in range(max(width for _, width in SEGMENTS) + 1):
        hits = _probes(waiting, radius).join(index.hint("shuffle_hash"), ["segment", "value"]).where("bit_count(query ^ code) <= bound")
        hits = hits.where((F.array_min(far) == radius) & (F.array_position(far, F.lit(radius)) == F.col("segment") + 1))
        hits = hits.select("query", F.explode("ids").alias("id"), F.expr("bit_count(query ^ code)").alias("distance"))
        seen = hits if found is None else found.unionByName(hits)
        # an id counts once, by its nearest code; of k + 1 ids one may be the query itself
        ids = seen.groupBy("query", "id").agg(F.min("distance").alias("distance"))
        first = Window.partitionBy("query").orderBy("distance", "id")
        found = stored(ids.withColumn("r", F.row_number().over(first)).where(f"r <= {k + 1}").drop("r"), "found")
        covered = len(SEGMENTS) * (radius + 1) - 1
        done = found.where(f"distance <= {covered}").groupBy("query").agg(F.count(F.lit(1)).alias("have")).where(f"have > {k}").select("query")
        done = stored(waiting.select("query") if covered >= BITS else done, "done")
        answers.append(found.join(done, "query", "left_semi").select("query", "id", "distance"))
        # nothing farther than the last of k + 1 ids that are known can matter
        reached = found.groupBy("query").agg(F.when(F.count(F.lit(1)) > k, F.max("distance")).alias("reached"))
        waiting = waiting.select("query").join(done, "query", "left_anti").join(reached, "query", "left")
        waiting = stored(waiting.select("query", F.coalesce("reached", F.lit(BITS)).alias("bound")), "waiting")
        found = found.join(waiting, "query", "left_semi")
        if waiting.isEmpty():
            break
    answer = answers[0]
    for more in answers[1:]:
        answer = answer.union(more)
    per_query = asked.join(answer, "query").where("id != query_id").groupBy("query_id", "id").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return per_query.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select("query_id", "id", "distance", "rank")
