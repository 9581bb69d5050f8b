"""Sources interleaved to target weights by Pfair scheduling.

A source's documents are cut into blocks of equal bytes. With n parts of N, block
j of a source has release time floor(j * N / n) and deadline ceil((j + 1) * N / n);
in each slot the released block with the earliest deadline goes next. So after any
number of slots a source has had its share of blocks, less than one more or less.

Since shares are whole parts of N, the schedule repeats after N slots. One period
is worked out and every block finds its slot by its number; nothing is scheduled
block by block. The schedule of the true parts goes on until the slot in which the
first source runs out; then the sources that are left start a schedule of their own
parts. Every document is in the mixture exactly once.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowtables.llm.common import bucketed_rank, stored

BROADCAST_SLOTS = 200_000  # rows of the slot table that are sent to every task; a larger one is joined by block


def stretch(parts: dict, left: dict, singles: int = 0) -> tuple[list[tuple], int, bool]:
    """One period by earliest deadline first, or less if a source runs out: jobs, its length, whether one ran out.

    A job is (source, block in the stretch, slot, release, deadline). ``left`` are the blocks that sources still have.
    ``singles`` more sources of one part and one block are not listed: such a block is released at once
    and due at the end of the period, so the slots that the others leave free are theirs. As a group they run out like a source.
    """
    total = sum(parts.values()) + singles
    order = {s: k for k, s in enumerate(parts)}
    coming = [(0, order[s], 0, s) for s in parts]
    ready, out, had, free = [], [], dict.fromkeys(parts, 0), 0
    for slot in range(total):
        while coming and coming[0][0] <= slot:
            release, k, j, s = heapq.heappop(coming)
            heapq.heappush(ready, (-(-(j + 1) * total // parts[s]), k, j, s, release))
            if j + 1 < parts[s]:
                heapq.heappush(coming, ((j + 1) * total // parts[s], k, j + 1, s))
        if ready:
            deadline, _, j, s, release = heapq.heappop(ready)
            out.append((s, j, slot, release, deadline))
            had[s] += 1
            over = had[s] == left[s]
        else:
            free += 1
            over = free == singles
        if over:
            return out, slot + 1, True
    return out, total, False


def stretches(blocks: dict, parts: dict, singles: int = 0) -> list[dict]:
    """The whole mixture: periods that repeat, and the shorter ones in which a source runs out."""
    left, done, base, served, out = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0, 0, []
    while left or served < singles:
        shares = {s: parts[s] for s in left}
        jobs, length, ended = stretch(shares, left, singles - served)
        times = 1 if ended else min((left[s] - 1) // n for s, n in shares.items())
        counts = dict.fromkeys(shares, 0)
        for s, *_ in jobs:
            counts[s] += 1
        out.append({"jobs": jobs, "counts": counts, "first": {s: done[s] for s in shares}, "times": times, "base": base, "length": length,
                    "period": sum(shares.values()) + singles - served, "served": served})
        served += length - len(jobs)
        base += times * length
        for s, n in counts.items():
            done[s] += n * times
            left[s] -= n * times
        left = {s: n for s, n in left.items() if n > 0}
    return out


def mixed(docs: DataFrame, parts: dict | None = None, block_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, source, size, block, slot, release, deadline, position: one row per row of ``docs``.

    ``parts`` maps sources to whole numbers; sources it lacks get one part. By
    default parts follow the square root of the source's bytes, about 1000 in all and one at least. ``release`` and
    ``deadline`` are slots of the whole mixture, ``position`` (from 0) orders it:
    by slot, then by place in the source. A text larger than a block takes the
    slots of all the blocks it fills; an empty or null text takes one byte.

    Until a source ends, and again after that, every source has had its share of the slots to within one block.
    Sources of one block and one part are one group with the parts of those that are left when a stretch begins.
    A null source is a source. Rows alike in id, text and source are all kept and
    follow one another in any order. Order inside a source is by hash.
    An empty table gives an empty table; other columns are ignored. The driver
    holds a number for each source of several blocks or parts, and one period of slots for each time that one ends.
    """
    out = _placed(docs.select("doc_id", _source(), _size(), F.xxhash64("text").alias("_text")), parts, block_bytes, ["doc_id"])
    # positions: the rows before a slot, then the place in the slot (one block of one source)
    per_slot = out.groupBy("slot").agg(F.count(F.lit(1)).alias("n"), F.min("_rank").alias("first_rank"))
    starts = _running(per_slot)
    return out.join(starts, "slot").select("doc_id", "source", "size", "block", "slot", "release", "deadline", (F.col("start") + F.col("_rank") - F.col("first_rank")).alias("position"))


def _source() -> Column:
    return F.col("source").cast("string").alias("source")


def _size() -> Column:
    return F.greatest(F.coalesce(F.octet_length("text"), F.lit(1)), F.lit(1)).cast("long").alias("size")


def _with_parts(sizes: DataFrame, parts: dict | None, total: int = 1000) -> DataFrame:
    """source, size, parts."""
    if parts is None:
        whole = sizes.agg(F.coalesce(F.sum(F.sqrt("size")), F.lit(1.0))).first()[0]
        return sizes.withColumn("parts", F.greatest(F.lit(1), F.round(total * F.sqrt("size") / whole)).cast("long"))
    given = sizes.sparkSession.createDataFrame([(s, max(1, int(n))) for s, n in parts.items()], "of string, parts long")
    joined = sizes.join(given, F.col("source").eqNullSafe(F.col("of")), "left")
    return joined.select("source", "size", F.coalesce("parts", F.lit(1).cast("long")).alias("parts"))


def _placed(rows: DataFrame, parts: dict | None, block_bytes: int, kept: list[str]) -> DataFrame:
    """source, size, block, slot, release, deadline, _rank and ``kept`` for rows of (doc_id, source, size, _text) and ``kept``."""
    spark = rows.sparkSession
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("size")), "sources")
    sources = stored(_with_parts(sizes, parts).withColumn("blocks", F.ceil(F.col("size") / block_bytes).cast("long")), "parts")
    several = (F.col("blocks") > 1) | (F.col("parts") > 1)
    found = sorted(sources.where(several).collect(), key=lambda r: (r["source"] is not None, r["source"] or ""))
    few = sources.where(~several)
    singles = few.count()
    plan = stretches({r["source"]: r["blocks"] for r in found}, {r["source"]: r["parts"] for r in found}, singles)

    ranked = bucketed_rank(rows, ["source"], ["doc_id", "_text"], weight="size").withColumn("block", F.expr(f"_before div {block_bytes}"))
    columns = [*kept, "source", "size", "block", "_rank"]
    table = _slot_table(spark, plan)
    slots = sum(len(p["jobs"]) for p in plan)
    r, turn = ranked.alias("r"), F.expr("t.base + (r.block - t.first_block) div t.in_period * t.length")
    if slots <= BROADCAST_SLOTS:
        same = F.expr("r.block >= t.first_block and r.block < t.last_block and (r.block - t.first_block) % t.in_period = t.at")
        joined = r.join(F.broadcast(table).alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")) & same)
    else:
        each = table.withColumn("_block", F.explode(F.expr("sequence(first_block + at, last_block - 1, in_period)")))
        joined = r.join(each.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")) & F.expr("r.block = t._block"))
    out = joined.select(*[F.col(f"r.{c}") for c in columns], *[(turn + F.col(f"t.{c}")).alias(c) for c in ("slot", "release", "deadline")])
    if singles:
        alone = ranked.join(_single_slots(few, plan), F.col("source").eqNullSafe(F.col("_alone")))
        out = out.unionByName(alone.select(*columns, "slot", "release", "deadline"))
    return out


def _slot_table(spark: SparkSession, plan: list[dict]) -> DataFrame:
    rows = []
    for p in plan:
        for s, j, slot, release, deadline in p["jobs"]:
            n, first = p["counts"][s], p["first"][s]
            rows.append((s, first, first + n * p["times"], n, j, p["base"], p["length"], slot, release, deadline))
    return spark.createDataFrame(rows, "source string, first_block long, last_block long, in_period long, at long, base long, length long, slot long, release long, deadline long")


def _single_slots(few: DataFrame, plan: list[dict]) -> DataFrame:
    """_alone, slot, release, deadline of the sources of one block: in order of a hash they take the slots that are left free."""
    gaps = []
    for p in plan:
        number, last = p["served"], -1
        for slot in [*[job[2] for job in p["jobs"]], p["length"]]:
            if (size := slot - last - 1) > 0:
                gaps.append((number, number + size - 1, p["base"] + last + 1, p["base"], p["base"] + p["period"]))
            number, last = number + size, slot
    listed = few.sparkSession.createDataFrame(gaps, "low long, high long, begin long, release long, deadline long")
    free = listed.select(F.explode(F.sequence("low", "high")).alias("_number"), "low", "begin", "release", "deadline")
    free = free.select("_number", (F.col("begin") + F.col("_number") - F.col("low")).alias("slot"), "release", "deadline")
    numbered = bucketed_rank(few.select("source"), [], ["source"])
    return numbered.join(free, F.col("_rank") == F.col("_number")).select(F.col("source").alias("_alone"), "slot", "release", "deadline")


def _running(per_slot: DataFrame, chunk: int = 100_000) -> DataFrame:
    """slot, first_rank, start: sum of n over earlier slots, in chunks so that no task sorts all slots."""
    chunked = per_slot.withColumn("_c", F.expr(f"slot div {chunk}"))
    sums = chunked.groupBy("_c").agg(F.sum("n").alias("_n"))
    before = sums.select("_c", F.coalesce(F.sum("_n").over(Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = chunked.withColumn("_in", F.coalesce(F.sum("n").over(Window.partitionBy("_c").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inside.join(before, "_c").select("slot", "first_rank", (F.col("_in") + F.col("_base")).alias("start"))


def in_mixed_order(docs: DataFrame, parts: dict | None = None, block_bytes: int = 1 << 20) -> DataFrame:
    """``docs``, all rows and columns, laid out in the order of the mixture.

    Files written from it, read by name and from top to bottom, give that order.
    Every row has a place of its own, also rows that repeat an id or have none. Columns may have any names;
    nulls, empty texts and tables as in :func:`mixed`.
    """
    rows = docs.select("doc_id", _source(), _size(), F.xxhash64("text").alias("_text"), F.struct("*").alias("_all"))
    placed = _placed(rows, parts, block_bytes, ["_all"])
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartitionByRange(tasks, "slot", "_rank").sortWithinPartitions("slot", "_rank").select("_all.*")


def _items(found) -> list:
    return [found.apply(i) for i in range(found.size())]


def with_position(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position`` (from 0), the place of each row in the files they were read from, by name and from top to bottom.

    However a reader packs or splits the files, this is the order in which they were
    written. A column ``position`` that is there is replaced. Rows that do not come from Parquet files have no order, and are given back as they are.
    """
    plan = docs._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation" or "_metadata" not in [c.name() for c in _items(plan.metadataOutput())]:
        return docs
    name, index = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    files = docs.groupBy(name.alias("_file")).agg((F.max(index) + 1).alias("_n"))
    # names part-<number>-...: beyond 99999 the number is longer
    earlier = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    kept = [c for c in docs.columns if c != "position"]
    rows = docs.select(F.struct(*kept).alias("_all"), name.alias("_name"), index.alias("_index"))
    placed = rows.join(F.broadcast(begins), F.col("_name") == F.col("_file"))  # one row per file
    return placed.select("_all.*", (F.col("_begin") + F.col("_index")).alias("position"))
