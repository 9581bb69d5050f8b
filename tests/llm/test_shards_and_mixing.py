"""K-d tree shards and Pfair mixing: laws, and brute force where there is one."""

import random
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from llm_data import corpus, frame
from pyspark.sql import functions as F

from flowtables.llm import kdtree, mixing


def many_rows(seed=1):
    rng = random.Random(seed)
    return [(i, "x" * min(5000, int(rng.paretovariate(1.1) * 40))) for i in range(600)] + corpus(seed)


@pytest.mark.parametrize("leaves", [1, 7, 40])
def test_shards_are_even_in_bytes_and_slots_gapless(spark, leaves):
    rows = many_rows()
    docs = frame(spark, rows)
    got = kdtree.shards(docs, leaves).collect()
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, size(t), crc32((t or "").encode())) for i, t in rows)
    slots, weight = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        weight[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert set(slots) <= set(range(leaves)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(size(t) for _, t in rows) / leaves, max(size(t) for _, t in rows)
    assert all(abs(w - mean) <= largest + 0.05 * mean for w in weight.values()), weight


def test_cuts_follow_the_widest_dimension(spark):
    """The first cut parts the sources, which differ most, at the weighted median."""
    rows = [(i, "t" * 100, "en", "a" if i < 50 else "b", 100) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = kdtree.with_shard(docs, 50 * 116).select("source", "shard").distinct().collect()
    assert len(got) == 2 and len({r["shard"] for r in got}) == 2


def test_stage_keeps_rows_and_columns(spark):
    docs = frame(spark, many_rows(2))
    got = kdtree.with_shard(docs, 5000)
    assert got.columns == [*docs.columns, "shard"] and got.drop("shard").exceptAll(docs).count() == 0 and got.count() == docs.count()
    none = docs.where("false")
    assert kdtree.shards(none, 40).count() == 0 and kdtree.with_shard(none, 100).count() == 0


def brute_mixture(blocks, parts):
    """(source, block, last slot of its stretch) slot by slot, choosing among all released blocks of the true parts."""
    left, out, begins = dict(blocks), [], []
    while alive := {s: parts[s] for s in parts if left.get(s)}:
        total, had = sum(alive.values()), Counter()
        begins.append(len(out))
        slot = 0
        while all(left.values()):
            ready = [(-(-(had[s] + 1) * total // n), k, s) for k, (s, n) in enumerate(alive.items()) if had[s] * total // n <= slot]
            s = min(ready)[2]
            out.append((s, blocks[s] - left[s]))
            had[s] += 1
            left[s] -= 1
            slot += 1
        left = {s: n for s, n in left.items() if n}
    return out, begins


def within_a_block(order, begins, parts, blocks):
    """In every prefix of every stretch each source has its share to within a block."""
    left = dict(blocks)
    for begin, end in zip(begins, [*begins[1:], len(order)], strict=True):
        alive = {s: parts[s] for s, n in left.items() if n}
        had = Counter()
        for i, s in enumerate(order[begin:end], 1):
            had[s] += 1
            assert all(abs(had[x] - i * n / sum(alive.values())) < 1 for x, n in alive.items())
        left = {s: n - had[s] for s, n in left.items()}


def test_stretches_are_the_whole_schedule_of_the_true_parts():
    rng = random.Random(3)
    cases = [({"a": 400, "b": 10}, {"a": 500, "b": 500}), ({"a": 300, "b": 150, "c": 50}, {"a": 200, "b": 300, "c": 500}), ({"a": 1}, {"a": 9})]
    for _ in range(40):
        names = range(rng.randint(1, 9))
        cases.append(({k: rng.randint(1, 90) for k in names}, {k: rng.choice([1, 3, rng.randint(1, 40)]) for k in names}))
    for blocks, parts in cases:
        want, begins = brute_mixture(blocks, parts)
        got = {}
        for p in mixing.stretches(blocks, parts):
            for s, j, slot, release, deadline in p["jobs"]:
                assert release <= slot < deadline
                for turn in range(p["times"]):
                    at = p["base"] + turn * p["length"] + slot
                    assert at not in got
                    got[at] = (s, p["first"][s] + turn * p["counts"][s] + j)
        assert [got[i] for i in range(len(got))] == want
        within_a_block([s for s, _ in want], begins, parts, blocks)


@pytest.mark.parametrize(("blocks", "parts"), [({"a": 400, "b": 10}, {"a": 5, "b": 5}), ({"hot": 130, None: 70, "x": 21, "y": 3}, {"hot": 2, None: 3, "x": 5, "y": 40})])
def test_mixture_keeps_the_target_weights(spark, blocks, parts):
    """Texts of one block each: the order of the rows is the order of the blocks."""
    rows = [(i, "t", s) for i, s in enumerate(s for s, n in blocks.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mixed(docs, parts, block_bytes=1).orderBy("position").collect()
    ordered = dict(sorted(parts.items(), key=lambda kv: (kv[0] is not None, kv[0] or "")))
    want, begins = brute_mixture({s: blocks[s] for s in ordered}, ordered)
    assert [(r["source"], r["block"]) for r in got] == want and [r["slot"] for r in got] == list(range(len(rows)))
    within_a_block([r["source"] for r in got], begins, ordered, blocks)


def test_rows_without_ids_have_places_of_their_own(spark):
    rows = [(None, f"text {i % 700}", "ab"[i % 2]) for i in range(1500)] + [(7, "same", "a")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    ordered = mixing.in_mixed_order(docs, {"a": 1, "b": 3}, block_bytes=64)
    placed = mixing.mixed(docs, {"a": 1, "b": 3}, block_bytes=64).orderBy("position").collect()
    got = ordered.collect()
    assert Counter(map(tuple, got)) == Counter(rows) and [r["position"] for r in placed] == list(range(len(rows)))
    assert [r["source"] for r in got] == [r["source"] for r in placed]
    sizes = ordered.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 900


def test_slot_table_too_large_to_send(spark, monkeypatch):
    docs = frame(spark, many_rows(6))
    sent = mixing.mixed(docs, {"hot": 3, "a": 2}, block_bytes=2000).collect()
    monkeypatch.setattr(mixing, "BROADCAST_SLOTS", 0)
    assert Counter(mixing.mixed(docs, {"hot": 3, "a": 2}, block_bytes=2000).drop("position").collect()) == Counter(r[:7] for r in sent)


def test_mixture_is_whole_and_even(spark):
    rows = many_rows(4)
    docs = frame(spark, rows)
    got = mixing.mixed(docs, {"hot": 3, "a": 2}, block_bytes=2000).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert [r["slot"] for r in got] == sorted(r["slot"] for r in got)
    by_slot = defaultdict(set)
    last = {}
    for r in got:
        by_slot[r["slot"]].add((r["source"], r["block"]))
        assert r["release"] <= r["slot"] < r["deadline"] and last.get(r["source"], -1) <= r["block"]
        last[r["source"]] = r["block"]
    assert all(len(v) == 1 for v in by_slot.values())
    ordered = mixing.in_mixed_order(docs, {"hot": 3, "a": 2}, block_bytes=2000)
    assert ordered.columns == docs.columns and ordered.exceptAll(docs).count() == 0 and ordered.count() == len(rows)
    assert [r["doc_id"] for r in ordered.collect()] == [r["doc_id"] for r in got]
    assert mixing.mixed(docs.where("false")).count() == 0 and mixing.in_mixed_order(docs.where("false")).count() == 0


def test_many_small_sources_are_a_group(spark):
    """Sources of one block and one part take the slots that the others leave, in their share."""
    rows = [(i, "x" * 400, f"s{i}") for i in range(90)] + [(1000 + i, "y" * 700, [None, "big"][i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mixed(docs, {None: 20, "big": 10}, block_bytes=1000).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(rows))) and Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    owners, last = defaultdict(set), {}
    for r in got:
        owners[r["slot"]].add((r["source"], r["block"]))
        assert r["release"] <= r["slot"] < r["deadline"] and last.get(r["source"], -1) <= r["block"]
        last[r["source"]] = r["block"]
    assert all(len(v) == 1 for v in owners.values()) and [r["slot"] for r in got] == sorted(r["slot"] for r in got)
    firsts = [r["source"] for r in sorted(got, key=lambda r: r["slot"])]
    assert abs(sum(s not in (None, "big") for s in firsts[:60]) - 45) < 8
    none = spark.createDataFrame(rows[:90], "doc_id long, text string, source string")
    assert sorted(r["slot"] for r in mixing.mixed(none, block_bytes=1000).collect()) == list(range(90))


def test_last_stage_knows_the_order_of_the_files(spark, folder):
    import corpus_pipeline

    frame(spark, many_rows(5)).where("doc_id is not null").dropDuplicates(["doc_id"]).write.parquet(folder + "/docs")
    docs = spark.read.parquet(folder + "/docs")
    place = {r["doc_id"]: r["position"] for r in mixing.mixed(docs, block_bytes=2000).collect()}
    mixing.in_mixed_order(docs, block_bytes=2000).write.parquet(folder + "/mixed")
    again = spark.read.parquet(folder + "/mixed")
    got = corpus_pipeline.STAGES[-1][1](spark, again, None)
    assert got.columns == [*corpus_pipeline.COLUMNS, "shard", "position"] or got.columns == [*corpus_pipeline.COLUMNS, "position", "shard"]
    assert {r["doc_id"]: r["position"] for r in got.collect()} == place
    moved = docs.repartition(2)
    assert mixing.with_position(moved).columns == moved.columns
