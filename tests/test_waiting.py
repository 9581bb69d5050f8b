"""The commit gate with bucketed deltas: against brute force, and what a batch writes."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables.streaming import waiting
from flowtables.streaming.versions import complete_batches

SCHEMA = "scn long, xid string, operation_code int, payload string"


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder + "/log")
    stream = spark.readStream.schema(SCHEMA).parquet(folder + "/log")
    waiting.start_committed_deltas(stream, folder + "/out", folder + "/waiting", folder + "/ck", buckets=4).awaitTermination()
    return stream.schema


@pytest.mark.parametrize("folds", [(), (1, 3)])
def test_released_and_waiting_changes(spark, folder, folds):
    """Ids that are used again, have no id, or end in the batch of their changes; folds between runs change nothing."""
    rng = random.Random(len(folds))
    rows = [(i, rng.choice(["a", "b", "c", None, "long"]), 1, f"p{i}") for i in range(150)]
    rows = [(s, x, rng.choice([7, 7, 36]) if x != "long" and rng.random() < 0.12 else c, p) for s, x, c, p in rows]
    for run in range(5):
        schema = feed(spark, folder, rows[run * 30 : run * 30 + 30])
        if run in folds:
            last = waiting.fold(spark, folder + "/waiting", schema)
            assert complete_batches(spark, folder + "/waiting/rows") == complete_batches(spark, folder + "/waiting/decided") == []
            assert waiting.fold(spark, folder + "/waiting", schema) == last
    held, want = {}, []
    for s, x, c, _ in rows:
        if c == 1:
            held.setdefault(x, []).append(s)
        else:
            want += [(s, e) for e in held.pop(x, []) if c == 7]
    got = [(r["commit_scn"], r["scn"]) for r in spark.read.parquet(folder + "/out").collect()]
    assert sorted(got) == sorted(want)
    left = waiting.undecided(spark, folder + "/waiting", schema)
    assert sorted(r["scn"] for r in left.collect()) == sorted(s for h in held.values() for s in h) and len(held["long"]) > 10


def test_an_open_transaction_is_written_once(spark, folder):
    for run in range(6):
        feed(spark, folder, [(run * 100 + i, "open" if i < 80 else f"t{run}", 7 if i == 99 else 1, "x") for i in range(100)])
    batches = complete_batches(spark, folder + "/waiting/rows")
    sizes = [spark.read.parquet(f"{folder}/waiting/rows/batch={b}").count() for b in batches]
    assert len(batches) == 6 and sizes == [80] * 6
    schema = feed(spark, folder, [(1000, "open", 7, "x")])
    assert spark.read.parquet(folder + "/out").where("xid = 'open'").count() == 480
    assert spark.read.parquet(folder + "/out").agg(F.countDistinct("scn")).first()[0] == 480 + 6 * 19
    assert waiting.undecided(spark, folder + "/waiting", schema).count() == 0
    assert waiting.fold(spark, folder + "/none", schema) is None


def test_a_repeated_batch_changes_nothing(spark, folder):
    import os

    rows = [(i, "ab"[i % 2], 7 if i % 25 == 24 else 1, "x") for i in range(90)]
    feed(spark, folder, rows[:40])
    feed(spark, folder, rows[40:])
    before = sorted(map(str, spark.read.parquet(folder + "/out").collect()))
    for name in ("1", ".1.crc"):  # as if the run had died before its commit
        os.remove(f"{folder}/ck/commits/{name}")
    feed(spark, folder, [(200, "zz", 1, "x")])
    assert sorted(map(str, spark.read.parquet(folder + "/out").collect())) == before
