"""Number audit and image pairing on streams, against plain loops; repeated batches, folds, expiry."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from flowtables.operators.fix import sequence_gaps
from flowtables.plans.derived import lsn
from flowtables.streaming import keyed_store as ks, pairing, sequences

MESSAGES = "session string, at long, seq int, kind string"


def audit(spark, folder, rows, **options):
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = spark.readStream.schema(MESSAGES).parquet(folder + "/in")
    sequences.start_sequence_audit(stream, ["session"], "seq", folder + "/out", folder + "/state", folder + "/ck", buckets=4, **options).awaitTermination()


def breaks(df):
    return sorted(((r["session"], r["seq"], r["prev_seq"], r["missing"]) for r in df.collect()), key=str)


def test_audit_with_resets_against_a_loop(spark, folder):
    """Numbers that skip, repeat, go back or are missing; logons start anew; a null session; the state is folded on the way."""
    rng, last, want, at = random.Random(3), {}, [], 0
    for run in range(5):
        rows = []
        for _ in range(60):
            at += 1
            s = rng.choice(["hot", "hot", "hot", "b", None, f"s{run}"])
            kind = rng.choice(["A", "D", "D", "D", "D", "D"])
            prev = last.get(s)
            seq = rng.choice([None, 1, rng.randrange(50)]) if rng.random() < 0.3 else (prev or 0) + 1
            rows.append((s, at, seq, kind))
            if seq is None:
                continue
            if prev is not None and kind != "A" and seq - prev != 1:
                want.append((s, seq, prev, seq - prev - 1))
            last[s] = seq
        rng.shuffle(rows)
        audit(spark, folder, rows, pos="at", reset=F.col("kind") == "A", fold_every=2)
    assert any(w[3] > 0 for w in want) and any(w[3] == -1 for w in want) and any(w[3] < -1 for w in want)
    assert breaks(spark.read.parquet(folder + "/out")) == sorted(want, key=str)


def test_audit_of_batches_equals_the_batch_operator_and_repeats_change_nothing(spark, folder):
    rng = random.Random(4)
    rows = sorted((rng.choice(["a", "b"]), i, i // 2 if i % 7 else i // 2 + 3, "D") for i in range(200))
    rows.sort(key=lambda r: (r[2], r[1]))
    parts = [rows[i : i + 50] for i in range(0, 200, 50)]
    for n, part in enumerate(parts):
        audit(spark, folder, part)
        if n == 2:  # as if the driver was lost before it noted the end of the batch
            shutil.move(folder + "/ck/commits/2", folder + "/ck/2.lost")
            for crc in (folder + "/ck/commits/.2.crc",):
                shutil.move(crc, folder + "/ck/2.crc.lost")
    want = sequence_gaps(spark.createDataFrame(rows, MESSAGES), ["session"], "seq")
    assert breaks(spark.read.parquet(folder + "/out")) == breaks(want)


IMAGES = "trx_time timestamp_ntz, start_lsn binary, seqval binary, operation int, Id int, row string"
COLUMNS = [("Id", "int"), ("row", "nchar")]


@pytest.fixture
def feed(spark, folder):
    import datetime as dt

    def run(*items):
        data = [(dt.datetime(2021, 3, 25), lsn(l), lsn(s), op, i, text) for l, s, op, i, text in items]
        spark.createDataFrame(data, IMAGES).coalesce(1).write.mode("append").parquet(folder + "/in")
        stream = spark.readStream.schema(IMAGES).parquet(folder + "/in")
        pairing.start_row_changes(
            stream, folder + "/out", folder + "/state", folder + "/ck", COLUMNS, ["Id"], "dbo", "T", buckets=4, fold_every=3).awaitTermination()
        return pairing.waiting_images(stream.schema, folder + "/state", 4)

    return run


def test_pairs_over_batches(spark, folder, feed):
    """An after image one, and five, batches later; both in one batch; none before; a before image alone expires."""
    feed((1, 1, 3, 1, "a"), (1, 2, 3, 2, "b"), (1, 3, 3, 3, "c"), (1, 3, 4, 3, "C"), (1, 9, 2, 9, "new"))
    feed((1, 1, 4, 1, "A"), (2, 1, 3, 4, "never"))
    feed((3, 1, 4, 5, "alone"), (1, 9, 1, 9, "gone"))
    feed()
    store = feed((5, 1, 3, 6, "late"))
    assert sorted(r["row"]["row"] for r in ks.read_store(spark, store).collect()) == ["b", "late", "never"]
    feed((1, 2, 4, 2, "B"))
    got = {(r["operation"], r["data"][0]): (r["before"] and r["before"][1], r["data"][1]) for r in spark.read.parquet(folder + "/out").collect()}
    assert got == {("insert", "9"): (None, "new"), ("delete", "9"): (None, "gone"), ("update", "1"): ("a", "A"), ("update", "2"): ("b", "B"),
                   ("update", "3"): ("c", "C"), ("update", "5"): (None, "alone")}
    assert spark.read.parquet(folder + "/out").count() == 6
    assert sorted(r["row"]["row"] for r in ks.read_store(spark, store).collect()) == ["late", "never"]
    ks.fold(spark, store, settled=lsn(4), whole=True, expired=F.col("start_lsn") < F.lit(lsn(4)))
    ks.clean(spark, store)
    assert [r["row"]["row"] for r in ks.read_store(spark, store).collect()] == ["late"]
    feed((5, 1, 4, 6, "LATE"), (2, 1, 4, 4, "too late"))
    last = {r["data"][1]: r["before"] for r in spark.read.parquet(folder + "/out").where("batch >= 6").collect()}
    assert last["LATE"][1] == "late" and last["too late"] is None
