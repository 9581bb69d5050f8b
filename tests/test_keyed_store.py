"""The keyed store against a plain dictionary: runs, folds, removal, lookups, repeated and late changes."""

import glob
import os
import random

import pytest
from pyspark.sql.types import StructType

from flowtables.streaming import keyed_store as ks
from flowtables.streaming.versions import complete_batches



def fields(**types):
    out = StructType()
    for name, kind in types.items():
        out.add(name, kind)
    return out


SCHEMA = fields(k="string", part="string", seq="long", operation="string", doc="string")


def store(folder, **options):
    return ks.Store(folder + "/store", SCHEMA, keys=("k", "part"), **{"buckets": 8, **options})


def changes(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def size(path):
    return sum(os.path.getsize(p) for p in glob.glob(path + "/**/*.parquet", recursive=True))


def current(df):
    return sorted(((r["k"], r["part"], r["seq"], r["doc"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 3])
def test_a_stream_of_batches_equals_a_dictionary(spark, folder, parts):
    """Late, repeated and tied changes, null parts of keys, deletes of absent keys; folds and removal between runs."""
    rng, s, table = random.Random(parts), store(folder, parts=parts), {}
    for batch in range(8):
        rows = []
        for _ in range(40):
            key = (rng.choice(["a", "b", None, "hot", "hot"]) if rng.random() < 0.5 else f"x{rng.randrange(60)}", rng.choice(["p", None]))
            rows.append((*key, rng.randrange(1, 400), rng.choice(["insert", "delete", "DELETE", None]), f"d{rng.random()}"))
        rows = list({(r[0], r[1], r[2]): r for r in rows}.values())  # one change per key and seq in a batch
        for r in rows:
            had = table.get(r[:2])
            if had is None or r[2] >= had[2]:
                table[r[:2]] = r
        ks.write_run(s, changes(spark, rows), batch)
        if batch in (2, 3, 6):
            assert ks.fold(spark, s)
            ks.clean(spark, s)
            assert complete_batches(spark, s.folder("runs")) == [batch]
    want = sorted(((*r[:3], r[4]) for r in table.values() if (r[3] or "").lower() != "delete"), key=str)
    assert current(ks.read_store(spark, s)) == want
    asked = [k for k in table if k[0] in (None, "hot", "x1", "x2")]
    found = ks.lookup(s, spark.createDataFrame([(*k, "more") for k in asked] * 2 + [("no", "no", "more")], "k string, part string, more string"))
    assert current(found) == [w for w in want if (w[0], w[1]) in asked]
    ks.fold(spark, s, whole=True)
    ks.clean(spark, s)
    assert complete_batches(spark, s.folder("runs")) == [] and current(ks.read_store(spark, s)) == want


def test_a_fold_writes_the_touched_buckets_only(spark, folder):
    s = store(folder)
    ks.write_run(s, changes(spark, [(f"k{i}", None, 1, "insert", f"{i}" * 50) for i in range(4000)]), 0)
    assert ks.fold(spark, s) == []  # the newest run stays
    ks.write_run(s, changes(spark, [("k5", None, 2, "insert", "new")]), 1)
    assert ks.fold(spark, s) == list(range(8))
    whole = size(f"{s.folder('base')}/batch=0")
    ks.write_run(s, changes(spark, [("k5", None, 3, "insert", "newer")]), 2)
    assert len(ks.fold(spark, s)) == 1
    assert 0 < size(f"{s.folder('base')}/batch=1") < whole / 5
    ks.clean(spark, s, keep=2)
    assert size(f"{s.folder('base')}/batch=0") == whole
    ks.clean(spark, s)
    assert whole * 0.7 < size(f"{s.folder('base')}/batch=0") < whole
    assert ks.read_store(spark, s).count() == 4000
    assert ks.read_store(spark, s).where("k = 'k5'").first()["doc"] == "newer"
    assert ks.read_store(spark, s, before=2).where("k = 'k5'").first()["doc"] == "new"


def test_marks_of_deleted_keys_stay_until_settled(spark, folder):
    s = store(folder)
    ks.write_run(s, changes(spark, [("a", None, 5, "delete", None), ("b", None, 9, "delete", None)]), 0)
    ks.fold(spark, s, settled=5, whole=True)
    ks.write_run(s, changes(spark, [("a", None, 4, "insert", "back"), ("b", None, 8, "insert", "late")]), 1)
    assert [r["k"] for r in ks.read_store(spark, s).collect()] == ["a"]
    ks.fold(spark, s, settled=100, whole=True)
    ks.clean(spark, s)
    assert [r["k"] for r in ks.read_store(spark, s).collect()] == ["a"]


def test_second_order_column_repeats_and_empty_batches(spark, folder):
    s = ks.Store(folder + "/store", fields(k="string", scn="long", row="integer", doc="string"), keys=("k",), order=("scn", "row"), op=None, buckets=4)
    make = lambda rows: spark.createDataFrame(rows, s.schema)
    assert ks.read_store(spark, s).count() == 0 and ks.fold(spark, s) == []
    ks.write_run(s, make([("a", 1, 2, "second"), ("a", 1, 1, "first"), ("a", None, 9, "none")]), 0)
    ks.write_run(s, make([]), 1)
    for _ in range(2):  # a restart repeats the batch
        ks.write_run(s, make([("a", 1, 1, "late"), ("b", 1, 1, "b")]), 2)
        ks.fold(spark, s)
    assert sorted((r["k"], r["doc"]) for r in ks.read_store(spark, s).collect()) == [("a", "second"), ("b", "b")]
    with pytest.raises(ValueError, match="another number"):
        ks.write_run(ks.Store(s.root, s.schema, keys=("k",), order=("scn",), op=None, buckets=5), make([]), 3)
    with pytest.raises(ValueError, match="kept for the store"):
        ks.Store(s.root, fields(k="string", Bucket="integer"), keys=("k",))
