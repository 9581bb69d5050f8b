import pytest
from pyspark.sql import functions as F

from flowtables.operators.snapshot import merge_snapshot
from flowtables.session import scratch_dir
from flowtables.sinks import bulk, files, replicate
from flowtables.sources import changelog, incremental
from flowtables.streaming import snapshot as stream
from flowtables.streaming.versions import complete_batches


@pytest.mark.parametrize("top,offset,start,expected", [
    (None, None, None, ("error", "maxIndex == null", None, None)),
    (5, 9, None, ("error", "maxIndex < startIndex", None, None)),
    (5, 5, None, ("nonExecutable", "maxIndex == startIndex", None, None)),
    (50, 5, 1, ("executable", None, 6, 15)),
    (12, 5, None, ("executable", None, 6, 12)),
    (50, None, 20, ("executable", None, 21, 30)),
    (50, None, None, ("executable", None, 41, 50)),
])
def test_plan(spark, top, offset, start, expected):
    df = spark.range(0 if top is None else top + 1)
    r = incremental.plan_batch(df, "id", 10, offset, start).first()
    assert (r.outcome, r.reason, r.from_id, r.to_id) == expected and r.max_index == top
    ids = [x.id for x in incremental.read_batch(df, "id", 10, offset, start).collect()]
    assert sorted(ids) == (list(range(expected[2], expected[3] + 1)) if expected[2] else [])


def test_listener_steps(spark, folder):
    seen, offsets = [], f"{folder}/offsets"
    for top in (25, 25, 25, 25, 31):
        step = incremental.next_step(spark, spark.range(1, top + 1), "id", 10, offsets, start_index=0)
        if step.rows is not None:
            seen.append(sorted(r.id for r in step.rows.collect()))
            incremental.save_offset(spark, offsets, step.offset)
        else:
            assert step.outcome == "nonExecutable"
    assert seen == [list(range(1, 11)), list(range(11, 21)), list(range(21, 26)), list(range(26, 32))]


def test_segments(spark):
    online = spark.createDataFrame([(1, 100, 200, 3), (2, 200, 300, 4)], "group_no int, first_change long, next_change long, first_time int")
    members = spark.createDataFrame([(1, "o1"), (2, "o2"), (2, "o2b")], "group_no int, member string")
    archived = spark.createDataFrame(
        [("a0", 0, 50, 1), ("a1", 50, 100, 2), ("a2", 100, 200, 3)], "member string, first_change long, next_change long, first_time int")

    def pick(scn):
        return [r.member for r in changelog.select_segments(online, archived, members, scn).collect()]
    assert pick(250) == ["o2", "o2b"]
    assert pick(200) == ["o2", "o2b"]
    assert pick(150) == ["o2", "o2b", "o1"]
    assert pick(60) == ["o2", "o2b", "o1", "a1"]
    assert pick(0) == ["o2", "o2b", "o1", "a1", "a0"]
    assert pick(300) == []


SCHEMA = "k string, seq long, operation string, doc string"


def test_snapshot_stream(spark, folder):
    pieces = [
        [("a", 1, "insert", "a1"), ("a", 2, "insert", "a2"), ("b", 3, "insert", "b1")],
        [("b", 4, "delete", None), ("c", 5, "insert", "c1")],
        [("b", 6, "insert", "b2"), ("c", 7, "delete", None), ("z", 8, "delete", None)],
    ]
    expected = [{"a": "a2", "b": "b1"}, {"a": "a2", "c": "c1"}, {"a": "a2", "b": "b2"}]
    schema = spark.createDataFrame([], SCHEMA).schema
    for i, piece in enumerate(pieces):
        spark.createDataFrame(piece, SCHEMA).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(schema).parquet(f"{folder}/in")
        stream.start_apply(source, f"{folder}/t", f"{folder}/ck", keys=["k"]).awaitTermination()
        if i == 1:
            assert stream.compact(spark, f"{folder}/t", schema, keys=["k"]) == complete_batches(spark, f"{folder}/t/delta")[-1]
        rows = stream.read_snapshot(spark, f"{folder}/t", schema, keys=["k"]).collect()
        assert {r.k: r.doc for r in rows} == expected[i]


@pytest.mark.parametrize("codec", ["NONE", "DEFAULT", "BZIP", "GZIP", "LZ4", "SNAPPY"])
def test_document_files_and_path_delete(spark, folder, codec):
    df = spark.createDataFrame([("myfilename", "insert", "myfilecontent")], "filename string, operation string, content string")
    path = f"{folder}/docs"
    files.write_documents(df, path, codec)
    assert spark.read.schema(df.schema).json(path).collect() == df.collect()
    assert files.delete_path(spark, path) and not files.delete_path(spark, path)


def test_keyed_file_insert_then_delete(spark):
    schema = "filename string, seq long, operation string, content string"
    empty = spark.createDataFrame([], schema)
    first = merge_snapshot(empty, spark.createDataFrame([("myfilename", 1, "insert", "x")], schema), keys=["filename"])
    assert [r.content for r in first.collect()] == ["x"]
    second = merge_snapshot(first, spark.createDataFrame([("myfilename", 2, "Delete", None)], schema), keys=["filename"])
    assert second.count() == 0


def test_bulk_files(spark, folder):
    df = spark.createDataFrame([(2, "l2"), (1, "l1\nd1")], "seq long, body string")
    bulk.write_bulk(df, f"{folder}/bulk", "gzip")
    assert [r.value for r in spark.read.text(f"{folder}/bulk").collect()] == ["l1", "d1", "l2"]


def test_replicate(spark, folder):
    replicate.replicate(spark.range(5), f"{folder}/t", compression="gzip")
    assert spark.read.parquet(f"{folder}/t").count() == 5


def test_scratch_folder_follows_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
