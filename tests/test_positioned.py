"""The positioned stream: batches end at borders, restarts lose and repeat nothing."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables.sources import changelog, positioned
from flowtables.sources.positioned import PositionedLog, PositionedReader
from flowtables.streaming import gate


def write(spark, rows, folder, schema="pos long, v string, at timestamp", files=3):
    df = spark.createDataFrame([(p, v, None) for p, v in rows], schema).withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000.5)))
    df.repartition(files).write.mode("append").parquet(folder)
    return df.schema


def run(spark, folder, schema, max_rows, **options):
    """One run; gives the rows of each batch so far."""
    spark.dataSource.register(PositionedLog)
    log = spark.readStream.format("positioned_log").schema(schema).options(
        path=folder + "/log", position="pos", max_rows=str(max_rows), progress=folder + "/progress", **options).load()
    query = log.writeStream.foreachBatch(lambda rows, i: rows.withColumn("batch", F.lit(i)).write.mode("overwrite").parquet(f"{folder}/out/b={i}"))
    query = query.option("checkpointLocation", folder + "/checkpoint").start()
    query.processAllAvailable()
    query.stop()
    batches = {}
    for r in spark.read.parquet(folder + "/out").collect():
        batches.setdefault(r["batch"], []).append((r["pos"], r["v"]))
    return [sorted(batches[b]) for b in sorted(batches)]


@pytest.mark.parametrize("binary", [False, True])
def test_batches_end_at_borders_over_restarts(spark, folder, binary):
    rng = random.Random(1)
    at = 0
    rows = []
    for i in range(400):
        at += rng.choice([0, 0, 0, 1, 5, 10**10])  # many rows share a position
        rows.append((at.to_bytes(10, "big") if binary else at - 10**11, f"v{i}"))
    cut = next(i for i in range(200, 400) if rows[i][0] != rows[i - 1][0])
    kind = "binary" if binary else "long"
    batches = []
    for part in (rows[:cut], rows[cut:], []):
        schema = write(spark, part, folder + "/log", f"pos {kind}, v string, at timestamp") if part else schema
        batches = run(spark, folder, schema, 30)
    plain = [[(bytes(p) if binary else p, v) for p, v in b] for b in batches]
    assert sorted(x for b in plain for x in b) == sorted(rows)
    for i, b in enumerate(plain):
        assert i == 0 or plain[i - 1][-1][0] < b[0][0]
        assert len([p for p, _ in b if p != b[-1][0]]) < 30
    assert len(plain) >= 8 and max(map(len, plain)) < 30 + max([p for p, _ in rows].count(p) for p, _ in rows)


def test_start_after_a_position_and_rows_without_one(spark, folder):
    rows = [(None, "x"), *[(i, f"v{i}") for i in range(50)], (None, "y")]
    schema = write(spark, rows, folder + "/log")
    batches = run(spark, folder, schema, 7, after="20")
    assert sorted(x for b in batches for x in b) == [(i, f"v{i}") for i in range(21, 50)] and len(batches) == 5


def test_a_crash_between_promise_and_offset_log_loses_nothing(spark, folder):
    """An end that was written down but never reached Spark makes the next batch larger, no more."""
    schema = write(spark, [(i, f"v{i}") for i in range(40)], folder + "/log")
    options = {"path": folder + "/log", "position": "pos", "max_rows": "10", "progress": folder + "/progress"}
    lost = PositionedReader(schema, options)
    assert lost.latestOffset() == {"after": "9"} and lost.latestOffset() == {"after": "19"}
    (last,) = [n for n in lost.progress.names(".json") if n.endswith("1.json")]
    with open(last.replace("01.json", "02.json"), "w") as half:
        half.write('{"aft')
    batches = run(spark, folder, schema, 10)
    assert sorted(x for b in batches for x in b) == [(i, f"v{i}") for i in range(40)] and len(batches[0]) == 30


def test_only_due_row_groups_are_read(spark, folder):
    schema = write(spark, [(i, "v") for i in range(100)], folder + "/log", files=1)
    for k in range(1, 5):
        write(spark, [(1000 * k + i, "v") for i in range(100)], folder + "/log", files=1)
    reader = PositionedReader(schema, {"path": folder + "/log", "position": "pos", "max_rows": "50"})
    assert reader.initialOffset() == {"after": ""} and reader.latestOffset() == {"after": "49"}
    assert len(reader.partitions({"after": ""}, {"after": "49"})) == 1 and reader.partitions({"after": ""}, {"after": ""}) == []
    read = []
    reader._positions = lambda group, low: read.append(group) or PositionedReader._positions(reader, group, low)
    assert reader.latestOffset() == {"after": "99"} and len(read) == 1
    assert len(reader.partitions({"after": "49"}, {"after": "2050"})) == 3


def test_options_are_checked_and_no_files_are_no_rows(spark, folder):
    schema = write(spark, [(1, "v")], folder + "/log")
    assert PositionedLog({"path": folder + "/log"}).schema().names == ["pos", "v", "at"]
    with pytest.raises(ValueError):
        PositionedReader(schema, {"path": folder, "position": "v"})
    with pytest.raises(ValueError):
        PositionedReader(schema, {"path": folder, "position": "pos", "max_rows": "0"})
    with pytest.raises(ValueError):
        PositionedLog({"path": folder + "/none"}).schema()
    assert PositionedReader(schema, {"path": folder + "/none", "position": "pos", "after": "5"}).latestOffset() == {"after": "5"}
    assert positioned.Files(f"file://{folder}/log").names() == positioned.Files(folder + "/log").names() != []


def test_gate_over_a_positioned_stream(spark, folder):
    """Changes wait for a commit that a later bounded batch brings."""
    rows = [(i, f"t{i % 4}", changelog.COMMIT_CODE if i > 80 and i % 20 < 4 else 1) for i in range(160)]
    df = spark.createDataFrame(rows, "scn long, xid string, operation_code int")
    df.repartitionByRange(4, "scn").write.parquet(folder + "/log")
    spark.dataSource.register(PositionedLog)
    log = spark.readStream.format("positioned_log").schema(df.schema).options(path=folder + "/log", position="scn", max_rows="25", progress=folder + "/p").load()
    query = gate.start_committed(log, folder + "/out", folder + "/pending", folder + "/ck", trigger={"processingTime": "0 seconds"})
    query.processAllAvailable()
    query.stop()
    got = {(r["scn"], r["commit_scn"]) for r in spark.read.parquet(folder + "/out").collect()}
    ends = {x: [n for n, t, c in rows if t == x and c == changelog.COMMIT_CODE] for x in ("t0", "t1", "t2", "t3")}
    want = {(n, next((e for e in ends[x] if e >= n), None)) for n, x, c in rows if c == 1}
    assert got == {w for w in want if w[1] is not None} and len(spark.read.parquet(folder + "/out").select("batch").distinct().collect()) > 2


@pytest.mark.parametrize("spread", [1, 5000, 2**43])
def test_ends_of_batches_are_found_by_counts(spark, folder, spread):
    """Row groups that overlap, with positions that repeat: every end is that of the sorted positions, and no list of them is held."""
    rng = random.Random(spread)
    positions = [rng.randrange(-400, 400) * spread + rng.choice([0, 1, spread - 1]) for _ in range(1500)]
    schema = write(spark, [(p, "v") for p in positions] + [(None, "n")], folder + "/log", files=5)
    reader = PositionedReader(schema, {"path": folder + "/log", "position": "pos", "max_rows": "170"})
    left, got, want = sorted(positions), [], []
    while left:
        want.append(left[min(170, len(left)) - 1])
        left = [p for p in left if p > want[-1]]
        got.append(int(reader.latestOffset()["after"]))
    assert got == want and reader.latestOffset() == {"after": str(want[-1])}
    assert not isinstance(reader._positions(reader._row_groups()[0], None), list)
