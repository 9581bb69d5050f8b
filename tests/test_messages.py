import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from flowtables.functions.ordered import next_value, previous_value, row_position
from flowtables.operators import bundles
from flowtables.plans import catalog
from flowtables.sinks import topics as sink
from flowtables.sources import frames, topics

MESSAGES = [("t1", 1, b"a"), ("t2", 2, b"b"), ("t1", 3, b""), ("t1", 4, b"d"), ("x", 5, b"e")]


def log(spark, rows=MESSAGES):
    return spark.createDataFrame([(t, i, bytearray(p)) for t, i, p in rows], "topic string, msg_id long, payload binary")


def ids(df):
    return [r.msg_id for r in df.collect()]


def test_positioned_read(spark):
    """Each topic is read by itself, from its own position."""
    rows = [("b", i, b"other") for i in range(1, 7)] + [("a", i, b"x") for i in range(1, 6)]
    df = spark.createDataFrame(rows, "topic string, msg_id long, payload binary")
    assert ids(topics.read_from(df, "a", max_messages=2)) == [1, 2]
    assert ids(topics.read_from(df, "a", position=2, initial=4)) == [3, 4, 5]
    assert ids(topics.read_from(df, "a", initial=4)) == [5] and ids(topics.read_from(df, "b", initial=4)) == [5, 6]
    assert {r["topic"] for r in topics.read_from(df, "b").collect()} == {"b"}
    assert topics.next_position(topics.read_from(df, "a", position=2), 2).first()[0] == 5
    assert topics.next_position(topics.read_from(df, "a", position=5), 5).first()[0] == 5


def test_subscription(spark):
    df = log(spark)
    assert sorted(ids(topics.subscribe(df, topics="t1, t2"))) == [1, 2, 4]
    assert sorted(ids(topics.subscribe(df, pattern="t.*"))) == [1, 2, 4]
    for bad in ({}, {"topics": "a", "pattern": "b"}, {"topics": " , "}):
        with pytest.raises(ValueError):
            topics.subscribe(df, **bad)


def framed(spark, content, **options):
    df = spark.createDataFrame([("s", bytearray(content))], "stream string, content binary")
    return [(r.pos, r.record) for r in frames.frame(df, **options).collect()]


def test_framing(spark):
    feed = b"068\xffSTOCK1\xff8.43\xff\r\n069\xffSTOCK2\xff8.43\xff\r\npartial"
    assert framed(spark, feed) == [(0, "068STOCK18.43"), (1, "069STOCK28.43")]
    assert framed(spark, feed, strip_bytes=(10, 13), charset="ISO-8859-1")[0] == (0, "068\xffSTOCK1\xff8.43\xff")
    assert framed(spark, "é\t|\n ü \n".encode(), demarcator=ord("|")) == [(0, "é")]
    assert framed(spark, b"caf\xe9\nok\n")[1] == (1, "ok")  # malformed bytes do not fail the job
    assert framed(spark, b"no end") == [] and framed(spark, b"") == []
    assert framed(spark, b"\n\na\n") == [(0, ""), (1, ""), (2, "a")]


def test_bundle_by_count(spark):
    df = spark.createDataFrame([("k", i, f"r{i}") for i in (9, 3, 5, 7, 1)], "k string, pos long, record string")
    for dense_width in (2, 100):
        out = bundles.bundle_by_count(df, ["k"], "pos", "record", size=2, demarcator="|", width=dense_width)
        assert sorted(map(tuple, out.collect())) == [("k", 0, 2, "r1|r3|"), ("k", 1, 2, "r5|r7|"), ("k", 2, 1, "r9|")]


def greedy(sizes, messages, nbytes, times=None, seconds=None):
    starts, start, count, total = [], 0, 0, 0
    for i, s in enumerate(sizes):
        late = seconds is not None and times[i] - times[start] >= seconds
        if count and (count >= messages or total + s > nbytes or late):
            start, count, total = i, 0, 0
        if not count:
            start = i
        count, total = count + 1, total + s
        starts.append(start)
    return starts


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 12), min_size=1, max_size=60), st.integers(1, 5), st.integers(5, 20), st.integers(5, 9))
def test_greedy_bundles_against_brute_force(spark, sizes, messages, nbytes, chunk):
    rows = [("k", i * 3, s, float(i * s % 7 + i)) for i, s in enumerate(sizes)] + [("other", 1, 1, 0.0)]
    times = sorted(r[3] for r in rows[:-1])
    rows = [(k, p, s, times[i] if k == "k" else 0.0) for i, (k, p, s, _) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, pos long, size int, t double").withColumn("t", F.timestamp_seconds("t"))
    out = bundles.bundle_greedy(df, ["k"], "pos", "size", messages, nbytes, 4.0, "t", chunk=chunk, width=20)
    got = [r.bundle_start for r in sorted(out.where("k = 'k'").collect(), key=lambda r: r.position)]
    assert got == greedy(sizes, messages, nbytes, times, 4.0)


def test_split_messages(spark):
    df = spark.createDataFrame([(1, "a.b..c")], "id int, content string")
    assert [(r.pos, r.message) for r in bundles.split_messages(df, "content", ".").collect()] == [(0, "a"), (1, "b"), (2, ""), (3, "c")]


def test_ordered_helpers_with_hot_and_null_keys(spark):
    rows = [(None if i % 3 else "hot", i * 7 % 100, i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, pos long, v int")
    by_key = {}
    for k, p, v in sorted(rows, key=lambda r: r[1]):
        by_key.setdefault(k, []).append((p, v))
    for width in (1, 9, 1000):
        ranked = {(r.k, r.pos): r.row_pos for r in row_position(df, ["k"], "pos", width=width).collect()}
        prev = {(r.k, r.pos): r.p for r in previous_value(df, ["k"], "pos", "v", "p", width=width).collect()}
        mark = F.when(F.col("v") % 10 == 0, F.col("v"))
        nxt = {(r.k, r.pos): r.n for r in next_value(df, ["k"], "pos", mark, "n", width=width).collect()}
        assert len(ranked) == len(prev) == len(nxt) == 100
        for k, items in by_key.items():
            for i, (p, v) in enumerate(items):
                assert ranked[k, p] == i
                assert prev[k, p] == (items[i - 1][1] if i else None)
                assert nxt[k, p] == next((w for _, w in items[i:] if w % 10 == 0), None)


def test_routes(spark):
    df = spark.createDataFrame([(p, p * p) for p in (5, 1, 9, 3)], "pos long, key long")
    robin = sink.route(df, "RoundRobin", 3, pos="pos", width=2)
    assert {r.pos: r.partition_id for r in robin.collect()} == {1: 0, 3: 1, 5: 2, 9: 0}
    assert {r.partition_id for r in sink.route(df, "Single", 3).collect()} == {0}
    assert {r.pos: r.partition_id for r in sink.route(df, "Custom", 4, key=F.col("key")).collect()} == {5: 1, 1: 1, 9: 1, 3: 1}
    for bad in (("Other", {}), ("RoundRobin", {}), ("Custom", {})):
        with pytest.raises(ValueError):
            sink.route(df, bad[0], 2, **bad[1])


@pytest.mark.parametrize("codec", ["NONE", "LZ4", "ZLIB"])
def test_topic_files(spark, folder, codec):
    frame = sink.topic_payload(log(spark).withColumn("value", F.decode("payload", "UTF-8")), F.col("topic"))
    sink.write_topic_files(frame, f"{folder}/t", codec)
    got = spark.read.schema("topic string, value string").json(f"{folder}/t")
    assert sorted((r.topic, r.value) for r in got.collect()) == sorted((t, p.decode()) for t, _, p in MESSAGES)


@pytest.mark.parametrize(("demarcator", "ranged"), [(10, 700), (ord("|"), 64), (10, 1 << 20)])
def test_files_are_framed_by_ranges_as_if_read_whole(spark, folder, demarcator, ranged):
    """Ranges with borders in records, in demarcators and in empty records; a file per way to end."""
    rng = random.Random(demarcator + ranged)
    d = bytes([demarcator])
    bodies = [b"", b"no end", d, d * 200, d.join(bytes(rng.choices(range(256), k=rng.randint(0, 90))).replace(d, b".") for _ in range(200)),
              b"\xef\xbb\xbfmark" + d + b"next" + d, b"x" * 5000 + d + b"y" * 3000 + d + b"z", b"caf\xe9" + d + "é ü\r".encode() + d, d * 199 + b"end"]
    bodies += [bodies[4] + d, bodies[4] + d + d]
    for i, body in enumerate(bodies):
        with open(f"{folder}/f{i:02d}", "wb") as out:
            out.write(body)
    session = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(key, ranged)
    got = {}
    for r in frames.read_framed(session, folder, demarcator).collect():
        got.setdefault(r["path"][-3:], []).append((r["pos"], r["record"]))
    for i, body in enumerate(bodies):
        want = framed(spark, body.removeprefix(b"\xef\xbb\xbf"), demarcator=demarcator)
        assert sorted(got.get(f"f{i:02d}", [])) == sorted(want), (i, ranged)
    begins = session.read.option("lineSep", chr(demarcator)).text(folder + "/f04").select("_metadata.file_block_start").distinct().count()
    assert begins >= 8 or ranged > 700
    for bad in (0, 128):
        with pytest.raises(ValueError):
            frames.read_framed(spark, folder, bad)


def test_a_task_takes_many_ranges_of_a_captured_stream(spark, folder):
    """More ranges of 32 KiB than tasks; every record is there, at its place."""
    rows = [(i, f"l{i % 2}", "\n".join(f"{i:04d} {k:04d} {'x' * 90}" for k in range(300))) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    got = catalog.frame_stream_files(spark, folder).withColumn("task", F.spark_partition_id()).groupBy("lang").agg(
        F.count("*").alias("n"), F.max("pos").alias("last"), F.collect_set("task").alias("tasks"),
        F.count_if(F.col("record").startswith(F.format_string("%04d %04d", F.expr("2 * (pos div 300) + cast(substring(lang, 2) as int)"), F.expr("pos % 300")))).alias("placed")).collect()
    assert sorted((r["lang"], r["n"], r["last"], r["placed"]) for r in got) == [("l0", 60000, 59999, 60000), ("l1", 60000, 59999, 60000)]
    assert 1 < len({t for r in got for t in r["tasks"]}) <= 260 < sum(len(t) for _, _, t in rows) // 32768
