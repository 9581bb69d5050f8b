"""WARC derivatives by parsing what is written, and training order by exact round trip."""

import glob
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import corpus, frame

from flowtables.llm import trainorder, warc

PAGES = [
    (1, "http://a.example/x y\n", "<html><head><title>A &amp; b</title><style>p{}</style></head><body><h1>Head</h1><p>one <b>two</b>&nbsp;three<br>four<!-- no --><script>var t='<p>';</script></body>"),
    (2, "http://b.example/", ""), (3, None, None), (None, "http://c.example/", "plain 1 < 2 & 3 > 2"),
    (4, "http://d.example/", "<script>never closed <p>text"), (5, "http://e.example/", "<p>" + "word " * 60000 + "é</p>"),
    (6, "http://f.example/", "<a<b<<p>x"), (2, "http://b.example/", ""),
]


def parse(data: bytes):
    """Records of a WARC file by their Content-Length."""
    at, out = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        out.append((fields, data[end + 4 : end + 4 + size]))
        assert data[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
        at = end + 8 + size
    return out


def test_records_link_to_their_response(spark, folder):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, kind string")
    source = warc.responses(pages)
    records = warc.derivatives(source)
    by_id = {r["record_id"]: r for r in source.collect()}
    rows = records.collect()
    assert Counter((r["page_id"], r["kind"]) for r in rows) == Counter((p[0], k) for p in PAGES for k in ("metadata", "conversion"))
    text = {r["page_id"]: r["block"] for r in rows if r["kind"] == "conversion"}
    assert text[1] == "A & b\nHead\none two three\nfour" and text[2] == text[3] == text[4] == "" and text[None] == "plain 1 < 2 & 3 > 2"
    assert text[5] == ("word " * 60000 + "é") and text[6].endswith("x")
    warc.write_warc(records, folder + "/warc")
    found = [r for f in glob.glob(folder + "/warc/part-*") for r in parse(open(f, "rb").read())]
    assert len(found) == len(rows)
    for fields, block in found:
        parent = by_id[fields["WARC-Refers-To"]]
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest() and fields["WARC-Date"] == parent["date"]
        if fields["WARC-Type"] == "metadata":
            told = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if ": " in line)
            assert told["source-payload-digest"] == parent["payload_digest"] and told["http-status"] == "HTTP/1.1 200 OK"
            assert told["http-header-Content-Length"] == str(len(parent["payload"].encode()))
    assert {f["WARC-Record-ID"] for f, _ in found} == {r["record_id"] for r in rows} and len({r["record_id"] for r in rows}) == 2 * 7
    assert [r["record_id"] for r in warc.derivatives(source).orderBy("record_id").collect()] == sorted(r["record_id"] for r in rows)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derivatives(warc.responses(none)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(size):
    for key in (1, 99):
        slots = trainorder.feistel(np.arange(size), size, key)
        assert sorted(slots) == list(range(size)) and list(trainorder.feistel(slots, size, key, inverse=True)) == list(range(size))
    assert size < 64 or list(trainorder.feistel(np.arange(size), size, 1)) != list(trainorder.feistel(np.arange(size), size, 99))


def test_round_trip_of_bytes(spark, folder):
    rows = corpus(6)
    frame(spark, rows).write.parquet(folder + "/docs")
    written = trainorder.materialise(spark.read.parquet(folder + "/docs"), folder + "/shards", key=5, length=300, per_shard=16)
    got = sorted(written.collect(), key=lambda r: r["sequence"])
    assert [r["sequence"] for r in got] == list(range(len(got))) and sorted(r["slot"] for r in got) == list(range(len(got)))
    stream = b"".join(bytes(r["record"]) for r in got)
    body, last = stream[: stream.rindex(b"\xff")], stream[stream.rindex(b"\xff") + 1 :]
    assert not last.strip(b"\xfe") and Counter(body.split(b"\xff")) == Counter((t or "").encode() for _, t in rows)
    for r in got:  # a reader finds slot s at its place in the shard's one file
        (file,) = glob.glob(f"{folder}/shards/shard={r['shard']}/part-*")
        with open(file, "rb") as f:
            f.seek((r["slot"] % 16) * 301)
            assert f.read(300) == bytes(r["record"]) and r["slot"] // 16 == r["shard"]


def test_slots_order_the_records_of_a_file(spark, folder):
    """Rows that come in another order are put in place by slot, and the writer adds no sort of its own that could undo it."""
    rows = spark.range(0, 4000, numPartitions=1).selectExpr("id % 4 as shard", "(id * 7919) % 4000 as slot", "cast(lpad(cast((id * 7919) % 4000 as string), 9, '0') as binary) as record")
    placed = trainorder.in_place(rows.withColumn("shard", trainorder.F.expr("slot div 1000")))
    placed.write.partitionBy("shard").option("lineSep", "\n").text(folder + "/out")
    for shard in range(4):
        (file,) = glob.glob(f"{folder}/out/shard={shard}/part-*")
        assert [int(line) for line in open(file)] == list(range(1000 * shard, 1000 * shard + 1000))


def test_round_trip_of_byte_pairs(spark, folder):
    import base64

    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"ab ": 257}
    with open(folder + "/ranks", "wb") as f:
        f.writelines(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items())
    rows = corpus(7)
    frame(spark, rows).write.parquet(folder + "/docs")
    written = trainorder.materialise(spark.read.parquet(folder + "/docs"), folder + "/shards", length=256, per_shard=32, ranks=folder + "/ranks")
    ids = np.frombuffer(b"".join(bytes(r["record"]) for r in sorted(written.collect(), key=lambda r: r["sequence"])), "<u2")
    token = {r: t for t, r in ranks.items()}
    texts, now = [], []
    for i in ids:
        if i == 258:
            texts.append(b"".join(now))
            now = []
        elif i != 0xFEFE:
            now.append(token[int(i)])
    assert not now and Counter(texts) == Counter((t or "").encode() for _, t in rows)


def test_nothing_to_write(spark, folder):
    frame(spark, corpus()).where("false").write.parquet(folder + "/docs")
    assert trainorder.materialise(spark.read.parquet(folder + "/docs"), folder + "/shards").count() == 0
