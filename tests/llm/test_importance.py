"""Importance resampling against a plain count, text by text."""

import hashlib
import math
import random
import re
import zlib

import pytest
from llm_data import corpus, frame, sentence, vocabulary

from flowtables.llm import importance

BUCKETS, PERCENT, LEAST = 500, 30, 20


def grams(text, runs):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return words, [b" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, runs):
    s, t = [0] * BUCKETS, [0] * BUCKETS
    found = [(i, *grams(text, runs)) for i, text in rows]
    for held, all_features in ((s, [f for _, _, fs in found for f in fs]), (t, [f for text in target for f in grams(text, runs)[1]])):
        for f in all_features:
            held[zlib.crc32(f) % BUCKETS] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + BUCKETS) / ((s[b] + 1) * (sum(t) + BUCKETS)))) for b in range(BUCKETS)]
    out = []
    for i, words, fs in found:
        weight = sum(gain[zlib.crc32(f) % BUCKETS] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= LEAST), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    return out, able[: PERCENT * len(able) // 100]


def run(spark, rows, target, runs):
    docs = frame(spark, rows).withColumnsRenamed({"n": "score", "slot": "rank", "size": "weight"})
    return importance.resampled(docs, spark.createDataFrame([(t, 1) for t in target], "text string, bucket int"), runs, BUCKETS, PERCENT, LEAST)


@pytest.mark.parametrize("runs", [1, 2, 3])
def test_scores_and_ranks(spark, runs):
    """Null ids and texts, repeated rows, empty and long texts, extra columns with the operator's names."""
    rows, target = corpus(3), [None, "", "one two", corpus(3)[5][1]]
    got = [tuple(r) for r in run(spark, rows, target, runs).collect()]
    all_rows, drawn = brute(rows, target, runs)
    assert sorted((r[:5] for r in got), key=str) == sorted(all_rows, key=str)
    ranked = sorted((r for r in got if r[5] is not None), key=lambda r: r[5])
    assert [r[5] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r[4], r[0]) for r in ranked] == [(r[4], r[0]) for r in drawn]


def test_pieces_and_batches_change_nothing():
    """Texts cut into pieces of a few bytes, several texts in one batch, runs across pieces."""
    rng = random.Random(2)
    words = vocabulary(rng)
    texts = [sentence(rng, words, n).encode() for n in (0, 1, 2, 5, 40, 300)] + [b"", b"x" * 50, b" ,; ", b"a b", b"-a-"]
    for runs in (1, 2, 3):
        for limit in (3, 17, 64, 1 << 20):
            known = importance._Buckets(1 << 30)
            got = sorted((int(n), int(b)) for _, whose, found in importance.features(texts, runs, known, limit) for n, b in zip(whose, found, strict=True))
            assert got == sorted((n, zlib.crc32(f) % (1 << 30)) for n, t in enumerate(texts) for f in grams(t.decode(), runs)[1])


def test_empty_tables(spark):
    rows = corpus(3)[:30]
    assert run(spark, [], ["a b"], 1).collect() == []
    assert len(run(spark, rows, [], 1).collect()) == 30
    assert all(r["rank"] is None for r in run(spark, [(1, "a b"), (2, None)], ["a"], 1).collect())


def test_drawn_rows_come_with_their_columns(spark):
    docs = frame(spark, corpus(3))
    target = spark.createDataFrame([("one two three",)], "text string")
    options = {"runs": 1, "buckets": BUCKETS, "percent": PERCENT}
    ids = {r["doc_id"] for r in importance.resampled(docs, target, **options).where("rank is not null").collect()}
    kept = importance.drawn(docs, target, **options)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r["doc_id"] in ids)
