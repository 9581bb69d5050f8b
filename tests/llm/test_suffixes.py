"""Removal of repeated strings against a count of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import corpus, frame

from flowtables.llm import suffixes

LENGTH = 400


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - LENGTH + 1):
            if count[d[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~gone])).hexdigest()))
    return out


def check(spark, rows):
    found = suffixes.without_repeats(frame(spark, rows))
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found.collect()), key=str)
    assert got == sorted(((i is None, i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows]), strict=True)), key=str)
    for r in found.collect():
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_corpus_with_copies_and_passages(spark):
    check(spark, corpus(4))


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_just_around_the_length(spark, seed):
    """Pieces of 380 to 430 bytes put between different bytes, in poor and rich alphabets."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("ab" if k % 2 else "abcdefgh ") for _ in range(n)) for k, n in enumerate([380, 399, 400, 401, 405, 430, 700, 1200])]
    noise = lambda: "".join(rng.choice("xyz é") for _ in range(rng.randint(0, 300)))
    rows = [(i, "".join(noise() + rng.choice(pieces) for _ in range(rng.randint(1, 4))) + noise()) for i in range(40)]
    rows += [(100 + i, rng.choice(pieces)[rng.randint(0, 30) :]) for i in range(20)]
    check(spark, rows)


def test_every_string_has_a_sample_in_reach(spark):
    rng = random.Random(5)
    for alphabet in ("a", "ab", "abcdefghijklmnop"):
        data = "".join(rng.choice(alphabet) for _ in range(3000)).encode()
        places = suffixes.sample(data)
        for p in range(len(data) - LENGTH + 1):
            own = suffixes.sample(data[p : p + LENGTH])
            assert own[0] < suffixes.REACH and p + own[0] in places


def test_empty_table(spark):
    assert suffixes.without_repeats(frame(spark, corpus()).where("false")).count() == 0


def test_keys_with_many_contexts_are_counted_alike(spark, monkeypatch):
    """A passage in other surroundings each time: counting by Spark finds what the merge in one task finds."""
    import random

    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(700)
    rows = [(i, noise(300) + (noise(rng.randint(0, 9)) + passage)[: rng.randint(500, 709)] + noise(rng.randint(0, 300))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = lambda: sorted(tuple(r) for r in suffixes.without_repeats(docs).collect())
    merged = result()
    seen = []
    monkeypatch.setattr(suffixes, "MANY", 3)
    counted = suffixes._counted
    monkeypatch.setattr(suffixes, "_counted", lambda c: seen.append(1) or counted(c))
    assert result() == merged and seen and sum(r[2] for r in merged) > 40 * 400
