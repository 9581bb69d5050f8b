"""Removal of repeated word windows against a count of all windows."""

import hashlib
import random
from collections import Counter

import pytest
from llm_data import corpus, frame, sentence, vocabulary

from flowtables.llm import anchors


def brute(texts, window):
    data = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in data for i in range(len(w) - window + 1))
    out = []
    for w in data:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        edges = [i for i in range(len(w) + 1) if (i < len(w) and gone[i]) != (i > 0 and gone[i - 1])]
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest(), list(zip(edges[::2], edges[1::2], strict=True))))
    return out


def check(spark, rows, window=35):
    found = anchors.without_repeats(frame(spark, rows), window).collect()
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], [(s["start"], s["end"]) for s in r["removed"]]) for r in found]
    assert sorted(got, key=str) == sorted(((i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], window), strict=True)), key=str)


@pytest.mark.parametrize("window", [35, 12, 1])
def test_corpus_with_copies_and_passages(spark, window):
    check(spark, corpus(4), window)


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_just_around_the_window(spark, seed):
    """Passages of 30 to 40 words and more, at all offsets to the blocks, of few and many different words."""
    rng = random.Random(seed)
    many, few = vocabulary(rng), ["a", "b", "ab"]
    pieces = [sentence(rng, few if k % 3 == 0 else many, n) for k, n in enumerate([30, 34, 35, 36, 52, 53, 54, 90])]
    noise = lambda: sentence(rng, many, rng.randint(0, 40))
    gap = lambda: rng.choice([" ", "  ", "\n", " \t ", "  "])
    rows = [(i, noise() + "".join(gap() + rng.choice(pieces) + gap() + noise() for _ in range(rng.randint(1, 4)))) for i in range(50)]
    rows += [(100 + i, " ".join(rng.choice(pieces).split()[rng.randint(0, 5) :])) for i in range(20)]
    check(spark, rows)


def test_repeats_inside_one_document(spark):
    rng = random.Random(7)
    words = vocabulary(rng)
    passage = sentence(rng, words, 60)
    check(spark, [(1, " ".join([passage, sentence(rng, words, 11), passage])), (2, "same " * 90), (3, sentence(rng, words, 200)), (None, "to be " * 36)])


def test_empty_and_short_tables(spark):
    check(spark, [])
    check(spark, [(1, None), (None, ""), (1, "a b"), (1, "a b")])


def test_long_texts_are_hashed_in_slices(monkeypatch):
    rng = random.Random(5)
    text = sentence(rng, vocabulary(rng), 500).encode()
    joined, starts, ends = anchors.normalised(b" " + text + b"\n\n")
    whole = anchors.word_hashes(joined, starts, ends)
    runs = anchors.rolling(whole, 18)
    monkeypatch.setattr(anchors, "SLICE", 64)
    assert joined == text and (anchors.word_hashes(joined, starts, ends) == whole).all() and (anchors.rolling(whole, 18) == runs).all()
    first = text.split().index(text.split()[3])
    assert whole[first] == whole[3] and len(set(whole.tolist())) == len(set(text.split()))
