"""Small tables with the awkward cases that every operator must bear."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, key string, slot int, size double, cls int, kept boolean"


def vocabulary(rng: random.Random, n: int = 400) -> list[str]:
    return ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def sentence(rng: random.Random, words: list[str], n: int) -> str:
    return " ".join(rng.choice(words) for _ in range(n))


def edited(rng: random.Random, words: list[str], text: str, edits: int) -> str:
    parts = text.split(" ")
    for _ in range(edits):
        parts[rng.randrange(len(parts))] = rng.choice(words)
    return " ".join(parts)


def corpus(seed: int = 1) -> list[tuple]:
    """(doc_id, text) with exact and near copies of several strengths, shared passages, long, short, empty and null texts."""
    rng = random.Random(seed)
    words = vocabulary(rng)
    out = [sentence(rng, words, rng.randint(30, 160)) for _ in range(40)]
    base = sentence(rng, words, 150)
    out += [base] * 5 + [edited(rng, words, base, rng.randint(1, 9)) for _ in range(40)]
    other = sentence(rng, words, 120)
    out += [edited(rng, words, other, k % 4) for k in range(20)]
    passage = sentence(rng, words, 110)
    out += [sentence(rng, words, rng.randint(5, 60)) + " " + passage + " " + sentence(rng, words, rng.randint(5, 60)) for _ in range(15)]
    out += ["", None, "   \n\t ", "one", "one two three", "One TWO three", "one two three four five", "a" * 2000, "ab " * 700, sentence(rng, words, 6000), "ÉTÉ Été été " * 60]
    rows = list(enumerate(out, 10))
    rng.shuffle(rows)
    return rows + [(None, base), (None, "only this one has no id"), (10, out[0]), (11, out[1]), (11, out[1])]


def frame(spark, rows):
    """Documents with further columns, of which some have names that operators use themselves."""
    full = [(i, t, [None, "en", "de"][k % 3], [None, "hot", "hot", "a", "b"][k % 5], len(t) if t and k % 7 else None, k, "x", k % 2, 1.5, 3, True) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)
