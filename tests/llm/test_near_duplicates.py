"""MinHash near duplicates against brute force over all pairs."""

import re

import pytest
from llm_data import corpus, frame

from flowtables.llm import minhash
from flowtables.llm.components import components


def sets_of(text, width=5):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, percent):
    """(doc_id, n_shingles, component_id, kept) of each row."""
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        component = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


@pytest.mark.parametrize("percent,seed", [(85, 1), (80, 2)])
def test_components_match_all_pairs(spark, percent, seed):
    rows = corpus(seed)
    found = minhash.near_duplicates(frame(spark, rows), percent)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(rows, percent), key=key)


def test_chain_of_edits_is_one_component(spark):
    """Each text is linked with the next only; the ends share nothing."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[5 * i : 5 * i + 100])) for i in range(20)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85)
    assert {r["component_id"] for r in found.collect()} == {0}


def test_one_of_each_group_stays_with_its_columns(spark):
    rows = corpus(3)
    docs = frame(spark, rows)
    left = minhash.without_near_duplicates(docs, 80)
    assert left.columns == docs.columns
    want = {i for i, _, _, kept in brute(rows, 80) if kept}
    got = [r["doc_id"] for r in left.collect()]
    assert set(got) == want and len(got) == len(want)


def test_rows_are_judged_by_text_and_not_by_id(spark):
    """Null ids and an id that stands for different texts: every group keeps one text, whatever its id."""
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"]
    a, b, c, d, e, f = texts
    rows = [(None, b), (None, c), (1, a), (None, a + " more"), (2, d), (2, e), (2, e), (3, f), (3, f.upper()), (None, ""), (None, ""), (4, None), (4, "  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = minhash.without_near_duplicates(docs, 80).collect()
    got = [(r["doc_id"], r["text"]) for r in left]
    found = [(i, t.lower()) for i, t in got if t and t.strip()]
    assert sorted(found, key=str) == sorted([(1, a), (None, b), (None, c), (2, d), (2, e), (3, f)], key=str)
    assert sorted([r for r in got if not (r[1] or "").strip()], key=str) == sorted(rows[-4:], key=str)


def test_empty_table(spark):
    none = frame(spark, corpus()).where("false")
    assert minhash.near_duplicates(none).count() == 0
    assert minhash.without_near_duplicates(none).count() == 0


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(50)] + [(5, 5), (None, 3), (3000, 3001), (3001, 3000)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(301)) and all(found[2000 + i] == 1000 for i in range(50)) and found[3001] == 3000


def test_threshold_leaves_room(spark):
    assert minhash.needed_collisions(48, 85) == 27 and minhash.needed_collisions(48, 80) < 27 and minhash.needed_collisions(1, 85) == 1
