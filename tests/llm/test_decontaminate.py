"""Benchmark items in documents against exact containment of all pairs."""

import random

from llm_data import corpus, edited, frame, sentence, vocabulary

from flowtables.llm import decontaminate


def shingles(text):
    words = [w for w in (text or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def tables():
    rng = random.Random(9)
    words = vocabulary(rng)
    docs = corpus(5)
    items = [(k, sentence(rng, words, rng.randint(5, 50))) for k in range(25)]
    for k, (item, text) in enumerate(items):
        changed = edited(rng, words, text, k % 3)
        docs.append((1000 + k, sentence(rng, words, 200) + " " + changed.upper() + "\n" + sentence(rng, words, 3000 if k == 3 else 100)))
    docs += [(2000 + k, "here " + items[0][1]) for k in range(60)]
    items += [(50, ""), (51, None), (52, "one two three"), (None, items[1][1]), (2, items[2][1]), (2, items[4][1])]
    return docs, items


def brute(docs, items, percent=80):
    best = {}
    for d, t in docs:
        mine = shingles(t)
        for i, q in items:
            wanted = shingles(q)
            both = len(wanted & mine)
            if wanted and 100 * both >= percent * len(wanted) and both:
                best[d, i] = max(best.get((d, i), (0, 0, 0)), (both / len(wanted), both, len(wanted)))
    return {(d, i, n, s) for (d, i), (_, s, n) in best.items()}


def test_pairs_and_rest(spark):
    docs, items = tables()
    table = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, h int")
    found = decontaminate.contaminated(frame(spark, docs), table)
    want = brute(docs, items)
    got = [(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    left = decontaminate.without_contaminated(frame(spark, docs), table)
    assert left.columns == frame(spark, docs).columns
    hit = {d for d, *_ in want}
    assert sorted(map(str, (r["doc_id"] for r in left.collect()))) == sorted(str(d) for d, _ in docs if d not in hit)


def test_items_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    docs, items = tables()
    found = decontaminate.contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in found.collect()} == brute(docs, items)


def test_empty_tables(spark):
    docs, items = tables()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contaminated(frame(spark, docs).where("false"), table).count() == 0
    assert decontaminate.contaminated(frame(spark, docs), table.where("false")).count() == 0
    assert decontaminate.without_contaminated(frame(spark, docs), table.where("false")).count() == len(docs)
