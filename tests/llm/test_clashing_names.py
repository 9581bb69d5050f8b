"""Operators that return whole rows, on tables whose columns have the names that operators use themselves."""

import pytest
from llm_data import corpus, frame

from flowtables.llm import decontaminate, kdtree, minhash, mixing, surrogates

NAMES = ["_all", "_name", "_stay", "_mark", "_row", "_id", "_changes", "_hit", "_k0", "_k1", "_size", "_position", "_rank", "_bucket", "_text",
         "_file", "_index", "_begin", "_alone", "block", "slot", "h", "d", "doc", "found", "mention", "source_"]


def clashing(spark):
    docs = frame(spark, [*corpus(2)[:40], (900, "write to jo@example.com or 555-201-3344"), (901, "jo@example.com")])
    names = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    docs = docs.drop(*names)
    for i, name in enumerate(NAMES):
        docs = docs.selectExpr("*", f"{i} as `{name}`")
    return docs


@pytest.mark.parametrize("name", ["replaced", "with_shard", "without_near_duplicates", "in_mixed_order", "without_contaminated"])
def test_columns_come_back(spark, name):
    docs = clashing(spark)
    items = spark.createDataFrame([(1, "one two three four five", 3)], "item_id long, text string, _hit int")
    got = {
        "replaced": lambda: surrogates.replaced(docs, "key"),
        "with_shard": lambda: kdtree.with_shard(docs, 3000),
        "without_near_duplicates": lambda: minhash.without_near_duplicates(docs),
        "in_mixed_order": lambda: mixing.in_mixed_order(docs, block_bytes=500),
        "without_contaminated": lambda: decontaminate.without_contaminated(docs, items),
    }[name]()
    assert [c for c in got.columns if c not in ("n_entities", "shard")] == docs.columns
    rows = got.select(*NAMES).collect()
    assert rows and all(tuple(r) == tuple(range(len(NAMES))) for r in rows)
    if name in ("replaced", "with_shard", "in_mixed_order"):
        assert len(rows) == docs.count()


def test_position_is_replaced(spark, folder):
    docs = clashing(spark).withColumnRenamed("_k0", "position")
    docs.write.parquet(folder + "/t")
    again = spark.read.parquet(folder + "/t")
    got = mixing.with_position(again)
    assert sorted(got.columns) == sorted(docs.columns) and sorted(r[0] for r in got.select("position").collect()) == list(range(docs.count()))
