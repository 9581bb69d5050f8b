"""Held-out accuracy of the classifier and the pipeline against a walk through its stages."""

import random

import numpy as np
import pytest
from llm_data import corpus, frame, sentence, vocabulary

import corpus_pipeline
from flowtables.llm import quality
from flowtables.llm.common import may_contain

SF = "/root/testdata/sf0.01"


def test_slopes_match_differences():
    """The learned step follows the loss: one step of fitting lowers it from any start."""
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(rng.integers(1, 6), quality.FEATURES)).astype(np.float32) for _ in range(200)]
    labels = np.array([float(b[:, 0].max() > 0.8) for b in bags], np.float32)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    loss = lambda m: -np.mean(np.log(np.where(labels == 1, s := quality.forward(np.concatenate(bags), starts, m)["score"], 1 - s)))  # noqa: E731, F821
    losses = [loss(quality.fit(bags, labels, epochs=n)) for n in (0, 5, 60)]
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.35


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(SF + "/documents.parquet"), spark.read.parquet(SF + "/labels.parquet")
    got = quality.scored(docs, labels)
    assert got.count() == docs.count()
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.97
    again = quality.scored(docs.repartition(5), labels.repartition(2)).where("held_out").join(labels, "doc_id").toPandas()
    assert np.allclose(held.sort_values("doc_id").score, again.sort_values("doc_id").score)


def test_labels_of_held_out_documents_do_not_count(spark):
    docs, labels = spark.read.parquet(SF + "/documents.parquet").limit(200), spark.read.parquet(SF + "/labels.parquet")
    turned = labels.withColumn("quality", quality.F.when(quality.is_held_out("doc_id"), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    one, two = quality.train(docs, labels), quality.train(docs, turned)
    assert all((one[n] == two[n]).all() for n in one)


def test_awkward_rows(spark):
    rows = corpus(9)
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, k % 2, 0) for k, (i, _) in enumerate(rows)] + [(10, 7, 0), (None, 1, 0), (11, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.scored(docs, labels).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all() and not got[got.doc_id.isna()].held_out.any()
    none = quality.scored(docs, labels.where("false")).toPandas()
    assert len(none) == len(rows) and np.allclose(none.score, 0.5)
    assert quality.scored(docs.where("false"), labels).count() == 0
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0


def test_filter_never_misses(spark):
    known = spark.range(0, 5000, 7).select(quality.F.xxhash64("id").alias("h"))
    test = may_contain(known, "h")
    rows = spark.range(5000).select("id", test(quality.F.xxhash64("id")).alias("may")).collect()
    assert all(r["may"] for r in rows if r["id"] % 7 == 0) and sum(r["may"] for r in rows) < 1500


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(SF + "/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs)
    return out


def test_pipeline_takes_each_decision(spark, stages):
    source = spark.read.parquet(SF + "/documents.parquet")
    ids = [{r[0] for r in d.select("doc_id").collect()} for d in stages]
    assert all(d.columns == source.columns for d in stages[:-1]) and stages[-1].columns == [*source.columns, "shard"]
    scored = quality.scored(source, spark.read.parquet(SF + "/labels.parquet")).where("predicted = 1")
    assert ids[0] == {r["doc_id"] for r in scored.collect()}
    from test_near_duplicates import brute as groups

    first = [(r["doc_id"], r["text"]) for r in stages[0].collect()]
    assert ids[1] == {i for i, _, _, kept in groups(first, 80) if kept}
    from test_decontaminate import brute as leaks

    second = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    items = [tuple(r) for r in spark.read.parquet(SF + "/benchmark.parquet").select("item_id", "text").collect()]
    assert ids[2] == ids[1] - {d for d, *_ in leaks(second, items)}
    assert ids[3] == ids[4] == ids[2] and all(d.count() == len(i) for d, i in zip(stages, ids, strict=True))
    assert stages[-1].drop("shard").exceptAll(source).count() == 0


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert {(r["doc_id"]) for r in got.collect()} == {r["doc_id"] for r in stages[-1].collect()}


def test_pipeline_on_awkward_rows(spark, folder):
    rng = random.Random(4)
    words = vocabulary(rng)
    rows = corpus(10) + [(5000 + i, "%%% $$$ ### " * 40) for i in range(30)]
    docs = frame(spark, rows).select(*corpus_pipeline.COLUMNS)
    spark.createDataFrame([(i, int(not t or "%" not in t), 0) for i, t in rows], "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    spark.createDataFrame([(1, sentence(rng, words, 12))], "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    for table in (docs, docs.where("false")):
        left = table
        for _, stage in corpus_pipeline.STAGES:
            left = stage(spark, left, folder)
        assert left.count() <= table.count()
