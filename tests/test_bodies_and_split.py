"""Request bodies of many events, and both halves of a frame from one pass."""

import json

import pytest
from pyspark.sql import functions as F

from flowtables.functions.once import with_columns_once
from flowtables.operators import quarantine
from flowtables.sinks import bulk

EVENT = "type string, database string, table_name string, row_id string, seq string, columns array<struct<name string, value string, column_type string, last_value string>>"


def change(kind, row, seq, **values):
    return kind, "S A", "T_1", row, str(seq), [(n, v, "varchar", None) for n, v in values.items()]


@pytest.mark.parametrize("width", [None, 7])
def test_bodies_hold_size_events_in_order(spark, width):
    rows = [change("delete" if i % 3 == 0 else "insert", f"r{i}", 1000 - i // 2, a=f"line\n{i}") for i in range(50)]
    got = bulk.bulk_bodies(spark.createDataFrame(rows, EVENT).repartition(5), 8, width).orderBy("bundle").collect()
    order = sorted(rows, key=lambda r: (int(r[4]), r[3]))
    assert [r["records"] for r in got] == [8] * 6 + [2]
    seen = []
    for body in got:
        assert body["content"].endswith("\n")
        lines = body["content"].rstrip("\n").split("\n")
        for line in lines:  # a document's own line breaks are escaped
            seen.append(json.loads(line))
    want = []
    for kind, _, _, row, _, columns in order:
        want.append({"delete" if kind == "delete" else "index": {"_index": "sa-t1", "_id": row}})
        if kind != "delete":
            want.append({n: v for n, v, _, _ in columns})
    assert seen == want
    assert [(r["first_seq"], r["last_seq"]) for r in got] == [
        (int(order[i][4]), int(order[min(i + 7, 49)][4])) for i in range(0, 50, 8)]


def test_no_events_give_no_body(spark):
    assert bulk.bulk_bodies(spark.createDataFrame([], EVENT)).count() == 0


def test_split_works_rows_out_once(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def costly(x):
        calls.add(1)
        return None if x is not None and x % 4 == 0 else "bad"

    df = spark.range(40).withColumn("extra", F.lit(None).cast("string"))
    marked = quarantine.mark(df, F.udf(costly, "string")("id"))
    good, bad = quarantine.write_split(marked, f"{folder}/split")
    assert calls.value == 40
    assert sorted(r.id for r in good.collect()) == list(range(0, 40, 4)) and good.columns == ["id", "extra"]
    assert bad.columns == ["id", "extra", "_error"] and {r["_error"] for r in bad.collect()} == {"bad"} and bad.count() == 30
    assert calls.value == 40
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "_outcome" in plan and "PartitionFilters: [isnotnull(_outcome" in plan


def test_split_without_rows(spark, folder):
    empty = quarantine.mark(spark.range(0), F.lit("never"))
    good, bad = quarantine.write_split(empty, f"{folder}/none")
    assert (good.count(), bad.count()) == (0, 0) and bad.columns == ["id", "_error"]


def test_events_are_made_once_for_the_bodies(spark):
    """Finding the order takes several passes; none of them may decode the events again."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<struct<name string, value string, column_type string, last_value string>>")
    def decoded(columns):
        made.add(1)
        return columns

    rows = [change("insert", f"r{i}", i, a="x") for i in range(20)]
    events = with_columns_once(spark.createDataFrame(rows, EVENT), {"columns": decoded("columns")})
    assert sum(r["records"] for r in bulk.bulk_bodies(events, 8).collect()) == 20
    assert made.value == 20
