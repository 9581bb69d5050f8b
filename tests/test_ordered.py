"""Ranges by splitters, and order-dependent columns over them, on uneven positions."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables.functions import ordered
from flowtables.operators import fix, gate

WANTED = 100


def positions(kind):
    rng = random.Random(1)
    return {
        "outlier": [0, *range(10**12, 10**12 + 3000)],
        "powers": [int(2 ** (i / 60)) * 7 + i for i in range(3000)],
        "clusters": [c * 10**9 + i for c in range(3) for i in range(1000)],
        "ties": [rng.choice([5, 5, 6, 900, 10**6]) if i % 40 == 0 else i * 17 for i in range(3000)],
        "negative": [-(i**3) for i in range(3000)],
    }[kind]


@pytest.mark.parametrize("kind", ["outlier", "powers", "clusters", "ties", "negative"])
def test_no_range_has_twice_the_rows_wanted(spark, kind):
    df = spark.createDataFrame([(p,) for p in positions(kind)], "pos long")
    ranges = ordered._with_range(df, "pos", ordered.splitters(df, "pos", WANTED)).groupBy("_range")
    sizes = [r["n"] for r in ranges.agg(F.count("*").alias("n")).collect()]
    tied = df.groupBy("pos").count().agg(F.max("count")).first()[0]
    assert max(sizes) <= 2 * WANTED + tied - 1 and len(sizes) >= len(positions(kind)) // (2 * WANTED)


@pytest.mark.parametrize("kind", ["outlier", "ties", "negative"])
def test_columns_are_as_in_one_window(spark, kind, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", WANTED)
    monkeypatch.setattr(ordered.splitters, "__defaults__", (WANTED,))
    rows = sorted((k, p, i) for i, p in enumerate(positions(kind)) for k in ("hot" if i % 3 else f"k{i % 5}",))
    df = spark.createDataFrame(rows, "k string, pos long, v int").repartition(4)
    got_pos = {r["v"]: r["row_pos"] for r in ordered.row_position(df, ["k"], "pos", ties=["v"]).collect()}
    got_prev = {r["v"]: r["p"] for r in ordered.previous_value(df, ["k"], "pos", "v", "p", ties=["v"]).collect()}
    mark = F.when(F.col("v") % 50 == 0, F.col("v"))
    got_next = {r["v"]: r["n"] for r in ordered.next_value(df, ["k"], "pos", mark, "n", ties=["v"]).collect()}
    for key in {k for k, _, _ in rows}:
        values = [v for k, _, v in rows if k == key]
        for i, v in enumerate(values):
            assert got_pos[v] == i and got_prev[v] == (values[i - 1] if i else None)
            assert got_next[v] == next((x for x in values[i:] if x % 50 == 0), None)


def test_null_positions_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(ordered.splitters, "__defaults__", (2,))
    df = spark.createDataFrame([(None, 1), (5, 2), (None, 3), (7, 4), (9, 5), (11, 6)], "pos long, v int")
    got = {r["v"]: r["row_pos"] for r in ordered.row_position(df, [], "pos", ties=["v"]).collect()}
    assert got == {1: 0, 3: 1, 2: 2, 4: 3, 5: 4, 6: 5}
    assert ordered.row_position(df.where("false"), [], "pos").collect() == [] and ordered.splitters(df.where("pos is null"), "pos") == []


def test_gate_and_audit_beside_one_outlying_position(spark, monkeypatch):
    monkeypatch.setattr(ordered.splitters, "__defaults__", (WANTED,))
    numbers = [0, *[n for n in range(10**9, 10**9 + 2000) if n % 400]]
    gaps = fix.sequence_gaps(spark.createDataFrame([("s", n) for n in numbers], "session string, seq long"), ["session"], "seq").collect()
    assert len(gaps) == 5
    rows = [(n, f"t{n % 3}", 7 if n % 500 < 3 else 1) for n in numbers]
    got = gate.committed_only(spark.createDataFrame(rows, "scn long, xid string, operation_code int")).select("scn", "commit_scn").collect()
    ends = {x: [n for n, t, c in rows if t == x and c == 7] for x in ("t0", "t1", "t2")}
    want = {n: next((e for e in ends[x] if e >= n), None) for n, x, c in rows if c == 1}
    assert {tuple(r) for r in got} == {(n, e) for n, e in want.items() if e is not None}
