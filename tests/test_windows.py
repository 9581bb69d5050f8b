import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from flowtables.operators.windows import aggregation_id, hop_aggregate
from flowtables.streaming import windows as stream

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


TRACE = [(1, "cc11", 100), (40, "cc21", 250), (70, "cc11", 150), (100, "cc21", 300), (305, "cc11", 200), (345, "cc21", 350)]


def events(spark, rows=TRACE):
    return spark.createDataFrame([(at(t), c, a) for t, c, a in rows], "ts timestamp, card_no string, trx_amount long")


def by_checkpoint(df):
    return {(r.end_date[11:], r.card_no): int(r.trx_amount_sum) for r in df.collect()}


def test_hopping_trace(spark):
    got = by_checkpoint(hop_aggregate(events(spark), ["card_no"], ["trx_amount"], "sum", 300, 60))
    expected = {60: (100, 250), 120: (250, 550), 180: (250, 550), 240: (250, 550), 300: (250, 550), 360: (350, 650)}
    for second, (a, b) in expected.items():
        clock = at(second).strftime("%H:%M:%S")
        assert (got[clock, "cc11"], got[clock, "cc21"]) == (a, b)


def test_average_of_two_fields(spark):
    rows = [("1", "cc11", 100, 1.0), ("1", "cc11", 150, 1.5), ("1", "cc12", 200, 2.0),
            ("2", "cc21", 250, 2.5), ("2", "cc21", 300, 3.0), ("2", "cc22", 350, 3.5)]
    df = spark.createDataFrame([(at(1), *r) for r in rows], "ts timestamp, customer_no string, card_no string, trx_amount long, trx_tax double")
    out = hop_aggregate(df, ["customer_no", "card_no"], ["trx_amount", "trx_tax"], "avg", 10, 3)
    got = {(r.customer_no, r.card_no, r.trx_amount_avg, r.trx_tax_avg) for r in out.collect()}
    assert got == {("1", "cc11", 125.0, 1.25), ("1", "cc12", 200.0, 2.0), ("2", "cc21", 275.0, 2.75), ("2", "cc22", 350.0, 3.5)}


def test_average_that_does_not_end(spark):
    rows = [(1, "a", 3), (2, "a", 3), (3, "a", 4)]
    out = hop_aggregate(events(spark, rows), ["card_no"], ["trx_amount"], "avg", 60, 60).collect()
    assert out[0].trx_amount_avg == pytest.approx(10 / 3)


def test_null_groups(spark):
    rows = [(1, None, 3), (2, "a", 4)]
    plain = hop_aggregate(events(spark, rows), ["card_no"], ["trx_amount"], "sum", 60, 60)
    text = hop_aggregate(events(spark, rows), ["card_no"], ["trx_amount"], "sum", 60, 60, null_as_text=True)
    assert {r.card_no for r in plain.collect()} == {None, "a"}
    assert {r.card_no for r in text.collect()} == {"null", "a"}


def test_rejects_bad_settings(spark):
    df = events(spark)
    with pytest.raises(ValueError):
        hop_aggregate(df, ["card_no"], ["trx_amount"], "max")
    with pytest.raises(ValueError):
        hop_aggregate(df, ["card_no"], [], "avg")


def test_arrival_time(spark):
    df = events(spark).drop("ts")
    out = hop_aggregate(df, ["card_no"], how="count", window=3600, hop=3600, time_col=None)
    assert {(r.card_no, r["count"]) for r in out.collect()} == {("cc11", 3), ("cc21", 3)}


def test_group_id_separator(spark):
    df = spark.createDataFrame([("1", "12"), ("11", "2")], "a string, b string")
    assert df.select(aggregation_id(["a", "b"]).alias("i")).distinct().count() == 1
    assert df.select(aggregation_id(["a", "b"], "|").alias("i")).distinct().count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 900), st.sampled_from(["a", "b"]), st.integers(-50, 50)), min_size=1, max_size=30),
       st.sampled_from([(300, 60), (120, 60), (60, 60), (60, 300), (100, 30)]))
def test_against_brute_force(spark, rows, shape):
    window, hop = shape
    out = hop_aggregate(events(spark, rows), ["card_no"], ["trx_amount"], "sum", window, hop)
    expected = {}
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    for t, card, amount in rows:
        second = base + t
        if hop > window:
            ends = [(second // hop + 1) * hop]
        else:
            ends = [s + window for s in range((second // hop) * hop, second - window, -hop)]
        for end in ends:
            if end - window <= second < end:
                key = (dt.datetime.fromtimestamp(end, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S"), card)
                expected[key] = expected.get(key, 0) + amount
    assert {(r.end_date, r.card_no): int(r.trx_amount_sum) for r in out.collect()} == expected


def test_panes_equal_row_expansion(spark):
    df = events(spark)
    rows = [hop_aggregate(df, ["card_no"], ["trx_amount"], "avg", 300, 60, panes=p).collect() for p in (True, False)]
    assert sorted(map(tuple, rows[0])) == sorted(map(tuple, rows[1]))


def test_stream_emits_closed_windows_once_and_survives_restart(spark, folder):
    schema = "ts timestamp, card_no string, trx_amount long"
    pieces = [TRACE[:2], TRACE[2:4], TRACE[4:], [(2000, "end", 0)]]
    for i, piece in enumerate(pieces):
        events(spark, piece).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(schema).parquet(f"{folder}/in")
        stream.start_closed_windows(
            source, f"{folder}/out", f"{folder}/ck", ["card_no"], fields=["trx_amount"], how="sum", window=300, hop=60
        ).awaitTermination()
    got = spark.read.parquet(f"{folder}/out").where("card_no <> 'end'")
    batch = hop_aggregate(events(spark), ["card_no"], ["trx_amount"], "sum", 300, 60)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
