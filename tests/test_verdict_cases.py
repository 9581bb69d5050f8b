"""Cases that an earlier version got wrong."""

import pytest
from pyspark.sql import functions as F

from flowtables.functions.ordered import fitting_width, row_position
from flowtables.operators import bundles, fix, redo_events, snapshot
from flowtables.operators.windows import hop_aggregate

S = "\x01"
HEAD = "8=FIXT.1.1|35=AE|34=9|52=20240105-10:11:12|571=tr|1003=ti|32=1|31=1|55=ISC|60=20240105-10:00:00.123456|570=Y|"


def decode(spark, sql):
    row = redo_events.redo_columns(spark.createDataFrame([(sql,)], "sql_redo string")).first()
    return [(c["name"], c["value"]) for c in row["columns"]]


def messages(spark, *raw):
    return spark.createDataFrame([("s", r.replace("|", S)) for r in raw], "session string, raw string")


def test_calls_in_calls_and_typed_literals_decode(spark):
    assert decode(spark, "insert into T(X,Y,Z) values (TO_TIMESTAMP(TRIM('2020'),'x'),HEXTORAW('0a'),'b')")[2] == ("Z", "b")
    got = dict(decode(spark, """update T set "X" = UPPER(TRIM('a = b, "Q" = 1')), "N" = -5 where "Y"='1' and "T" = TIMESTAMP '2020-01-01 00:00:00'"""))
    assert set(got) == {"X", "N", "Y", "T"} and got["N"] == "-5" and got["Y"] == "1"


@pytest.mark.parametrize("sql", [
    "insert into T(A,B) values ('1')", "insert into T(A) values ('1','2')", "insert into T(A,B) values ('1' '2')",
    "update T set A = '1' junk where B = '2'", "update T set A = '1' where B = '2' or C = '3'", "delete from T where A > '1'",
    "insert into T(A) values (F(G(H(I(J('x'))))))"])
def test_what_pieces_do_not_cover_is_not_decoded(spark, sql):
    assert decode(spark, sql) == []


def test_sums_keep_the_kind_of_their_field(spark):
    rows = spark.createDataFrame([("a", 4e-7), ("a", 4e-7), ("b", 1e33), ("b", 1e33)], "g string, v double").withColumn("ts", F.timestamp_seconds(F.lit(1000)))
    got = {r["g"]: r["v_sum"] for r in hop_aggregate(rows, ["g"], ["v"], "sum", 60, 60).collect()}
    assert got == {"a": 8e-7, "b": 2e33}
    big = spark.createDataFrame([("a", 2**62), ("a", 2**62), ("a", 2**62)], "g string, v long").withColumn("ts", F.timestamp_seconds(F.lit(1000)))
    assert int(hop_aggregate(big, ["g"], ["v"], "sum", 60, 60).first()["v_sum"]) == 3 * 2**62


def test_fields_of_a_side_are_not_fields_of_the_trade(spark):
    r = fix.trades(messages(spark, HEAD + "552=2|54=2|1=acc|119=5.5|37=o1|54=1|70=al|119=6.5|715=20240107|10=000|")).first()
    assert r.SettlCurrAmt is None and r.ClearingBusinessDate == "20240107" and r.TransactTime == "2024-01-05T10:00:00.123"
    assert [tuple(s) for s in r.NoSides] == [("2", "acc", "o1", None), ("1", None, None, "al")]


@pytest.mark.parametrize("count", ["1", "3", "x"])
def test_a_group_with_another_count_is_a_failure(spark, count):
    raw = HEAD + f"552={count}|54=2|1=acc|54=1|70=al|10=000|"
    assert fix.trades(messages(spark, raw)).count() == 0
    assert [r["error_code"] for r in fix.failures(messages(spark, raw)).collect()] == [fix.BAD_VALUE]


@pytest.mark.parametrize("fraction,shown", [("", "000"), (".5", "500"), (".123456789", "123")])
def test_any_fraction_of_a_second(spark, fraction, shown):
    r = fix.trades(messages(spark, HEAD.replace(".123456", fraction) + "10=000|")).first()
    assert r.TransactTime == f"2024-01-05T10:00:00.{shown}"


def test_a_new_message_type_is_data(spark):
    spec = fix.Report("D", "order", (fix.Field("ClOrdID", 11), fix.Field("Price", 44, "double")), "ClOrdID", False)
    r = fix.report(messages(spark, "8=F|35=D|34=4|52=20240105-10:11:12|11=c|44=1.5|10=0|"), spec).first()
    assert (r.ClOrdID, r.Price, r.Id) == ("c", 1.5, "4:c")


def test_greedy_bundles_with_one_position_for_several_rows(spark):
    rows = [("k", 1, 60, 0), ("k", 1, 60, 1), ("k", 2, 10, 2)]
    df = spark.createDataFrame(rows, "k string, pos long, size long, tie int")
    got = bundles.bundle_greedy(df, ["k"], "pos", "size", messages=10, nbytes=100, ties=["tie"]).orderBy("position").collect()
    assert [(r["tie"], r["position"], r["bundle_start"]) for r in got] == [(0, 0, 0), (1, 1, 1), (2, 2, 1)]


def test_snapshot_takes_the_highest_number_and_matches_nulls(spark):
    schema = "database string, table_name string, row_id string, seq long, operation string, doc string"
    now = spark.createDataFrame([("d", None, "a", 9, "insert", "new"), ("d", "t", "b", 1, "insert", "old"), ("d", "t", "c", 1, "insert", "x")], schema)
    changes = spark.createDataFrame([("d", None, "a", 2, "insert", "late"), ("d", "t", "b", 3, "insert", "b3"), ("d", "t", "c", 4, "delete", None), ("d", "t", "z", 4, "delete", None)], schema)
    got = {(r["row_id"], r["seq"], r["doc"]) for r in snapshot.merge_snapshot(now, changes).collect()}
    assert got == {("a", 9, "new"), ("b", 3, "b3")}


def test_ranges_fit_sparse_and_dense_positions(spark):
    for step in (1, 60_000_000, 10**9):
        df = spark.range(1000).select((F.col("id") * step).alias("pos"))
        width = fitting_width(df, "pos", rows=100)
        per_range = df.groupBy(F.expr(f"pos div {width}").alias("r")).count().collect()
        assert len(per_range) in (10, 11) and max(r["count"] for r in per_range) <= 101
        ranked = row_position(df, [], "pos", width=width).collect()
        assert all(r["row_pos"] == r["pos"] // step for r in ranked)
    assert fitting_width(spark.range(0).select(F.col("id").alias("pos")), "pos") == 1


def test_json_messages_and_bad_text(spark):
    from flowtables.operators import quarantine
    from flowtables.sources import json_messages

    rows = [(1, '{"a": 1, "b": "x", "z": 0}'), (2, "no json"), (3, '{"a": "text"}'), (4, '{"b": "y"}'), (5, None), (6, '{"a": null}'), (7, "[1]")]
    read = json_messages.read_json(spark.createDataFrame(rows, "id int, value string"), "value", "a long, b string", required=["a"])
    good, bad = quarantine.split(read)
    assert [tuple(r) for r in good.collect()] == [(1, None, 1, "x")]
    assert {r["id"]: r["value"] for r in bad.collect()} == {i: v for i, v in rows if i != 1}
    assert [r["value"] for r in json_messages.write_json(good.select("id", "a", "b"), ["a", "b"]).collect()] == ['{"a":1,"b":"x"}']
