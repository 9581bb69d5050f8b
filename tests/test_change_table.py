import datetime as dt
import json

from pyspark.sql import functions as F

from flowtables.functions import text
from flowtables.operators import row_changes
from flowtables.plans.derived import lsn
from flowtables.sources import changetable

SCHEMA = ("trx_time timestamp, start_lsn binary, seqval binary, operation int, Id int, Name string, Age int, Mark binary, Created timestamp")
DAY = dt.datetime(2021, 3, 25, 17, 42, 18)
COLUMNS = [("Id", "int"), ("Name", "nchar"), ("Age", "int"), ("Mark", "varbinary"), ("Created", "datetime")]


def rows(spark, items):
    return spark.createDataFrame(
        [(DAY, lsn(l), lsn(s), op, i, n, a, b"\x01\xff", None if op == 1 else DAY) for l, s, op, i, n, a in items], SCHEMA)


LOG = [(5, 1, 2, 1, "new", 20), (6, 2, 3, 23, "ddd", 23), (6, 2, 4, 23, "ddd", 45), (6, 3, 3, 12, "George", 34),
       (6, 3, 4, 12, "George", 36), (7, 4, 1, 12, "George", 36), (8, 5, 4, 9, "orphan", 1)]


def changes(spark, items=LOG):
    return row_changes.row_changes(rows(spark, items), COLUMNS, ["Id"], "dbo", "person")


def test_pairing(spark):
    got = {(r.operation, r.data[0]): (r.before and r.before[:3], r.data[:3]) for r in changes(spark).collect()}
    assert got == {
        ("insert", "1"): (None, ["1", "new", "20"]),
        ("update", "23"): (["23", "ddd", "23"], ["23", "ddd", "45"]),
        ("update", "12"): (["12", "George", "34"], ["12", "George", "36"]),
        ("delete", "12"): (None, ["12", "George", "36"]),
        ("update", "9"): (None, ["9", "orphan", "1"]),
    }


def test_text_values_and_json(spark):
    one = row_changes.row_change_json(changes(spark)).where("operation = 'delete'").first()
    assert one.data[3:] == ["0x01ff", "null"]
    node = json.loads(one.value)
    assert list(node) == ["columns", "types", "keyColumns", "data", "before", "operation", "trxDate", "schema", "table", "seq"]
    assert node["before"] is None and node["trxDate"] == "2021-03-25 17:42:18.0"
    assert node["seq"] == "0x" + "0" * 19 + "7"
    assert changes(spark).where("operation = 'insert'").first().data[4] == "25-03-2021 17:42:18.000"


def test_poll_never_cuts_a_transaction(spark):
    first = changetable.poll(rows(spark, LOG), max_rows=2)
    assert sorted({bytes(r.start_lsn)[-1] for r in first.collect()}) == [5, 6] and first.count() == 5
    offset = bytes(changetable.next_lsn(first).first()[0])
    second = changetable.poll(rows(spark, LOG), after_lsn=offset, max_rows=100)
    assert sorted(bytes(r.start_lsn)[-1] for r in second.collect()) == [7, 8]
    assert changetable.poll(rows(spark, LOG), after_lsn=lsn(99)).count() == 0


def test_capture_choice(spark):
    def pick(items, offset):
        df = spark.createDataFrame(
            [("dbo", "t", n, "[Id], [X]", DAY + dt.timedelta(days=d), lsn(l)) for n, d, l in items],
            "schema_name string, table_name string, capture_instance string, index_column_list string, create_date timestamp, start_lsn binary")
        r = changetable.choose_capture(df, offset).first()
        return r.capture_instance, r.key_columns, r.error
    old, new, third = ("old", 0, 10), ("new", 1, 20), ("third", 2, 30)
    assert pick([old], lsn(1))[:2] == ("old", ["Id", "X"])
    assert pick([old, new], None)[0] == "new"
    assert pick([old, new], lsn(20))[0] == "new"
    assert pick([old, new], lsn(19))[0] == "old"
    assert pick([old, new, third], None)[0] is None and pick([old, new, third], None)[2]


def test_text_helpers(spark):
    df = spark.createDataFrame([("My_Table-<A> \"x\"*/?\\+",), (None,)], "s string")
    assert [r[0] for r in df.select(text.index_name(F.col("s"))).collect()] == ["mytableax", ""]
    assert df.select(text.bracket_list(F.lit("[A], [B C]")), text.bracket_list(F.lit(""))).first()[:] == (["A", "B C"], None)
    numbers = spark.createDataFrame([(v,) for v in ["+5", "007", ".5", "-.5", "5.", "1.50", "-0", "1e5", "00.1"]], "v string")
    assert [r[0] for r in numbers.select(text.json_number(F.col("v"))).collect()] == ["5", "7", "0.5", "-0.5", "5", "1.50", "-0", "1e5", "0.1"]


CAPTURES = "schema_name string, table_name string, capture_instance string, index_column_list string, create_date timestamp, start_lsn binary"


def captures(spark, *instances):
    return spark.createDataFrame([("dbo", "person", name, "[Id]", DAY + dt.timedelta(minutes=m), lsn(l)) for name, m, l in instances]
                                 + [("dbo", "other", "o", "[Id]", DAY, lsn(1)), ("x", "person", "p", "[Id]", DAY, lsn(1))], CAPTURES)


def polled(spark, instances, tables, **options):
    got = changetable.poll_captures(captures(spark, *instances), tables, "dbo", "person", **options)
    return None if got is None else sorted((int.from_bytes(r.start_lsn, "big"), r.operation, r.Name, r.capture_instance) for r in got.collect())


def test_poll_across_captures(spark):
    """The older instance up to the start of the newer one, each change once, columns by name; creation dates; none or too many."""
    old, two = rows(spark, LOG), [("new", 5, 7), ("old", 0, 1)]
    later = dt.timedelta(minutes=10)
    new = rows(spark, [x for x in LOG if x[0] >= 7]).drop("Age").withColumn("trx_time", F.lit(DAY + later)).withColumn("Extra", F.lit("e"))
    tables = {"old": old, "new": new}
    first = [(6, 3, "George", "old"), (6, 3, "ddd", "old"), (6, 4, "George", "old"), (6, 4, "ddd", "old")]
    second = [(7, 1, "George", "new"), (8, 4, "orphan", "new")]
    assert polled(spark, two, tables, after_lsn=lsn(5)) == first + second
    assert polled(spark, two, tables, after_lsn=lsn(5), max_rows=1) == first
    assert polled(spark, two, tables, after_lsn=lsn(5), max_rows=5) == first + second[:1]
    assert polled(spark, two, tables, after_lsn=lsn(7)) == second[1:]
    assert polled(spark, two, tables, after_lsn=lsn(8)) == []
    assert polled(spark, two, tables) == second
    assert polled(spark, [("new", 10, 7), ("old", 0, 1)], tables) == []  # nothing after the moment of creation
    assert polled(spark, two, tables, start_date="2021-03-25 17:52:00") == second
    assert polled(spark, [("old", -1, 1)], tables) == sorted((l, op, n, "old") for l, _, op, _, n, _ in LOG)
    assert polled(spark, [("old", 0, 1)], tables, after_lsn=lsn(7)) == [(8, 4, "orphan", "old")]
    assert polled(spark, [], tables) is None
    assert polled(spark, [("old", 0, 1), ("new", 1, 2), ("third", 2, 3)], tables) is None
    across = changetable.poll_captures(captures(spark, *two), tables, "dbo", "person", lsn(6)).orderBy("start_lsn")
    assert [(r.Age, r.Extra) for r in across.collect()] == [(None, "e"), (None, "e")]
    mixed = changetable.poll_captures(captures(spark, *two), tables, "dbo", "person", lsn(5)).where("capture_instance = 'old'").first()
    assert mixed.Extra is None and mixed.Age is not None
