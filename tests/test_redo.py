import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from flowtables.functions import documents
from flowtables.operators import redo_events, snapshot
from flowtables.operators.gate import committed_only, open_changes
from flowtables.sources import changelog
from flowtables.streaming.gate import start_committed
from flowtables.streaming.versions import complete_batches

DATE = "TO_DATE('2021-03-25T17:42:18', 'yyyy-MM-dd\"T\"HH24:MI:SS')"
INSERT = ('insert into "DEMO"."MERCHANT"("DATE","BANKA_NAME","TRX_CODE","SUM") values '
          "(TO_DATE('2020-07-06T14:14:06', 'yyyy-MM-dd\"T\"HH24:MI:SS'),'IBANK','USD','1500');")
UPDATE = ("update \"LOGMINER\".\"PERSON\" set \"NAME\" = 'name changed' where \"ID\" = '0' and \"NAME\" = 'name' and "
          f"\"BIRTH_DATE\" = {DATE} and \"SURNAME\" = 'surname' and ROWID = 'AAASTJAABAAAZoWAAB';")
DELETE = f"delete from \"LOGMINER\".\"PERSON\" where \"ID\" = '0' and \"NAME\" = 'name changed' and \"BIRTH_DATE\" = {DATE};"


def decode(spark, sql, **options):
    df = spark.createDataFrame([(sql,)], "sql_redo string")
    return [tuple(c) for c in redo_events.redo_columns(df, **options).first()["columns"]]


def test_insert(spark):
    assert decode(spark, INSERT) == [
        ("DATE", "2020-07-06T14:14:06", "date", None), ("BANKA_NAME", "IBANK", "varchar", None),
        ("TRX_CODE", "USD", "varchar", None), ("SUM", "1500", "number", None)]


def test_update_merges_where_and_set(spark):
    assert decode(spark, UPDATE) == [
        ("ID", "0", "number", "0"), ("NAME", "name changed", "varchar", "name"),
        ("BIRTH_DATE", "2021-03-25T17:42:18", "date", "2021-03-25T17:42:18"),
        ("SURNAME", "surname", "varchar", "surname"), ("ROWID", "AAASTJAABAAAZoWAAB", "varchar", "AAASTJAABAAAZoWAAB")]


def test_delete(spark):
    assert [c[:3] for c in decode(spark, DELETE)] == [
        ("ID", "0", "number"), ("NAME", "name changed", "varchar"), ("BIRTH_DATE", "2021-03-25T17:42:18", "date")]


def test_column_updated_but_absent_from_where(spark):
    assert decode(spark, "update T set A = '1', \"B\" = NULL where C = '2';") == [
        ("C", "2", "number", "2"), ("A", "1", "number", None), ("B", None, "varchar", None)]


def test_quotes_and_nulls(spark):
    sql = "insert into T(A,B,C) values ('O''Brien, A',NULL,'x where y and z IS NULL');"
    assert [c[1] for c in decode(spark, sql)] == ["O'Brien, A", None, "x where y and z IS NULL"]
    assert [c[1] for c in decode(spark, sql, raw_quotes=True, null_literal=True)] == ["O''Brien, A", "NULL", "x where y and z IS NULL"]
    assert decode(spark, "delete from T where A IS NULL and B = 'is null';")[0][:2] == ("A", None)
    assert decode(spark, "delete from T where A IS NULL;", null_literal=True)[0][:2] == ("A", "NULL")


def test_typing(spark):
    sql = "insert into T(A,B,C,D,E) values ('007',7,'1e5','.5','1.2.3');"
    assert [c[2] for c in decode(spark, sql)] == ["number", "number", "number", "number", "varchar"]
    assert [c[2] for c in decode(spark, sql, strict_types=True)] == ["varchar", "number", "varchar", "varchar", "varchar"]


@pytest.mark.parametrize("sql", ["garbage", "", "update T set A = '1';", "delete from T;", "select 1", None])
def test_undecodable_keeps_the_row(spark, sql):
    assert decode(spark, sql) == []


def test_very_long_literal(spark):
    text = "a where b, c = 'd' and " * 5000
    quoted = text.replace("'", "''")
    got = decode(spark, f"update T set A = '{quoted}' where B = '{quoted}';")
    assert got == [("B", text, "varchar", text), ("A", text, "varchar", None)]


name = st.from_regex(r"[A-Z][A-Z0-9_]{0,6}", fullmatch=True)
literal = st.text(alphabet=st.sampled_from("ab'\", ()=;\nwhere "), max_size=20)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(name, literal, min_size=1, max_size=5))
def test_decode_inverts_rendering(spark, row):
    q = {n: "'" + v.replace("'", "''") + "'" for n, v in row.items()}
    insert = f"insert into T({','.join(chr(34) + n + chr(34) for n in q)}) values ({','.join(q.values())});"
    delete = "delete from T where " + " and ".join(f'"{n}" = {v}' for n, v in q.items()) + ";"
    for sql in (insert, delete):
        assert [(c[0], c[1]) for c in decode(spark, sql)] == list(row.items())


TRACE = [(1, "x1", "insert"), (2, "x2", "insert"), (3, "x1", "update"), (4, "x1", "commit"), (5, "x2", "rollback"),
         (6, "x1", "delete"), (7, "x3", "insert"), (8, "x2", "insert"), (9, "x2", "commit")]
CODES = {"insert": 1, "delete": 2, "update": 3, "commit": 7, "rollback": 36}
LOG_SCHEMA = "scn long, xid string, operation string, operation_code int"


def log(spark, rows=TRACE):
    return spark.createDataFrame([(s, x, o.upper(), CODES[o]) for s, x, o in rows], LOG_SCHEMA)


RELEASED = [(4, 1, "x1"), (4, 3, "x1"), (9, 8, "x2")]


@pytest.mark.parametrize("width", [1, 2, 3, 100])
def test_gate(spark, width):
    got = committed_only(log(spark), width=width).select("commit_scn", "scn", "xid").collect()
    assert sorted(map(tuple, got)) == RELEASED
    assert sorted(r.scn for r in open_changes(log(spark), width=width).collect()) == [6, 7]


def test_gate_stream_over_restarts(spark, folder):
    for piece in (TRACE[:3], TRACE[3:6], TRACE[6:], [(10, "x1", "commit")]):
        log(spark, piece).write.mode("append").parquet(f"{folder}/log")
        source = spark.readStream.schema(LOG_SCHEMA).parquet(f"{folder}/log")
        start_committed(source, f"{folder}/out", f"{folder}/pending", f"{folder}/ck", width=2).awaitTermination()
    got = spark.read.parquet(f"{folder}/out").select("commit_scn", "scn", "xid").collect()
    assert sorted(map(tuple, got)) == sorted([*RELEASED, (10, 6, "x1")])
    last = complete_batches(spark, f"{folder}/pending")[-1]
    assert [r.scn for r in spark.read.parquet(f"{folder}/pending/batch={last}").collect()] == [7]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["insert", "commit", "rollback"])), max_size=25))
def test_gate_against_brute_force(spark, ops):
    rows = [(i, x, o) for i, (x, o) in enumerate(ops)]
    waiting, expected = {}, []
    for scn, xid, op in rows:
        if op == "insert":
            waiting.setdefault(xid, []).append(scn)
        else:
            expected += [(scn, s, xid) for s in waiting.pop(xid, []) if op == "commit"]
    got = committed_only(log(spark, rows), width=4).select("commit_scn", "scn", "xid").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_table_list(spark):
    df = spark.createDataFrame([("A", "T"), ("B", "T"), ("a", "T")], "seg_owner string, seg_name string")
    assert df.where(changelog.table_list("A.T,B.X")).count() == 1
    with pytest.raises(ValueError):
        changelog.table_list("A.T,T")


def test_next_offset(spark):
    df = log(spark)
    assert changelog.next_offset(df, 1).first()[0] == 10
    assert changelog.next_offset(df.where("false"), 77).first()[0] == 77


def test_snapshot_merge(spark):
    schema = "k string, seq long, operation string, doc string"
    current = spark.createDataFrame([("a", 1, "insert", "a1"), ("b", 2, "insert", "b1"), ("c", 3, "insert", "c1")], schema)
    changes = spark.createDataFrame(
        [("a", 4, "insert", "a2"), ("a", 5, "insert", "a3"), ("b", 6, "DELETE", None), ("d", 7, "delete", None),
         ("e", 8, "delete", None), ("e", 9, "insert", "e1")], schema)
    got = snapshot.merge_snapshot(current, changes, keys=["k"]).select("k", "doc").collect()
    assert sorted(map(tuple, got)) == [("a", "a3"), ("c", "c1"), ("e", "e1")]


def test_document_json(spark):
    sql = "insert into T(A,B,C,D,A) values ('007','+.50','q\"\\',NULL,'last');"
    df = redo_events.redo_columns(spark.createDataFrame([(sql,)], "sql_redo string"))
    assert df.select(redo_events.document_json(F.col("columns"))).first()[0] == '{"A":"last","B":0.50,"C":"q\\"\\\\","D":null}'


def test_a_document_looks_up_each_name_once(spark):
    kind = "array<struct<name string, value string, column_type string, last_value string>>"
    rows = [([("A", "1", "number", None), ("A", "007", "number", None), ("B", "a/bé\n", "varchar", None), ("C", "", "varchar", None), ("D", "-0.10", "number", None)],),
            ([("A", "+.5", "number", None), ("B", "x", "number", None), ("C", None, None, None)],), ([],), (None,)]
    out = spark.createDataFrame(rows, f"columns {kind}").select(redo_events.document_json(F.col("columns")).alias("doc"))
    assert [r.doc for r in out.collect()] == ['{"A":7,"B":"a/bé\\n","C":"","D":-0.10}', '{"A":0.5,"B":"x","C":null}', "{}", None]
    assert out._jdf.queryExecution().analyzed().toString().count("filter(") == 1


def test_statements_are_decoded_in_one_pass_over_arrow_batches(spark):
    """No lambda per token in the plan, and a document reads the decoded columns without a way back through rows."""
    rows = spark.createDataFrame([(INSERT, "R1")], "sql_redo string, row_id string").selectExpr(
        "*", "'INSERT' as operation", "timestamp_ntz'2020-01-01 00:00:00' as ts", "'T' as seg_name", "'S' as seg_owner", "'x' as xid", "1L as scn")
    docs = snapshot.to_documents(redo_events.change_events(rows))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "lambda" not in plan and "regexp_extract_all" not in plan
    assert docs.first()["doc"] == '{"DATE":"2020-07-06T14:14:06","BANKA_NAME":"IBANK","TRX_CODE":"USD","SUM":1500}'


def test_documents_by_batches_are_those_of_the_expression(spark):
    kind = "array<struct<name string, value string, column_type string, last_value string>>"
    texts = ["", "a/b\u00e9\n", 'q"\\', "\x01\x1f\x7f", "\\u001f", "+007", "-.5e3", "12\n", "1.", None]
    rows = [([("A", t, k, None), ("B", "x", "varchar", None), ("A", t, k, None)][:n],) for t in texts for k in ("number", "varchar", None) for n in (1, 3)]
    made = spark.createDataFrame([*rows, ([],), (None,)], f"columns {kind}").coalesce(1)
    got = made.select(redo_events.document_json(F.col("columns")).alias("a"), documents.document(F.col("columns")).alias("b")).collect()
    assert len(got) == len(rows) + 2 and all(r.a == r.b for r in got)
