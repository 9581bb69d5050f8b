"""SQL for the registered queries, worked out from the base tables.

The statements never decode, gate, pair or unpack anything: they state the
expected rows of each operator directly from the columns a log was derived from.
"""

from __future__ import annotations

from flowtables.functions.fix_fields import EXECUTION_FIELDS, QUOTE_FIELDS, TRADE_FIELDS

ISO = "%Y-%m-%dT%H:%M:%S"


# ---- windows -------------------------------------------------------------------

def _window(groups: list[str], result: str, window: int, hop: int, sampled: bool = False, sep: str = "") -> str:
    keys = ", ".join(f"CAST({g} AS VARCHAR) AS {g}" for g in groups)
    names = ", ".join(groups)
    ident = f" || '{sep}' || ".join(groups)
    if sampled:
        begin = f"(s // {hop}) * {hop} + {hop - window}"
        shifts = "(SELECT 0 AS k) shifts"
        keep = f"WHERE s >= (s // {hop}) * {hop} + {hop - window}"
    else:
        begin = f"(s // {hop}) * {hop} - k * {hop}"
        shifts = f"(SELECT unnest(range(0, {-(-window // hop)})) AS k) shifts"
        keep = f"WHERE s < (s // {hop}) * {hop} - k * {hop} + {window}"
    return f"""
WITH e AS (
  SELECT {keys}, CAST(value AS DECIMAL(18,2)) AS v, user_id AS u, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS s FROM events
), x AS (
  SELECT {names}, v, u, us, {begin} AS b FROM e, {shifts} {keep}
)
SELECT {names}, {result},
       strftime(make_timestamp(b * 1000000), '{ISO}') AS begin_date,
       strftime(make_timestamp((b + {window}) * 1000000), '{ISO}') AS end_date,
       base64(encode({ident})) AS aggregation_id
FROM x GROUP BY {names}, b"""


# ---- redo log -------------------------------------------------------------------

_COMMITTED = """
term AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr, o_totalprice AS price, o_orderdate AS d,
         min(CASE WHEN o_orderstatus IN ('F','P') THEN o_orderkey END)
           OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t
  FROM orders
), committed AS (
  SELECT term.*, t * 10 + 4 AS commit_scn FROM term JOIN orders o ON o.o_orderkey = term.t AND o.o_orderstatus = 'F'
)"""

_CDC_COMMITTED = f"""
WITH {_COMMITTED}
SELECT k * 10 + 1 AS scn, commit_scn, 'T' || c AS xid, 'insert' AS type, 'R' || k AS row_id FROM committed
UNION ALL SELECT k * 10 + 2, commit_scn, 'T' || c, 'update', 'R' || k FROM committed WHERE st <> 'O'
UNION ALL SELECT k * 10 + 3, commit_scn, 'T' || c, 'delete', 'R' || k FROM committed WHERE pr = '5-LOW'"""

_CDC_ALL = """
SELECT o_orderkey * 10 + 1 AS scn, 'insert' AS type, 'SALES' AS "database", 'ORDERS' AS table_name, 'R' || o_orderkey AS row_id FROM orders
UNION ALL SELECT o_orderkey * 10 + 2, 'update', 'SALES', 'ORDERS', 'R' || o_orderkey FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT o_orderkey * 10 + 3, 'delete', 'SALES', 'ORDERS', 'R' || o_orderkey FROM orders WHERE o_orderpriority IN ('5-LOW','1-URGENT')
UNION ALL SELECT c_custkey * 10 + 6, 'insert', 'SALES', 'CUSTOMER', 'C' || c_custkey FROM customer"""


def _cells(cells: list[tuple[str, str, str, str]]) -> str:
    items = ", ".join(
        f"{{'i': {i}, 'n': '{n}', 'v': CAST({v} AS VARCHAR), 't': '{t}', 'l': CAST({last} AS VARCHAR)}}"
        for i, (n, v, t, last) in enumerate(cells)
    )
    return f"unnest([{items}]) AS x"


_PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
_PRICE2 = "CAST(o_totalprice * 2 AS DECIMAL(18,2))"
_DAY = f"strftime(o_orderdate, '{ISO}')"
_NOTE = "'It''s late, see where and why'"
_INSERT = [
    ("O_ORDERKEY", "o_orderkey", "number", "NULL"), ("O_CUSTKEY", "o_custkey", "number", "NULL"),
    ("O_ORDERSTATUS", "o_orderstatus", "varchar", "NULL"), ("O_TOTALPRICE", _PRICE, "number", "NULL"),
    ("O_ORDERDATE", _DAY, "date", "NULL"), ("O_ORDERPRIORITY", "o_orderpriority", "varchar", "NULL"),
    ("O_NOTE", "NULL", "varchar", "NULL"),
]
_UPDATE = [
    ("O_ORDERKEY", "o_orderkey", "number", "o_orderkey"), ("O_TOTALPRICE", _PRICE2, "number", _PRICE),
    ("O_ORDERDATE", _DAY, "date", _DAY), ("O_NOTE", _NOTE, "varchar", "NULL"),
    ("ROWID", "'R' || o_orderkey", "varchar", "'R' || o_orderkey"), ("O_CLERK", "NULL", "varchar", "NULL"),
]
_DELETE = [
    ("O_ORDERKEY", "o_orderkey", "number", "NULL"), ("O_ORDERSTATUS", "o_orderstatus", "varchar", "NULL"),
    ("O_NOTE", "NULL", "varchar", "NULL"), ("ROWID", "'R' || o_orderkey", "varchar", "NULL"),
]
_CUSTOMER = [
    ("C_CUSTKEY", "c_custkey", "number", "NULL"), ("C_NAME", "c_name", "varchar", "NULL"),
    ("C_ACCTBAL", "CAST(c_acctbal AS DECIMAL(18,2))", "number", "NULL"),
]
_CELLS = f"""
cells AS (
  SELECT o_orderkey * 10 + 1 AS scn, 'insert' AS type, o_orderdate AS ts, 'ORDERS' AS tab, 'R' || o_orderkey AS rid, {_cells(_INSERT)} FROM orders
  UNION ALL SELECT o_orderkey * 10 + 2, 'update', o_orderdate, 'ORDERS', 'R' || o_orderkey, {_cells(_UPDATE)} FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT o_orderkey * 10 + 3, 'delete', o_orderdate, 'ORDERS', 'R' || o_orderkey, {_cells(_DELETE)} FROM orders WHERE o_orderpriority = '5-LOW'
  UNION ALL SELECT c_custkey * 10 + 6, 'insert', TIMESTAMP '2000-01-01', 'CUSTOMER', 'C' || c_custkey, {_cells(_CUSTOMER)} FROM customer
)"""


def _redo(kind: str, *cols: str) -> str:
    names = {"name": "x.n", "value": "x.v", "column_type": "x.t", "last_value": "x.l"}
    picked = ", ".join(f"{names[c]} AS {c}" for c in cols)
    where = f"WHERE type = '{kind}'" if kind else ""
    return f"WITH {_CELLS} SELECT scn, x.i AS idx, {picked} FROM cells {where}"


_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S') || '.0'"
_CHANGE_EVENTS = f"""
WITH {_CELLS}
SELECT type, {_TS.format('ts')} AS timestamp, tab AS table_name, 'SALES' AS "database", rid AS row_id, CAST(scn AS VARCHAR) AS seq,
       x.i AS idx, x.n AS name, x.v AS value, x.t AS column_type, x.l AS last_value FROM cells
UNION ALL
SELECT 'delete', {_TS.format('o_orderdate')}, 'ORDERS', 'SALES', 'R' || o_orderkey, CAST(o_orderkey * 10 + 3 AS VARCHAR),
       NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderpriority = '1-URGENT'"""


def _doc(cells: list[tuple[str, str, str, str]]) -> str:
    parts = []
    for name, value, kind, _ in cells:
        text = f"CAST({value} AS VARCHAR)"
        shown = text if kind == "number" else f"'\"' || {text} || '\"'"
        parts.append(f"'\"{name}\":' || coalesce({shown}, 'null')")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_DOCS = f"""
docs AS (
  SELECT 'ORDERS' AS table_name, 'R' || o_orderkey AS row_id, o_orderkey * 10 + 1 AS seq, 'insert' AS operation, {_doc(_INSERT)} AS doc FROM orders
  UNION ALL SELECT 'ORDERS', 'R' || o_orderkey, o_orderkey * 10 + 2, 'insert', {_doc(_UPDATE)} FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT 'ORDERS', 'R' || o_orderkey, o_orderkey * 10 + 3, 'delete', {_doc(_DELETE)} FROM orders WHERE o_orderpriority = '5-LOW'
  UNION ALL SELECT 'ORDERS', 'R' || o_orderkey, o_orderkey * 10 + 3, 'delete', '{{}}' FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT 'CUSTOMER', 'C' || c_custkey, c_custkey * 10 + 6, 'insert', {_doc(_CUSTOMER)} FROM customer
)"""

_SNAPSHOT = f"""
WITH {_COMMITTED}, state AS (
  SELECT o.*, (c.k IS NOT NULL) AS done FROM orders o LEFT JOIN committed c ON c.k = o.o_orderkey
)
SELECT 'SALES' AS "database", 'ORDERS' AS table_name, 'R' || o_orderkey AS row_id,
       CASE WHEN done AND o_orderstatus <> 'O' THEN o_orderkey * 10 + 2 ELSE o_orderkey * 10 + 1 END AS seq,
       CASE WHEN done AND o_orderstatus <> 'O' THEN {_doc(_UPDATE)} ELSE {_doc(_INSERT)} END AS doc
FROM state WHERE NOT (done AND o_orderpriority = '5-LOW')"""


def _event_json() -> str:
    parts = []
    for name, value, kind, last in _UPDATE:
        def show(v: str, k: str = kind) -> str:
            text = f"CAST({v} AS VARCHAR)"
            return text if k == "number" else f"'\"' || {text} || '\"'"
        parts.append(
            f"'{{\"name\":\"{name}\",\"value\":' || coalesce({show(value)}, 'null') || ',\"column_type\":\"{kind}\"'"
            f" || coalesce(',\"last_value\":' || {show(last)}, '') || '}}'"
        )
    cols = " || ',' || ".join(parts)
    return f"""
SELECT o_orderkey * 10 + 2 AS scn,
  '{{"type":"update","timestamp":"' || {_TS.format('o_orderdate')} || '","table_name":"ORDERS","database":"SALES","row_id":"R' || o_orderkey
  || '","trx_code":"T' || o_custkey || '","seq":"' || (o_orderkey * 10 + 2) || '","columns":[' || {cols} || ']}}' AS value
FROM orders WHERE o_orderstatus <> 'O'"""


# ---- change table -----------------------------------------------------------------

_LSN = "datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))"
_IMAGES = f"""
images AS (
  SELECT {_LSN} AS lsn, o_orderkey * 4 AS seqno, 2 AS operation, o_orderkey AS id, {_PRICE} AS s, {_PRICE} AS old, o_orderstatus AS st, o_orderpriority AS pr, o_orderdate AS d FROM orders
  UNION ALL SELECT {_LSN}, o_orderkey * 4 + 1, 3, o_orderkey, {_PRICE}, {_PRICE}, o_orderstatus, o_orderpriority, o_orderdate FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT {_LSN}, o_orderkey * 4 + 1, 4, o_orderkey, {_PRICE2}, {_PRICE}, o_orderstatus, o_orderpriority, o_orderdate FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT {_LSN}, o_orderkey * 4 + 2, 1, o_orderkey, {_PRICE2}, {_PRICE}, o_orderstatus, o_orderpriority, o_orderdate FROM orders WHERE o_orderpriority = '5-LOW'
)"""


def _hex10(value: str, upper: bool = True) -> str:
    text = f"lpad(printf('%x', {value}), 20, '0')"
    return f"upper({text})" if upper else text


_SEQ = f"'0x' || {_hex10('lsn', upper=False)}"
_OP = "CASE operation WHEN 1 THEN 'delete' WHEN 2 THEN 'insert' ELSE 'update' END"
_CREATED = "CASE WHEN st <> 'P' THEN strftime(d, '%d-%m-%Y %H:%M:%S') || '.000' ELSE 'null' END"
_MARK = "'0x' || lower(hex(encode(pr)))"
_VALUES = [
    ("Id", "int", "CAST(id AS VARCHAR)", "CAST(id AS VARCHAR)"), ("Status", "nchar", "st", "st"),
    ("Sum", "decimal", "CAST(s AS VARCHAR)", "CAST(old AS VARCHAR)"), ("Mark", "varbinary", _MARK, _MARK),
    ("Create_Date", "datetime", _CREATED, _CREATED),
]


def _mssql_changes() -> str:
    cells = ", ".join(
        f"{{'i': {i}, 'n': '{n}', 't': '{t}', 'v': {v}, 'b': CASE WHEN operation = 4 THEN {b} END}}"
        for i, (n, t, v, b) in enumerate(_VALUES)
    )
    return f"""
WITH {_IMAGES}, x AS (
  SELECT {_SEQ} AS seq, {_OP} AS operation, {_TS.format('d')} AS trxDate, unnest([{cells}]) AS c FROM images WHERE operation <> 3
)
SELECT seq, operation, trxDate, c.i AS idx, c.n AS name, c.t AS type, c.v AS value, c.b AS before_value FROM x"""


def _topic_payload() -> str:
    names = ", ".join(f"'{n}'" for n, *_ in _VALUES)
    types = ", ".join(f"'{t}'" for _, t, *_ in _VALUES)
    data = ", ".join(v for *_, v, _ in _VALUES)
    before = ", ".join(b for *_, b in _VALUES)
    return f"""
WITH {_IMAGES}
SELECT 'mssql-cdc.orders.' || {_OP} AS topic,
  CAST(to_json({{'columns': [{names}], 'types': [{types}], 'keyColumns': ['Id'], 'data': [{data}],
    'before': CASE WHEN operation = 4 THEN [{before}] END, 'operation': {_OP}, 'trxDate': {_TS.format('d')},
    'schema': 'dbo', 'table': 'ORDERS', 'seq': {_SEQ}}}) AS VARCHAR) AS value
FROM images WHERE operation <> 3"""


# ---- messages -----------------------------------------------------------------------

_TOPIC = "topic AS (SELECT role AS topic, conv_id * 1000 + turn AS msg_id, base64(encode(CAST(conv_id * 1000 + turn AS VARCHAR))) AS message_id, text FROM conversations)"
_TRIM = r"'^[\x00-\x20]+|[\x00-\x20]+$'"
_FRAMES = f"""
pieces AS (
  SELECT doc_id, string_split(text, chr(10)) AS p FROM documents
), frames AS (
  SELECT doc_id, unnest(range(0, len(p) - 1)) AS pos,
         regexp_replace(replace(unnest(p[1:len(p) - 1]), chr(13), ''), {_TRIM}, '', 'g') AS record FROM pieces
)"""

_GREEDY = """
WITH RECURSIVE m AS (
  SELECT role AS topic, conv_id * 1000 + turn AS msg_id, strlen(text) AS s,
         row_number() OVER (PARTITION BY role ORDER BY conv_id * 1000 + turn) - 1 AS p FROM conversations
), g AS (
  SELECT topic, msg_id, p, p AS st, CAST(s AS BIGINT) AS total, 1 AS cnt FROM m WHERE p = 0
  UNION ALL
  SELECT m.topic, m.msg_id, m.p,
         CASE WHEN g.cnt < 20 AND g.total + m.s <= 8000 THEN g.st ELSE m.p END,
         CASE WHEN g.cnt < 20 AND g.total + m.s <= 8000 THEN g.total + m.s ELSE m.s END,
         CASE WHEN g.cnt < 20 AND g.total + m.s <= 8000 THEN g.cnt + 1 ELSE 1 END
  FROM g JOIN m ON m.topic = g.topic AND m.p = g.p + 1
)
SELECT topic, msg_id, p AS position, st AS bundle_start FROM g"""


# ---- trading messages ------------------------------------------------------------------

def _report(fields, given: dict[str, str], head: str, tail: str, source: str) -> str:
    types = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}
    cols = ", ".join(f"CAST({given.get(f.name, 'NULL')} AS {types[f.type]}) AS \"{f.name}\"" for f in fields)
    return f"SELECT {head}, {cols}, {tail} FROM {source}"


def _shifted(col: str) -> str:
    t = f"({col} + INTERVAL 3 HOUR)"
    return f"strftime({t}, '{ISO}') || '.000' AS \"TransactTime\", strftime({t}, '%Y-%m-%d') AS \"TransactDate\""


_L_SEQ = "(l_orderkey * 10 + l_linenumber)"


def _fix_execution() -> str:
    given = {
        "OrderID": "'O' || l_orderkey", "ExecID": f"'E' || {_L_SEQ}", "ComboMatchID": "'C' || l_partkey",
        "ExecType": "'0'", "OrdStatus": "'2'", "Account": "'A' || l_suppkey", "Symbol": "'P' || l_partkey",
        "Side": "CASE WHEN l_returnflag = 'R' THEN '2' ELSE '1' END", "OrderQty": "l_quantity", "Price": "l_extendedprice",
        "ExecRestatementReason": "l_linenumber", "CopyMsgIndicator": "l_linestatus = 'F'",
    }
    return _report(
        EXECUTION_FIELDS, given, "'L' || l_suppkey AS session, '8' AS \"MsgType\"",
        f"{_shifted('l_shipdate')}, 2 AS \"NoLegs\", {_L_SEQ} || ':O' || l_orderkey AS \"Id\"", "lineitem",
    )


_FIX_LEGS = f"""
SELECT {_L_SEQ} || ':O' || l_orderkey AS "Id", 0 AS leg_no, 'L' || l_partkey AS "LegSymbol", 'first' AS "LegSecurityID",
       CAST(NULL AS VARCHAR) AS "LegSecurityIDSource", CAST(l_extendedprice AS DOUBLE) AS "LegLastPx", CAST(l_quantity AS DOUBLE) AS "LegLastQty",
       CAST(NULL AS VARCHAR) AS "LegTrdMatchID" FROM lineitem
UNION ALL
SELECT {_L_SEQ} || ':O' || l_orderkey, 1, 'S' || l_suppkey, NULL, NULL, CAST(l_tax AS DOUBLE), NULL, CAST(l_linenumber AS VARCHAR) FROM lineitem"""


def _fix_trade() -> str:
    given = {
        "TradeReportID": "'TR' || o_orderkey", "TradeID": "'T' || o_orderkey", "TrdType": "0", "PreviouslyReported": "false",
        "Symbol": "'C' || o_custkey", "LastQty": "1", "LastPx": "o_totalprice", "TradeDate": "strftime(o_orderdate, '%Y%m%d')",
    }
    tail = (
        f"{_shifted('o_orderdate')}, o_orderkey || ':T' || o_orderkey AS \"Id\", '2' AS \"Side_Side\", 'A' || o_custkey AS \"Side_Account\","
        " 'O' || o_orderkey AS \"Side_OrderID\", CAST(NULL AS VARCHAR) AS \"Side_AllocID\""
    )
    return _report(
        TRADE_FIELDS, given, "o_orderpriority AS session, 'AE' AS \"MsgType\"", tail,
        "orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'",
    )


def _fix_quote() -> str:
    given = {
        "QuoteID": "'Q' || p_partkey", "QuoteType": "1", "Symbol": "p_name", "SecurityID": "p_brand", "BidPx": "p_retailprice",
        "OfferPx": "p_retailprice * 2", "BidSize": "p_size", "QuoteStatus": "0", "OrderCapacity": "'A'",
    }
    tail = "'2024-01-02T03:04:05.678' AS \"TransactTime\", p_partkey || ':Q' || p_partkey AS \"Id\""
    return _report(QUOTE_FIELDS, given, "'quotes' AS session, 'AI' AS \"MsgType\"", tail, "part")


_RETAIL = "CAST(p_retailprice AS DECIMAL(18,2))"
_QUOTE_TAGS = [
    (8, "'FIXT.1.1'"), (35, "'AI'"), (34, "p_partkey"), (52, "'20240102-03:04:05.678'"), (117, "'Q' || p_partkey"), (537, "'1'"),
    (55, "p_name"), (48, "p_brand"), (132, _RETAIL), (133, "CAST(p_retailprice * 2 AS DECIMAL(18,2))"), (134, "p_size"),
    (297, "'0'"), (528, "'A'"), (10, "'000'"),
]
_FIX_TAGS = (
    "WITH x AS (SELECT unnest([" + ", ".join(
        f"{{'pos': {i}, 'tag': {t}, 'val': CAST({v} AS VARCHAR)}}" for i, (t, v) in enumerate(_QUOTE_TAGS)
    ) + "]) AS x FROM part) SELECT 'quotes' AS session, x.pos AS pos, x.tag AS tag, x.val AS val FROM x"
)

_FIX_ROUTE = """
SELECT 'L' || l_suppkey AS session, '8' AS msg_type, 'execution' AS kind, CAST(NULL AS VARCHAR) AS error_code, count(*) AS messages
FROM lineitem GROUP BY l_suppkey
UNION ALL
SELECT o_orderpriority, CASE WHEN o_orderpriority = '5-LOW' THEN '0' ELSE 'AE' END,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'dropped' WHEN o_orderstatus = 'P' THEN 'failure' ELSE 'trade' END,
       CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus = 'P' THEN 'FieldNotFound' END, count(*)
FROM orders GROUP BY 1, 2, 3, 4
UNION ALL
SELECT 'quotes', 'AI', 'quote', NULL, count(*) FROM part"""


# the secret of the hashing query, filled up to 64 bytes with zeros, with each byte against 0x36 and 0x5c
_HASH_SECRET = "another secret"


def _hmac(text: str) -> str:
    inner, outer = ("".join(f"{b ^ pad:02x}" for b in _HASH_SECRET.encode().ljust(64, bytes(1))) for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({text}))))"


ORACLES = {
    "hop_sum": _window(["event_type"], "CAST(sum(v) AS DOUBLE) AS value_sum", 300, 60),
    "hop_count": _window(["event_type"], "count(*) AS count", 300, 60),
    "hop_weighted_count": _window(["user_id"], "CAST(sum(v) AS DOUBLE) AS count", 300, 60),
    "hop_avg": _window(
        ["event_type", "user_id"],
        "CAST(sum(v) AS DOUBLE) / count(*) AS value_avg, CAST(sum(u) AS DOUBLE) / count(*) AS user_id_avg", 300, 60, sep="|"),
    "tumbling_sum": _window(["event_type"], "CAST(sum(v) AS DOUBLE) AS value_sum", 300, 300),
    "sampled_window_sum": _window(["event_type"], "CAST(sum(v) AS DOUBLE) AS value_sum", 60, 300, sampled=True),
    "hop_sum_json": f"""
WITH e AS (
  SELECT CAST(event_type AS VARCHAR) AS event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS v, epoch_us(ts) // 1000000 AS s FROM events
), x AS (
  SELECT event_type, v, (s // 60) * 60 - k * 60 AS b FROM e, (SELECT unnest(range(0, 5)) AS k) shifts WHERE v IS NOT NULL
)
SELECT event_type, CAST(sum(v) AS BIGINT) AS k_sum, strftime(make_timestamp(b * 1000000), '{ISO}') AS begin_date,
       strftime(make_timestamp((b + 300) * 1000000), '{ISO}') AS end_date, base64(encode(event_type)) AS aggregation_id
FROM x GROUP BY event_type, b""",
    "cdc_all": _CDC_ALL,
    "cdc_committed": _CDC_COMMITTED,
    "cdc_committed_stream": _CDC_COMMITTED,
    "cdc_resume_offset": """
SELECT coalesce(max(scn) + 1, 1000) AS next_scn FROM (
  SELECT o_orderkey * 10 + CASE WHEN o_orderpriority IN ('5-LOW','1-URGENT') THEN 3 WHEN o_orderstatus <> 'O' THEN 2 ELSE 1 END AS scn FROM orders
) WHERE scn >= 1000""",
    "log_segments": """
WITH seg AS (SELECT DISTINCT o_orderkey // 1000 AS g FROM orders), lim AS (SELECT max(o_orderkey) // 2000 AS h FROM orders),
live AS (SELECT g FROM seg, lim WHERE g >= h AND (g * 10000 >= 40005 OR (g * 10000 <= 40005 AND 40005 < g * 10000 + 10000)))
SELECT 'online' AS kind, g * 10000 AS first_change, 'redo_' || g || '_' || m AS member FROM live, (SELECT unnest(['a','b']) AS m)
UNION ALL
SELECT 'archived', g * 10000, 'arch_' || g FROM seg, lim
WHERE g < h AND 40005 < (SELECT min(g) * 10000 FROM live)
  AND ((g * 10000 >= 40005 AND g * 10000 + 10000 <= (SELECT min(g) * 10000 FROM live)) OR (g * 10000 <= 40005 AND 40005 < g * 10000 + 10000))""",
    "redo_insert": _redo("insert", "name", "value"),
    "redo_update": _redo("update", "name", "value", "last_value"),
    "redo_delete": _redo("delete", "name", "value"),
    "redo_types": _redo("", "name", "column_type"),
    "redo_long_text": "SELECT doc_id, text, lang, 3 AS n_columns FROM documents",
    "change_events": _CHANGE_EVENTS,
    "event_json": _event_json(),
    "change_to_doc": f"WITH {_DOCS} SELECT 'SALES' AS \"database\", table_name, row_id, seq, operation, doc FROM docs",
    "bulk_actions": f"""
WITH {_DOCS}
SELECT seq, '{{"' || CASE operation WHEN 'delete' THEN 'delete' ELSE 'index' END || '":{{"_index":"sales-' || lower(table_name) || '","_id":"' || row_id || '"}}}}'
  || CASE operation WHEN 'delete' THEN '' ELSE chr(10) || doc END AS body FROM docs""",
    "snapshot_merge": _SNAPSHOT,
    "snapshot_stream_apply": _SNAPSHOT,
    "mssql_poll": f"""
WITH {_IMAGES}, cut AS (
  SELECT max(lsn) AS top FROM (SELECT lsn FROM images ORDER BY lsn, seqno, operation LIMIT 1000)
)
SELECT {_hex10('lsn')} AS start_lsn, {_hex10('seqno')} AS seqval, operation, id AS "Id", s AS "Sum" FROM images WHERE lsn <= (SELECT top FROM cut)""",
    "mssql_changes": _mssql_changes(),
    "mssql_key_values": f"WITH {_IMAGES} SELECT {_SEQ} AS seq, {_OP} AS operation, CAST(id AS VARCHAR) AS key_value, {_CREATED} AS created, CAST(NULL AS VARCHAR) AS absent FROM images WHERE operation <> 3",
    "topic_payload": _topic_payload(),
    "capture_choice": """
WITH per AS (SELECT o_custkey AS c, o_orderstatus AS s, min(o_orderkey) AS k FROM orders GROUP BY 1, 2),
ranked AS (SELECT *, count(*) OVER (PARTITION BY c) AS n, row_number() OVER (PARTITION BY c ORDER BY k) AS r, max(k) OVER (PARTITION BY c) AS newest FROM per),
picked AS (SELECT * FROM ranked WHERE n = 1 OR (n = 2 AND r = CASE WHEN newest <= 5000 THEN 2 ELSE 1 END))
SELECT 't' || c AS table_name, 'dbo_t' || c || '_' || s AS capture_instance, 'Id|' || s AS key_columns, CAST(NULL AS VARCHAR) AS error FROM picked
UNION ALL SELECT DISTINCT 't' || c, NULL, NULL, 'there must be one or two captures' FROM ranked WHERE n > 2""",
    "crypto_encrypt": """
WITH p AS (SELECT c_custkey, c_mktsegment || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS plain FROM customer)
SELECT c_custkey, CAST(strlen(plain) // 16 * 16 + 16 AS INTEGER) AS sealed_bytes, count(*) OVER (PARTITION BY plain) AS alike, plain AS opened, FALSE AS readable FROM p""",
    "crypto_json": """
SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '","c_acctbal":"' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '"}' AS value
FROM customer""",
    "crypto_roundtrip": "SELECT c_custkey, c_name, c_mktsegment, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal FROM customer",
    "crypto_hmac": f"SELECT c_custkey, {_hmac('c_name')} AS name_hash FROM customer",
    "crypto_plan": f"SELECT c_custkey, {_hmac('c_name')} AS c_name, c_mktsegment, {_hmac('CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)')} AS c_acctbal FROM customer",
    "quarantine_split": "SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'ok' ELSE 'rejected' END AS outcome FROM customer",
    "incremental_plan": """
SELECT CASE WHEN m IS NULL OR m < 3000 THEN 'error' WHEN m = 3000 THEN 'nonExecutable' ELSE 'executable' END AS outcome,
       CASE WHEN m IS NULL THEN 'maxIndex == null' WHEN m < 3000 THEN 'maxIndex < startIndex' WHEN m = 3000 THEN 'maxIndex == startIndex' END AS reason,
       m AS max_index, CAST(3000 AS BIGINT) AS start_index, CASE WHEN m > 3000 THEN CAST(3001 AS BIGINT) END AS from_id,
       CASE WHEN m > 3000 THEN least(m, 8000) END AS to_id, CASE WHEN m > 3000 THEN least(m, 8000) ELSE 3000 END AS next_offset
FROM (SELECT max(o_orderkey) AS m FROM orders)""",
    "incremental_batch": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey BETWEEN 3001 AND 8000",
    "replicate": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 100000",
    "topic_read_from": f"WITH {_TOPIC} SELECT topic, msg_id, message_id, text FROM topic WHERE topic = 'user' AND msg_id > 5003 ORDER BY msg_id LIMIT 100",
    "topic_subscribe": f"WITH {_TOPIC} SELECT topic, msg_id, message_id, text FROM topic WHERE topic IN ('user','assistant') AND length(text) > 0",
    "topic_pattern": f"WITH {_TOPIC} SELECT topic, msg_id, message_id, text FROM topic WHERE topic IN ('user','system') AND length(text) > 0",
    "frame_records": f"WITH {_FRAMES} SELECT doc_id, pos, record FROM frames",
    "frame_stream_files": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'none') AS lang, doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents
), lines AS (
  SELECT lang, doc_id, unnest(range(0, len(p))) AS i, unnest(p) AS line FROM pieces
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id, i) - 1 AS pos, regexp_replace(replace(line, chr(13), ''), {_TRIM}, '', 'g') AS record FROM lines""",
    "bundle_by_count": f"""
WITH {_FRAMES}
SELECT doc_id, pos // 10 AS bundle, count(*) AS records, string_agg(record, chr(10) ORDER BY pos) || chr(10) AS content FROM frames GROUP BY 1, 2""",
    "bundle_topic_by_count": f"""
WITH {_TOPIC}, n AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY msg_id) - 1 AS p FROM topic)
SELECT topic, p // 10 AS bundle, count(*) AS records, string_agg(text, chr(10) ORDER BY p) || chr(10) AS content FROM n GROUP BY 1, 2""",
    "bundle_by_bytes": _GREEDY,
    "split_messages": """
WITH pieces AS (SELECT doc_id, string_split(text, '. ') AS p FROM documents)
SELECT doc_id, unnest(range(0, len(p))) AS pos, unnest(p) AS message FROM pieces""",
    "route_round_robin": "SELECT o_orderkey, o_custkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 8 AS INTEGER) AS partition_id FROM orders",
    "route_single": "SELECT o_orderkey, o_custkey, 0 AS partition_id FROM orders",
    "route_custom": "SELECT o_orderkey, o_custkey, CAST(o_custkey % 8 AS INTEGER) AS partition_id FROM orders",
    "fix_tags": _FIX_TAGS,
    "fix_route": _FIX_ROUTE,
    "fix_execution": _fix_execution(),
    "fix_legs": _FIX_LEGS,
    "fix_trade": _fix_trade(),
    "fix_quote": _fix_quote(),
    "fix_seq_gaps": """
SELECT * FROM (
  SELECT o_orderpriority AS session, o_orderkey AS seq, lag(o_orderkey) OVER w AS prev_seq, o_orderkey - lag(o_orderkey) OVER w - 1 AS missing
  FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey)
) WHERE missing <> 0""",
}
ORACLES["hop_sum_stream"] = ORACLES["hop_sum"]
ORACLES["snapshot_store_stream"] = ORACLES["snapshot_merge"]
ORACLES["mssql_changes_stream"] = ORACLES["mssql_changes"]
ORACLES["fix_seq_gaps_stream"] = ORACLES["fix_seq_gaps"]
ORACLES["mssql_poll_handover"] = f"""
WITH {_IMAGES}, days AS (SELECT min(lsn) AS low, max(lsn) AS high FROM images),
borders AS (SELECT (low + high) // 2 AS middle, low + (high - low) // 4 AS start FROM days),
later AS (SELECT images.*, middle, row_number() OVER (ORDER BY lsn, seqno, operation) AS n FROM images, borders WHERE lsn > start),
cut AS (SELECT max(lsn) AS top FROM later WHERE n <= 1000 + (SELECT count(*) FROM later WHERE lsn < middle))
SELECT CASE WHEN lsn < middle THEN 'dbo_ORDERS' ELSE 'dbo_ORDERS_2' END AS capture_instance, {_hex10('lsn')} AS start_lsn, {_hex10('seqno')} AS seqval,
       operation, id AS "Id", s AS "Sum", CASE WHEN lsn < middle THEN hex(encode(pr)) END AS "Mark",
       CASE WHEN lsn >= middle AND st <> 'P' THEN strftime(d, '%Y-%m-%d') END AS "Create_Date"
FROM later WHERE lsn <= (SELECT top FROM cut)"""
ORACLES["hop_minmax"] = _window(
    ["event_type"], "min(v)::DOUBLE AS lowest, max(v)::DOUBLE AS highest, first(v ORDER BY us, v)::DOUBLE AS opened, last(v ORDER BY us, v)::DOUBLE AS closed", 300, 60)
ORACLES["hop_distinct"] = _window(["event_type"], "count(DISTINCT u) AS users, count(*) AS events, sum(u % 7)::BIGINT AS bits", 250, 100)
ORACLES["hop_minmax_stream"] = ORACLES["hop_minmax"]
ORACLES["bulk_bodies"] = f"""
WITH lines AS ({ORACLES["bulk_actions"]}), n AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS p FROM lines)
SELECT p // 1000 AS bundle, min(seq)::BIGINT AS first_seq, max(seq)::BIGINT AS last_seq, count(*) AS records,
       string_agg(body, chr(10) ORDER BY p) || chr(10) AS content FROM n GROUP BY 1"""
# an event arrives with its sixth of the time span, at the time of the newest event there
ORACLES["hop_arrival_stream"] = f"""
WITH e AS (
  SELECT CAST(event_type AS VARCHAR) AS event_type, user_id AS u, epoch_us(ts) // 1000000 AS s FROM events
), span AS (
  SELECT min(s) AS low, (max(s) - min(s)) // 6 + 1 AS step, max(s) AS top FROM e
), parts AS (
  SELECT event_type, u, max(s) OVER (PARTITION BY (s - low) // step) AS a, top FROM e, span
), x AS (
  SELECT event_type, u, (a // 86400 - k) * 86400 AS b FROM parts, (SELECT unnest(range(0, 2)) AS k) shifts
  WHERE (a // 86400 - k + 2) * 86400 <= top
)
SELECT event_type, count(*) AS events, sum(u)::BIGINT AS users,
       strftime(make_timestamp(b * 1000000), '{ISO}') AS begin_date,
       strftime(make_timestamp((b + 172800) * 1000000), '{ISO}') AS end_date,
       base64(encode(event_type)) AS aggregation_id
FROM x GROUP BY event_type, b"""
ORACLES["cdc_stream_resume"] = ORACLES["cdc_all"]
ORACLES["cdc_committed_positioned"] = ORACLES["cdc_committed"]
