"""Change logs, change tables, message logs and topics derived from base tables.

Every base row contributes, so the work of a query grows with its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

REDO_TABLES = "SALES.ORDERS,SALES.CUSTOMER"
NOTE = "It''s late, see where and why"
DATE_FORMAT = "yyyy-MM-dd\"T\"HH24:MI:SS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(col: str | Column) -> Column:
    return F.col(col).cast("decimal(18,2)") if isinstance(col, str) else col.cast("decimal(18,2)")


def _quoted(value: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(value.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))


def _to_date(value: Column) -> Column:
    return F.concat(F.lit("TO_DATE('"), F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(f"', '{DATE_FORMAT}')"))


def redo_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redo log of ORDERS and CUSTOMER.

    Each order k is inserted at scn 10k+1, updated at 10k+2 unless its status is
    O, and deleted at 10k+3 when its priority is 5-LOW. Orders of one customer
    share a transaction id; status F commits it at 10k+4, P rolls it back, O
    leaves it open for the next order. Priority 1-URGENT adds a row that undoes a
    savepoint. Customers are inserted and committed one by one.
    """
    o = table(spark, sf_dir, "orders")
    k, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    price, date = money("o_totalprice"), _to_date(F.col("o_orderdate"))
    name = '"SALES"."ORDERS"'
    insert = F.concat(
        F.lit(f'insert into {name}("O_ORDERKEY","O_CUSTKEY","O_ORDERSTATUS","O_TOTALPRICE","O_ORDERDATE","O_ORDERPRIORITY","O_NOTE") values ('),
        _quoted(k), F.lit(","), _quoted(F.col("o_custkey")), F.lit(","), _quoted(status), F.lit(","), _quoted(price),
        F.lit(","), date, F.lit(","), _quoted(priority), F.lit(",NULL);"),
    )
    update = F.concat(
        F.lit(f'update {name} set "O_TOTALPRICE" = '), _quoted(money(F.col("o_totalprice") * 2)),
        F.lit(f''', "O_NOTE" = '{NOTE}', "O_CLERK" = NULL where "O_ORDERKEY" = '''), _quoted(k),
        F.lit(' and "O_TOTALPRICE" = '), _quoted(price), F.lit(' and "O_ORDERDATE" = '), date,
        F.lit(' and "O_NOTE" IS NULL and ROWID = '), _quoted(F.concat(F.lit("R"), k)), F.lit(";"),
    )
    delete = F.concat(
        F.lit(f'delete from {name} where "O_ORDERKEY" = '), _quoted(k), F.lit(' and "O_ORDERSTATUS" = '), _quoted(status),
        F.lit(' and "O_NOTE" IS NULL and ROWID = '), _quoted(F.concat(F.lit("R"), k)), F.lit(";"),
    )

    def row(when: Column, offset: int, op: str, code: int, sql: Column, rollback: int = 0) -> Column:
        return F.when(when, F.struct(
            (k * 10 + offset).alias("scn"), F.lit(op).alias("operation"), F.lit(code).alias("operation_code"),
            F.lit(rollback).alias("rollback"), sql.alias("sql_redo"),
        ))

    none = F.lit(None).cast("string")
    rows = F.filter(F.array(
        row(F.lit(True), 1, "INSERT", 1, insert),
        row(status != "O", 2, "UPDATE", 3, update),
        row(priority == "5-LOW", 3, "DELETE", 2, delete),
        row(priority == "1-URGENT", 3, "DELETE", 2, F.lit(f"delete from {name};"), 1),
        row(status == "F", 4, "COMMIT", 7, none),
        row(status == "P", 4, "ROLLBACK", 36, none),
    ), lambda r: r.isNotNull())
    orders = o.select(
        F.concat(F.lit("T"), "o_custkey").alias("xid"), F.inline(rows),
        F.col("o_orderdate").alias("ts"), F.concat(F.lit("R"), k).alias("row_id"), F.lit("ORDERS").alias("seg_name"),
    )
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    c_insert = F.concat(
        F.lit('insert into "SALES"."CUSTOMER"("C_CUSTKEY","C_NAME","C_ACCTBAL") values ('),
        _quoted(ck), F.lit(","), _quoted(F.col("c_name")), F.lit(","), _quoted(money("c_acctbal")), F.lit(");"),
    )
    customers = c.select(
        F.concat(F.lit("C"), ck).alias("xid"),
        F.inline(F.array(
            F.struct((ck * 10 + 6).alias("scn"), F.lit("INSERT").alias("operation"), F.lit(1).alias("operation_code"),
                     F.lit(0).alias("rollback"), c_insert.alias("sql_redo")),
            F.struct((ck * 10 + 7).alias("scn"), F.lit("COMMIT").alias("operation"), F.lit(7).alias("operation_code"),
                     F.lit(0).alias("rollback"), none.alias("sql_redo")),
        )),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("C"), ck).alias("row_id"), F.lit("CUSTOMER").alias("seg_name"),
    )
    return orders.unionByName(customers).withColumn("seg_owner", F.lit("SALES"))


def change_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change table of ORDERS: an insert per order, an update unless its status
    is O, a delete when its priority is 5-LOW. One transaction per order date."""
    o = table(spark, sf_dir, "orders")
    k, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.datediff("o_orderdate", F.lit("1970-01-01").cast("date"))

    def row(when: Column, offset: int, op: int, price: Column) -> Column:
        seq = k * 4 + offset
        return F.when(when, F.struct(
            F.unhex(F.lpad(F.hex(seq), 20, "0")).alias("seqval"), F.lit(op).alias("operation"),
            money(price).alias("Sum"),
        ))

    price = F.col("o_totalprice")
    rows = F.filter(F.array(
        row(F.lit(True), 0, 2, price),
        row(status != "O", 1, 3, price),
        row(status != "O", 1, 4, price * 2),
        row(priority == "5-LOW", 2, 1, price * 2),
    ), lambda r: r.isNotNull())
    return o.select(
        F.col("o_orderdate").alias("trx_time"),
        F.unhex(F.lpad(F.hex(day.cast("long")), 20, "0")).alias("start_lsn"),
        F.inline(rows),
        k.alias("Id"), status.alias("Status"),
        F.encode(priority, "UTF-8").alias("Mark"),
        F.when(status != "P", F.col("o_orderdate")).alias("Create_Date"),
    )


CHANGE_COLUMNS = [
    ("Id", "int"), ("Status", "nchar"), ("Sum", "decimal"), ("Mark", "varbinary"), ("Create_Date", "datetime"),
]


def fix_log(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Message log: executions from line items, trades from orders, quotes from parts."""
    def message(*pairs: tuple[int, Column | str]) -> Column:
        parts = []
        for tag, value in pairs:
            v = F.lit(value) if isinstance(value, str) else value.cast("string")
            parts.append(F.concat(F.lit(f"{tag}="), v, F.lit("\x01")))
        return F.concat(*parts)

    def day(col: str) -> Column:
        return F.date_format(col, "yyyyMMdd-HH:mm:ss.SSS")

    if kind == "execution":
        l = table(spark, sf_dir, "lineitem")
        qty, px = money("l_quantity"), money("l_extendedprice")
        seq = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        raw = message(
            (8, "FIXT.1.1"), (35, "8"), (34, seq), (52, day("l_shipdate")), (37, F.concat(F.lit("O"), "l_orderkey")),
            (17, F.concat(F.lit("E"), seq)), (150, "0"), (39, "2"), (1, F.concat(F.lit("A"), "l_suppkey")),
            (55, F.concat(F.lit("P"), "l_partkey")), (54, F.when(F.col("l_returnflag") == "R", "2").otherwise("1")),
            (38, qty), (44, px), (60, day("l_shipdate")), (797, F.when(F.col("l_linestatus") == "F", "Y").otherwise("N")),
            (378, F.col("l_linenumber")), (20034, F.concat(F.lit("C"), "l_partkey")), (555, "2"),
            (600, F.concat(F.lit("L"), "l_partkey")), (602, "first"), (637, px), (1418, qty),
            (600, F.concat(F.lit("S"), "l_suppkey")), (637, money("l_tax")), (20200, F.col("l_linenumber")), (10, "000"),
        )
        return l.select(F.concat(F.lit("L"), "l_suppkey").alias("session"), raw.alias("raw"))
    if kind == "trade":
        o = table(spark, sf_dir, "orders")
        k = F.col("o_orderkey")
        time = F.when(F.col("o_orderstatus") == "P", "").otherwise(
            F.concat(F.lit("60="), day("o_orderdate"), F.lit("\x01")))
        raw = F.concat(
            message(
                (8, "FIXT.1.1"), (35, F.when(F.col("o_orderpriority") == "5-LOW", "0").otherwise("AE")), (34, k),
                (52, day("o_orderdate")), (571, F.concat(F.lit("TR"), k)), (1003, F.concat(F.lit("T"), k)), (828, "0"),
                (570, "N"), (55, F.concat(F.lit("C"), "o_custkey")), (32, "1"), (31, money("o_totalprice")),
                (75, F.date_format("o_orderdate", "yyyyMMdd")),
            ),
            time,
            message((552, "1"), (54, "2"), (1, F.concat(F.lit("A"), "o_custkey")), (37, F.concat(F.lit("O"), k)), (10, "000")),
        )
        return o.select(F.col("o_orderpriority").alias("session"), raw.alias("raw"))
    p = table(spark, sf_dir, "part")
    k, px = F.col("p_partkey"), money("p_retailprice")
    raw = message(
        (8, "FIXT.1.1"), (35, "AI"), (34, k), (52, F.lit("20240102-03:04:05.678")), (117, F.concat(F.lit("Q"), k)),
        (537, "1"), (55, F.col("p_name")), (48, F.col("p_brand")), (132, px), (133, money(px * 2)), (134, F.col("p_size")),
        (297, "0"), (528, "A"), (10, "000"),
    )
    return p.select(F.lit("quotes").alias("session"), raw.alias("raw"))


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as topic messages: the role is the topic."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.col("role").alias("topic"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"),
        F.encode("text", "UTF-8").alias("payload"),
    )


def segments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(online, archived, members): one log segment per 1000 order keys.

    Segments cover 10000 scn each; those of the upper half are still online.
    """
    o = table(spark, sf_dir, "orders")
    group_no = F.expr("o_orderkey div 1000")
    seg = o.groupBy(group_no.alias("group_no")).agg(F.max("o_orderdate").alias("first_time"))
    seg = seg.select(
        "group_no", (F.col("group_no") * 10000).alias("first_change"),
        (F.col("group_no") * 10000 + 10000).alias("next_change"), "first_time",
    )
    half = o.agg(F.expr("max(o_orderkey) div 2000").alias("half")).scalar()
    online = seg.where(F.col("group_no") >= half)
    archived = seg.where(F.col("group_no") < half).withColumn("member", F.concat(F.lit("arch_"), "group_no")).drop("group_no")
    members = online.select("group_no", F.explode(F.array(
        F.concat(F.lit("redo_"), "group_no", F.lit("_a")), F.concat(F.lit("redo_"), "group_no", F.lit("_b")),
    )).alias("member"))
    return online, archived, members


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture instances: each customer is a source table, each status of its
    orders a capture, so tables have one, two or three of them."""
    per = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderkey").alias("first_key"))
    return per.select(
        F.lit("dbo").alias("schema_name"), F.concat(F.lit("t"), "o_custkey").alias("table_name"),
        F.concat(F.lit("dbo_t"), "o_custkey", F.lit("_"), "o_orderstatus").alias("capture_instance"),
        F.concat(F.lit("[Id], ["), "o_orderstatus", F.lit("]")).alias("index_column_list"),
        F.timestamp_seconds("first_key").alias("create_date"),
        F.unhex(F.lpad(F.hex("first_key"), 20, "0")).alias("start_lsn"),
    )


def handover(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame], int, int]:
    """(captures, change tables, day after which to read, rows up to the handover) for two instances of ORDERS.

    The newer instance starts at the middle day of the orders, lacks ``Mark`` and has ``Create_Date``; the older one goes on beyond that day.
    """
    changes = change_table(spark, sf_dir)
    day = F.datediff("o_orderdate", F.lit("1970-01-01").cast("date"))
    ends = table(spark, sf_dir, "orders").agg(F.min(day).alias("low"), F.max(day).alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    middle, after = (low + high) // 2, low + (high - low) // 4
    border = F.lit(lsn(middle))
    rows = [("dbo", "ORDERS", "dbo_ORDERS", "[Id]", low, lsn(low)), ("dbo", "ORDERS", "dbo_ORDERS_2", "[Id]", middle, lsn(middle))]
    captures = spark.createDataFrame(rows, "schema_name string, table_name string, capture_instance string, index_column_list string, day int, start_lsn binary")
    captures = captures.withColumn("create_date", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).cast("timestamp_ntz")).drop("day")
    tables = {"dbo_ORDERS": changes.drop("Create_Date"), "dbo_ORDERS_2": changes.where(F.col("start_lsn") >= border).drop("Mark")}
    before = changes.where((F.col("start_lsn") > F.lit(lsn(after))) & (F.col("start_lsn") < border)).count()
    return captures, tables, after, before


def lsn(value: int) -> bytes:
    return value.to_bytes(10, "big")
