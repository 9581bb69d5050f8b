"""The registered queries. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowtables.functions import crypto
from flowtables.operators import bundles, field_crypto, fix, gate, quarantine, redo_events, row_changes, snapshot
from flowtables.operators import pane_aggregates as panes
from flowtables.operators.windows import hop_aggregate
from flowtables.plans import derived
from flowtables.plans.derived import REDO_TABLES, money, table
from flowtables.session import scratch_dir
from flowtables.sinks import bulk, replicate as replication, topics as topic_sink
from flowtables.sources import changelog, changetable, frames, incremental, json_messages, positioned, topics
from flowtables.streaming import arrival, gate as gate_stream, keyed_store, pairing, panes as pane_stream, sequences, snapshot as snapshot_stream, waiting, windows as window_stream

SECRET = "a shared secret for the field plan"
HASH_SECRET = "another secret"
IV = "1,-2,3,-4,5,-6,7,-8,9,-10,11,-12,13,-14,15,-16"
ORDERS_ONLY = "SALES.ORDERS"


# ---- windows -------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("ts", "event_type", "user_id", money("value").alias("value"))


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def hop_sum(spark, sf_dir):
    return _doubles(hop_aggregate(_events(spark, sf_dir), ["event_type"], ["value"], "sum", 300, 60), "value_sum")


def hop_count(spark, sf_dir):
    return hop_aggregate(_events(spark, sf_dir), ["event_type"], how="count", window=300, hop=60)


def hop_weighted_count(spark, sf_dir):
    return _doubles(hop_aggregate(_events(spark, sf_dir), ["user_id"], ["value"], "count", 300, 60), "count")


def hop_avg(spark, sf_dir):
    return hop_aggregate(_events(spark, sf_dir), ["event_type", "user_id"], ["value", "user_id"], "avg", 300, 60, separator="|")


def tumbling_sum(spark, sf_dir):
    return _doubles(hop_aggregate(_events(spark, sf_dir), ["event_type"], ["value"], "sum", 300, 300), "value_sum")


def sampled_window_sum(spark, sf_dir):
    return _doubles(hop_aggregate(_events(spark, sf_dir), ["event_type"], ["value"], "sum", 60, 300), "value_sum")


def hop_sum_json(spark, sf_dir):
    """Sums over the number in each event's JSON text; rows without it are set aside."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", F.col("props").alias("message"))
    good, _ = quarantine.split(json_messages.read_json(events, "message", "k long", required=["k"]))
    return hop_aggregate(good, ["event_type"], ["k"], "sum", 300, 60).withColumn("k_sum", F.col("k_sum").cast("long"))


def hop_sum_stream(spark, sf_dir):
    """The events arrive in four parts, each with events of all times."""
    root = scratch_dir(spark, "hop_sum_stream")
    source = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    source.repartition(4, "user_id", "ts").write.option("maxRecordsPerFile", 0).parquet(f"{root}/in")
    events = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    options = dict(fields=["value"], how="sum", window=300, hop=60)
    window_stream.start_running_windows(
        events, f"{root}/out", f"{root}/checkpoint", ["event_type"], **options
    ).awaitTermination()
    schema = hop_aggregate(_events(spark, sf_dir), ["event_type"], **options).schema
    return _doubles(window_stream.read_running_windows(spark, f"{root}/out", schema, ["event_type"]), "value_sum")


def _range_of_values() -> list[panes.Aggregate]:
    value = F.col("value").cast("double")
    return [panes.least("lowest", value), panes.greatest("highest", value), panes.first("opened", value, F.col("ts")), panes.last("closed", value, F.col("ts"))]


def _visitors() -> list[panes.Aggregate]:
    return [panes.distinct("users", F.col("user_id").cast("long")), panes.count("events"), panes.total("bits", F.col("user_id") % 7)]


def hop_minmax(spark, sf_dir):
    """Lowest, highest, first and last value of each window."""
    return panes.hop_aggregate_by(_events(spark, sf_dir), ["event_type"], _range_of_values(), 300, 60)


def hop_distinct(spark, sf_dir):
    """Different users per window, from sketches, beside two plain sums; windows of 250 seconds every 100."""
    return panes.hop_aggregate_by(_events(spark, sf_dir), ["event_type"], _visitors(), 250, 100)


def hop_minmax_stream(spark, sf_dir):
    """As ``hop_minmax``, from states of six micro-batches in three runs; folded after the second."""
    root = scratch_dir(spark, "hop_minmax_stream")
    source = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    groups, aggregates, windows = ["event_type"], _range_of_values(), {"window": 300, "hop": 60}
    for run in range(3):
        part = source.where(F.pmod(F.xxhash64("ts", "user_id"), F.lit(3)) == run)
        part.repartition(2, "user_id", "ts").write.option("maxRecordsPerFile", 0).mode("append").parquet(f"{root}/in")
        events = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        pane_stream.start_pane_states(events, f"{root}/states", f"{root}/checkpoint", groups, aggregates, **windows).awaitTermination()
        if run == 1:
            pane_stream.fold(spark, f"{root}/states", groups, aggregates)
    return pane_stream.read_windows(spark, f"{root}/states", groups, aggregates, **windows)


def hop_arrival_stream(spark, sf_dir):
    """Windows over arrival time, of two days every day: the events come in six parts, each as late as its newest event, in six runs."""
    root = scratch_dir(spark, "hop_arrival_stream")
    source = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("user_id").cast("long").alias("user_id"))
    span = source.agg(F.unix_seconds(F.min("ts")).alias("low"), F.unix_seconds(F.max("ts")).alias("top")).first()
    low, step = span["low"] or 0, ((span["top"] or 0) - (span["low"] or 0)) // 6 + 1

    def newest(rows: DataFrame) -> float:
        return rows.agg(F.unix_seconds(F.max("ts"))).first()[0] or 0

    aggregates = [panes.count("events"), panes.total("users", F.col("user_id"))]
    for part in range(6):
        inside = source.where(F.floor((F.unix_seconds("ts") - low) / step) == part)
        inside.write.mode("append").parquet(f"{root}/in")
        events = spark.readStream.schema(source.schema).parquet(f"{root}/in")
        arrival.start_arrival_windows(
            events, ["event_type"], aggregates, f"{root}/out", f"{root}/state", f"{root}/checkpoint",
            window=172_800, hop=86_400, clock=newest, fold_every=2).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch")


# ---- redo log -------------------------------------------------------------------

def _log(spark, sf_dir) -> DataFrame:
    return derived.redo_log(spark, sf_dir)


def _change_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "scn", F.lower("operation").alias("type"), F.col("seg_owner").alias("database"),
        F.col("seg_name").alias("table_name"), "row_id",
    )


def cdc_all(spark, sf_dir):
    return _change_columns(changelog.scan_all(_log(spark, sf_dir), REDO_TABLES))


def _committed_columns(df: DataFrame) -> DataFrame:
    return df.select("scn", "commit_scn", "xid", F.lower("operation").alias("type"), "row_id")


def _committed(spark, sf_dir) -> DataFrame:
    return gate.committed_only(changelog.scan_transactional(_log(spark, sf_dir), ORDERS_ONLY))


def cdc_committed(spark, sf_dir):
    return _committed_columns(_committed(spark, sf_dir))


def cdc_committed_stream(spark, sf_dir):
    """The log arrives in three parts; the stream stops and restarts after each."""
    rows = changelog.scan_transactional(_log(spark, sf_dir), ORDERS_ONLY)
    root = scratch_dir(spark, "cdc_committed_stream")
    top = rows.agg(F.max("scn")).first()[0] or 0
    bounds = [0, top // 3, 2 * top // 3, top]
    for low, high in zip(bounds, bounds[1:]):
        rows.where((F.col("scn") > low) & (F.col("scn") <= high)).write.mode("append").parquet(f"{root}/log")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/log")
        gate_stream.start_committed(stream, f"{root}/out", f"{root}/pending", f"{root}/checkpoint").awaitTermination()
    return _committed_columns(spark.read.parquet(f"{root}/out"))


def cdc_stream_resume(spark, sf_dir):
    """All changes of the log, which grows once, read by position in six batches or more and two runs."""
    spark.dataSource.register(positioned.PositionedLog)
    root = scratch_dir(spark, "cdc_stream_resume")
    rows = _log(spark, sf_dir).select("scn", "operation", "operation_code", "seg_owner", "seg_name", "row_id")
    counts = rows.agg(F.count("*").alias("n"), F.max("scn").alias("top")).first()
    half, limit = (counts["top"] or 0) // 2, max(1, counts["n"] // 7)
    for part in (F.col("scn") <= half, F.col("scn") > half):
        rows.where(part).repartitionByRange(4, "scn").write.mode("append").parquet(f"{root}/log")
        log = spark.readStream.format("positioned_log").schema(rows.schema).options(
            path=f"{root}/log", position="scn", max_rows=str(limit), progress=f"{root}/progress").load()
        query = log.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").start()
        query.processAllAvailable()
        query.stop()
    return _change_columns(changelog.scan_all(spark.read.schema(rows.schema).parquet(f"{root}/out"), REDO_TABLES))


def cdc_committed_positioned(spark, sf_dir):
    """The log read by position, some thousand rows a batch, and gated by what each batch decides; folded and restarted half way."""
    spark.dataSource.register(positioned.PositionedLog)
    rows = changelog.scan_transactional(_log(spark, sf_dir), ORDERS_ONLY).select("scn", "xid", "operation", "operation_code", "row_id")
    root = scratch_dir(spark, "cdc_committed_positioned")
    counts = rows.agg(F.count("*").alias("n"), F.max("scn").alias("top")).first()
    half, limit = (counts["top"] or 0) // 2, max(1, counts["n"] // 3)
    for part in (F.col("scn") <= half, F.col("scn") > half):
        rows.where(part).repartitionByRange(4, "scn").write.mode("append").parquet(f"{root}/log")
        log = spark.readStream.format("positioned_log").schema(rows.schema).options(
            path=f"{root}/log", position="scn", max_rows=str(limit), progress=f"{root}/progress").load()
        query = waiting.start_committed_deltas(log, f"{root}/out", f"{root}/waiting", f"{root}/checkpoint", trigger={"processingTime": "0 seconds"}, buckets=4)
        query.processAllAvailable()
        query.stop()
        waiting.fold(spark, f"{root}/waiting", rows.schema)
    return _committed_columns(spark.read.parquet(f"{root}/out"))


def cdc_resume_offset(spark, sf_dir):
    return changelog.next_offset(changelog.scan_all(_log(spark, sf_dir), ORDERS_ONLY, start=1000), 1000)


def log_segments(spark, sf_dir):
    return changelog.select_segments(*derived.segments(spark, sf_dir), scn=40005).select("kind", "first_change", "member")


def _exploded(df: DataFrame) -> DataFrame:
    return df.select("scn", F.posexplode("columns").alias("idx", "c")).select(
        "scn", "idx", F.col("c.name").alias("name"), F.col("c.value").alias("value"),
        F.col("c.column_type").alias("column_type"), F.col("c.last_value").alias("last_value"),
    )


def _decoded(spark, sf_dir, operation: str) -> DataFrame:
    log = _log(spark, sf_dir).where(F.col("operation") == operation)
    return _exploded(redo_events.redo_columns(log))


def redo_insert(spark, sf_dir):
    return _decoded(spark, sf_dir, "INSERT").select("scn", "idx", "name", "value")


def redo_update(spark, sf_dir):
    return _decoded(spark, sf_dir, "UPDATE").select("scn", "idx", "name", "value", "last_value")


def redo_delete(spark, sf_dir):
    return _decoded(spark, sf_dir, "DELETE").select("scn", "idx", "name", "value")


def redo_types(spark, sf_dir):
    log = changelog.scan_all(_log(spark, sf_dir), REDO_TABLES)
    return _exploded(redo_events.redo_columns(log)).select("scn", "idx", "name", "column_type")


def redo_long_text(spark, sf_dir):
    """Whole documents as literals of insert statements."""
    docs = table(spark, sf_dir, "documents")
    literal = F.concat(F.lit("'"), F.replace("text", F.lit("'"), F.lit("''")), F.lit("'"))
    sql = F.concat(
        F.lit('insert into "SALES"."DOCS"("DOC_ID","TEXT","LANG") values (\''), F.col("doc_id"), F.lit("',"),
        literal, F.lit(",'"), F.col("lang"), F.lit("');"),
    )
    decoded = redo_events.redo_columns(docs.select("doc_id", sql.alias("sql_redo")))
    return decoded.select(
        "doc_id", F.get("columns", F.lit(1))["value"].alias("text"), F.get("columns", F.lit(2))["value"].alias("lang"),
        F.size("columns").alias("n_columns"),
    )


def _change_events(spark, sf_dir) -> DataFrame:
    return redo_events.change_events(changelog.scan_all(_log(spark, sf_dir), REDO_TABLES))


def change_events(spark, sf_dir):
    ev = _change_events(spark, sf_dir)
    return ev.select("type", "timestamp", "table_name", "database", "row_id", "seq", F.posexplode_outer("columns").alias("idx", "c")).select(
        "type", "timestamp", "table_name", "database", "row_id", "seq", "idx", F.col("c.name").alias("name"),
        F.col("c.value").alias("value"), F.col("c.column_type").alias("column_type"), F.col("c.last_value").alias("last_value"),
    )


def event_json(spark, sf_dir):
    ev = redo_events.change_events(changelog.scan_all(_log(spark, sf_dir), ORDERS_ONLY), with_xid=True)
    return redo_events.event_json(ev.where("type = 'update'")).select(F.col("seq").cast("long").alias("scn"), "value")


# ---- applying changes -------------------------------------------------------------

def change_to_doc(spark, sf_dir):
    return snapshot.to_documents(_change_events(spark, sf_dir))


def bulk_actions(spark, sf_dir):
    return bulk.bulk_actions(_change_events(spark, sf_dir))


def bulk_bodies(spark, sf_dir):
    """Request bodies of 1000 events over the whole log."""
    return bulk.bulk_bodies(_change_events(spark, sf_dir))


def _insert_documents(spark, sf_dir) -> DataFrame:
    log = changelog.scan_all(_log(spark, sf_dir), ORDERS_ONLY).where("operation = 'INSERT'")
    return snapshot.to_documents(redo_events.change_events(log))


def _committed_documents(spark, sf_dir, last_only: bool = False) -> DataFrame:
    changed = _committed(spark, sf_dir).where("operation <> 'INSERT'")
    if last_only:  # superseded changes are not decoded
        changed = snapshot.latest_by_key(changed, ["seg_owner", "seg_name", "row_id"], "scn")
    return snapshot.to_documents(redo_events.change_events(changed, with_xid=True))


def snapshot_merge(spark, sf_dir):
    merged = snapshot.merge_snapshot(_insert_documents(spark, sf_dir), _committed_documents(spark, sf_dir, last_only=True))
    return merged.select("database", "table_name", "row_id", "seq", "doc")


def snapshot_stream_apply(spark, sf_dir):
    """Inserts, then committed changes, arrive as two pieces of a stream."""
    root = scratch_dir(spark, "snapshot_stream")
    schema = None
    for piece in (_insert_documents(spark, sf_dir), _committed_documents(spark, sf_dir)):
        piece.write.mode("append").parquet(f"{root}/changes")
        schema = piece.schema
        stream = spark.readStream.schema(schema).parquet(f"{root}/changes")
        snapshot_stream.start_apply(stream, f"{root}/table", f"{root}/checkpoint").awaitTermination()
        snapshot_stream.compact(spark, f"{root}/table", schema)
    return snapshot_stream.read_snapshot(spark, f"{root}/table", schema).select("database", "table_name", "row_id", "seq", "doc")


def snapshot_store_stream(spark, sf_dir):
    """As ``snapshot_stream_apply``, in a bucketed store: ten batches in two runs, folded and cleaned after each."""
    root = scratch_dir(spark, "snapshot_store")
    store = None
    for piece in (_insert_documents(spark, sf_dir), _committed_documents(spark, sf_dir)):
        piece.repartition(5, "row_id").write.option("maxRecordsPerFile", 0).mode("append").parquet(f"{root}/changes")
        store = keyed_store.Store(f"{root}/table", piece.schema, buckets=8)
        stream = spark.readStream.schema(piece.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/changes")
        keyed_store.start_store(store, stream, f"{root}/checkpoint").awaitTermination()
        keyed_store.fold(spark, store)
        keyed_store.clean(spark, store)
    return keyed_store.read_store(spark, store).select("database", "table_name", "row_id", "seq", "doc")


# ---- change table -----------------------------------------------------------------

def mssql_poll(spark, sf_dir):
    return changetable.poll(derived.change_table(spark, sf_dir), max_rows=1000).select(
        F.hex("start_lsn").alias("start_lsn"), F.hex("seqval").alias("seqval"), "operation", "Id", "Sum",
    )


def mssql_poll_handover(spark, sf_dir):
    """One poll that begins in the older capture instance and ends, 1000 rows after the handover, in the newer one."""
    captures, tables, after, before = derived.handover(spark, sf_dir)
    rows = changetable.poll_captures(captures, tables, "dbo", "ORDERS", derived.lsn(after), max_rows=before + 1000)
    return rows.select(
        "capture_instance", F.hex("start_lsn").alias("start_lsn"), F.hex("seqval").alias("seqval"), "operation", "Id", "Sum",
        F.hex("Mark").alias("Mark"), F.date_format("Create_Date", "yyyy-MM-dd").alias("Create_Date"),
    )


def _row_changes(spark, sf_dir) -> DataFrame:
    return row_changes.row_changes(
        derived.change_table(spark, sf_dir), derived.CHANGE_COLUMNS, ["Id"], "dbo", "ORDERS"
    )


def mssql_changes(spark, sf_dir):
    return _cells(_row_changes(spark, sf_dir))


def mssql_changes_stream(spark, sf_dir):
    """The change table in six batches of a stream that stops after each; many after images come a batch later than their before images."""
    root = scratch_dir(spark, "mssql_changes_stream")
    part = F.pmod(F.xxhash64("seqval"), F.lit(10))
    late = (F.col("operation") == 4) & (part % 2 == 1)
    images = derived.change_table(spark, sf_dir).withColumn("_in", F.floor(part / 2) + late.cast("int"))
    schema = images.drop("_in").schema
    for batch in range(6):
        images.where(F.col("_in") == batch).drop("_in").write.mode("append").parquet(f"{root}/images")
        stream = spark.readStream.schema(schema).parquet(f"{root}/images")
        pairing.start_row_changes(
            stream, f"{root}/out", f"{root}/state", f"{root}/checkpoint", derived.CHANGE_COLUMNS, ["Id"], "dbo", "ORDERS", buckets=4, fold_every=3,
        ).awaitTermination()
    return _cells(spark.read.parquet(f"{root}/out"))


def _cells(changes: DataFrame) -> DataFrame:
    before = F.coalesce("before", F.array().cast("array<string>"))
    cells = F.arrays_zip("columns", "types", "data", before.alias("before"))
    return changes.select("seq", "operation", "trxDate", F.posexplode(cells).alias("idx", "c")).select(
        "seq", "operation", "trxDate", "idx", F.col("c.columns").alias("name"), F.col("c.types").alias("type"),
        F.col("c.data").alias("value"), F.col("c.before").alias("before_value"),
    )


def mssql_key_values(spark, sf_dir):
    return _row_changes(spark, sf_dir).select(
        "seq", "operation", row_changes.column_value("ID").alias("key_value"),
        row_changes.column_value("create_date").alias("created"), row_changes.column_value("absent").alias("absent"),
    )


def topic_payload(spark, sf_dir):
    framed = row_changes.row_change_json(_row_changes(spark, sf_dir))
    name = F.concat_ws(".", F.lit("mssql-cdc"), F.lower("table"), F.col("operation"))
    return topic_sink.topic_payload(framed, name).select("topic", "value")


def capture_choice(spark, sf_dir):
    chosen = changetable.choose_capture(derived.captures(spark, sf_dir), derived.lsn(5000))
    return chosen.select("table_name", "capture_instance", F.array_join("key_columns", "|").alias("key_columns"), "error")


# ---- field crypto -------------------------------------------------------------------

def _customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", money("c_acctbal").alias("c_acctbal"))


def _step(field: str, operation: str, secret: str = SECRET) -> dict:
    return {"field": field, "secret": secret, "operation": operation}


def crypto_encrypt(spark, sf_dir):
    """What can be said of ciphertexts without the cipher: their length, which are equal, and what they decrypt to."""
    rows = _customers(spark, sf_dir).withColumn("plain", F.concat("c_mktsegment", F.col("c_acctbal").cast("string")))
    good, _ = quarantine.split(field_crypto.apply_plan(rows.withColumn("sealed", F.col("plain")), [_step("sealed", "encrypt")], IV))
    opened = crypto.decrypt(F.col("sealed"), SECRET, crypto.parse_iv(IV))
    alike = good.groupBy("sealed").agg(F.count(F.lit(1)).alias("alike"))
    return good.join(alike, "sealed").select(
        "c_custkey", F.octet_length(F.unbase64("sealed")).alias("sealed_bytes"), "alike", opened.alias("opened"),
        (F.col("sealed") == F.col("plain")).alias("readable"))


def crypto_json(spark, sf_dir):
    """Customers as JSON messages: read, sealed, opened and written as JSON again."""
    rows = _customers(spark, sf_dir).withColumn("c_acctbal", F.col("c_acctbal").cast("string"))
    fields = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
    messages = json_messages.write_json(rows, fields, "message")
    read = json_messages.read_json(messages, "message", "c_custkey long, c_name string, c_mktsegment string, c_acctbal string", required=["c_custkey"])
    good, _ = quarantine.split(read)
    plan = [_step(f, op) for op in ("encrypt", "decrypt") for f in ("c_name", "c_acctbal")]
    opened, _ = quarantine.split(field_crypto.apply_plan(good, plan, IV))
    return json_messages.write_json(opened, fields, "value").select("value")


def crypto_roundtrip(spark, sf_dir):
    plan = [_step(f, op) for op in ("encrypt", "decrypt") for f in ("c_name", "c_acctbal", "c_mktsegment")]
    good, _ = quarantine.split(field_crypto.apply_plan(_customers(spark, sf_dir), plan, IV))
    return good


def crypto_hmac(spark, sf_dir):
    return _customers(spark, sf_dir).select("c_custkey", crypto.keyed_hash(F.col("c_name"), HASH_SECRET).alias("name_hash"))


def crypto_plan(spark, sf_dir):
    plan = [
        _step("c_name", "encrypt"), _step("c_name", "decrypt"), _step("c_name", "hash", HASH_SECRET),
        _step("c_acctbal", "hash", HASH_SECRET), _step("c_mktsegment", "unknown"),
    ]
    good, _ = quarantine.split(field_crypto.apply_plan(_customers(spark, sf_dir), plan, IV))
    return good


def quarantine_split(spark, sf_dir):
    """Names of one market segment are encrypted, the others do not decrypt."""
    c = _customers(spark, sf_dir)
    sealed = crypto.encrypt(F.col("c_name"), SECRET, crypto.parse_iv(IV))
    mixed = c.withColumn("c_name", F.when(F.col("c_mktsegment") == "BUILDING", sealed).otherwise(F.col("c_name")))
    good, bad = quarantine.write_split(
        field_crypto.apply_plan(mixed, [_step("c_name", "decrypt")], IV), scratch_dir(spark, "quarantine_split"))
    return good.select("c_custkey", "c_name", F.lit("ok").alias("outcome")).unionByName(
        bad.select("c_custkey", "c_name", F.lit("rejected").alias("outcome")))


# ---- incremental tables --------------------------------------------------------------

def incremental_plan(spark, sf_dir):
    return incremental.plan_batch(table(spark, sf_dir, "orders"), "o_orderkey", 5000, offset=3000)


def incremental_batch(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return incremental.read_batch(orders, "o_orderkey", 5000, offset=3000)


def replicate(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("replicate_source")
    source = spark.sql("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM replicate_source WHERE o_totalprice > 100000")
    target = scratch_dir(spark, "replicate")
    replication.replicate(source, target)
    return spark.read.parquet(target)


# ---- messages -----------------------------------------------------------------------

def _with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.decode("payload", "UTF-8")).drop("payload")


def topic_read_from(spark, sf_dir):
    return _with_text(topics.read_from(derived.topic_log(spark, sf_dir), topic="user", position=5003, max_messages=100))


def topic_subscribe(spark, sf_dir):
    return _with_text(topics.subscribe(derived.topic_log(spark, sf_dir), topics="user, assistant"))


def topic_pattern(spark, sf_dir):
    return _with_text(topics.subscribe(derived.topic_log(spark, sf_dir), pattern="sys.*|u[a-z]+"))


def _framed(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    return frames.frame(docs)


def frame_records(spark, sf_dir):
    return _framed(spark, sf_dir)


def frame_stream_files(spark, sf_dir):
    """The texts of each language as one captured stream in one file, framed by ranges of 32 KiB."""
    root = scratch_dir(spark, "frame_stream_files")
    docs = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("none")).alias("lang"), "doc_id", "text")
    docs.repartition("lang").sortWithinPartitions("lang", "doc_id").select("lang", "text").write.partitionBy("lang").text(root)
    ranged = spark.newSession()
    ranged.conf.set("spark.sql.files.maxPartitionBytes", 32 * 1024)
    ranged.conf.set("spark.sql.files.maxPartitionNum", 256)  # a task takes many ranges; they stay as long as they are
    records = frames.read_framed(ranged, root)
    return records.select(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang"), "pos", "record")


def bundle_by_count(spark, sf_dir):
    return bundles.bundle_by_count(_framed(spark, sf_dir), ["doc_id"], "pos", "record", size=10, dense=True)


def bundle_topic_by_count(spark, sf_dir):
    log = _with_text(derived.topic_log(spark, sf_dir))
    return bundles.bundle_by_count(log, ["topic"], "msg_id", "text", size=10)


def bundle_by_bytes(spark, sf_dir):
    log = derived.topic_log(spark, sf_dir).withColumn("size", F.octet_length("payload"))
    out = bundles.bundle_greedy(log, ["topic"], "msg_id", "size", messages=20, nbytes=8000)
    return out.select("topic", "msg_id", "position", "bundle_start")


def split_messages(spark, sf_dir):
    return bundles.split_messages(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ". ")


def _routed(spark, sf_dir, mode: str, **options) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return topic_sink.route(orders, mode, 8, **options)


def route_round_robin(spark, sf_dir):
    return _routed(spark, sf_dir, "RoundRobin", pos="o_orderkey")


def route_single(spark, sf_dir):
    return _routed(spark, sf_dir, "Single")


def route_custom(spark, sf_dir):
    return _routed(spark, sf_dir, "Custom", key=F.col("o_custkey"))


# ---- trading messages ------------------------------------------------------------------

def fix_tags(spark, sf_dir):
    return fix.explode_tags(derived.fix_log(spark, sf_dir, "quote")).select("session", "pos", "tag", "val")


def fix_route(spark, sf_dir):
    logs = [derived.fix_log(spark, sf_dir, kind) for kind in ("execution", "trade", "quote")]
    everything = logs[0].unionByName(logs[1]).unionByName(logs[2])
    return fix.route(everything).groupBy("session", "msg_type", "kind", "error_code").agg(F.count("*").alias("messages"))


def fix_execution(spark, sf_dir):
    out = fix.executions(derived.fix_log(spark, sf_dir, "execution"), hours=3, drop_time=False)
    return out.withColumn("NoLegs", F.size("NoLegs"))


def fix_legs(spark, sf_dir):
    out = fix.executions(derived.fix_log(spark, sf_dir, "execution"), drop_time=False)
    return out.select("Id", F.posexplode("NoLegs").alias("leg_no", "leg")).select("Id", "leg_no", "leg.*")


def fix_trade(spark, sf_dir):
    out = fix.trades(derived.fix_log(spark, sf_dir, "trade"), hours=3, drop_time=False)
    keep = [c for c in out.columns if c != "NoSides"]
    sides = F.transform("NoSides", lambda s: F.struct(*[s[n].alias(f"Side_{n}") for n in ("Side", "Account", "OrderID", "AllocID")]))
    return out.select(*keep, F.inline(sides))


def fix_quote(spark, sf_dir):
    return fix.quotes(derived.fix_log(spark, sf_dir, "quote"), drop_time=False)


def fix_seq_gaps(spark, sf_dir):
    return fix.sequence_gaps(
        table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("session"), F.col("o_orderkey").alias("seq")),
        ["session"], "seq",
    )


def fix_seq_gaps_stream(spark, sf_dir):
    """As ``fix_seq_gaps``, on a stream read by position in seven batches or more and two runs."""
    spark.dataSource.register(positioned.PositionedLog)
    root = scratch_dir(spark, "fix_seq_gaps_stream")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("session"), F.col("o_orderkey").cast("long").alias("seq"))
    counts = rows.agg(F.count("*").alias("n"), F.max("seq").alias("top")).first()
    half, limit = (counts["top"] or 0) // 2, max(1, counts["n"] // 7)
    for part in (F.col("seq") <= half, F.col("seq") > half):
        rows.where(part).repartitionByRange(4, "seq").write.mode("append").parquet(f"{root}/log")
        log = spark.readStream.format("positioned_log").schema(rows.schema).options(
            path=f"{root}/log", position="seq", max_rows=str(limit), progress=f"{root}/progress").load()
        query = sequences.start_sequence_audit(
            log, ["session"], "seq", f"{root}/out", f"{root}/state", f"{root}/checkpoint", buckets=4, fold_every=3, trigger={"processingTime": "0 seconds"})
        query.processAllAvailable()
        query.stop()
    return spark.read.parquet(f"{root}/out").drop("batch")


QUERIES = {
    f.__name__: f for f in (
        hop_sum, hop_count, hop_weighted_count, hop_avg, tumbling_sum, sampled_window_sum, hop_sum_stream, hop_sum_json,
        hop_minmax, hop_distinct, hop_minmax_stream, hop_arrival_stream,
        cdc_all, cdc_committed, cdc_committed_stream, cdc_stream_resume, cdc_committed_positioned, cdc_resume_offset, log_segments,
        redo_insert, redo_update, redo_delete, redo_types, redo_long_text, change_events, event_json,
        change_to_doc, bulk_actions, bulk_bodies, snapshot_merge, snapshot_stream_apply, snapshot_store_stream,
        mssql_poll, mssql_poll_handover, mssql_changes, mssql_changes_stream, mssql_key_values, topic_payload, capture_choice,
        crypto_encrypt, crypto_roundtrip, crypto_json, crypto_hmac, crypto_plan, quarantine_split,
        incremental_plan, incremental_batch, replicate,
        topic_read_from, topic_subscribe, topic_pattern, frame_records, frame_stream_files,
        bundle_by_count, bundle_topic_by_count, bundle_by_bytes, split_messages,
        route_round_robin, route_single, route_custom,
        fix_tags, fix_route, fix_execution, fix_legs, fix_trade, fix_quote, fix_seq_gaps, fix_seq_gaps_stream,
    )
}
