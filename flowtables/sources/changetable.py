"""Change tables in the SQL Server layout.

Expected columns: start_lsn binary, seqval binary, operation int (1 delete,
2 insert, 3 before image, 4 after image), trx_time timestamp, data columns.
Log sequence numbers are compared as bytes; byte order is log order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from flowtables.functions.text import bracket_list

ORDER = ("start_lsn", "seqval", "operation")


def poll(
    df: DataFrame, after_lsn: bytes | None = None, start_date: str | None = None, max_rows: int = 1000,
) -> DataFrame:
    """Next bounded piece of the change table, in log order.

    Starts after ``after_lsn``, else after ``start_date``, else at the beginning.
    The piece ends with the transaction that holds row number ``max_rows``: a
    transaction is never cut.
    """
    if after_lsn is not None:
        df = df.where(F.col("start_lsn") > F.lit(bytes(after_lsn)))
    elif start_date is not None:
        df = df.where(F.col("trx_time") > F.lit(start_date).cast("timestamp"))
    last = df.select(*ORDER).orderBy(*ORDER).limit(max_rows).agg(F.max("start_lsn"))
    return df.where(F.col("start_lsn") <= last.scalar())


def next_lsn(df: DataFrame) -> DataFrame:
    """One row ``offset_lsn``: the last log sequence number read."""
    return df.agg(F.max("start_lsn").alias("offset_lsn"))


def choose_capture(captures: DataFrame, offset_lsn: bytes | None = None) -> DataFrame:
    """Pick the capture instance to read, per source table.

    Columns in: schema_name, table_name, capture_instance, index_column_list,
    create_date, start_lsn. One instance: that one. Two: the newer one without an
    offset or when the offset has reached its start, else the older one. Any
    other number: ``capture_instance`` is null and ``error`` says why.
    """
    fields = ["capture_instance", "index_column_list", "create_date", "start_lsn"]
    row = F.struct(*fields)
    picked = captures.groupBy("schema_name", "table_name").agg(
        F.count("*").alias("n"),
        F.min_by(row, "create_date").alias("old"),
        F.max_by(row, "create_date").alias("new"),
    )
    offset = F.lit(None).cast("binary") if offset_lsn is None else F.lit(bytes(offset_lsn))
    use_new = offset.isNull() | F.coalesce(offset >= F.col("new.start_lsn"), F.lit(False))
    chosen = F.when(F.col("n") == 1, F.col("new")).when(
        F.col("n") == 2, F.when(use_new, F.col("new")).otherwise(F.col("old"))
    )
    return picked.select("schema_name", "table_name", "n", chosen.alias("c")).select(
        "schema_name", "table_name",
        F.col("c.capture_instance").alias("capture_instance"),
        bracket_list(F.col("c.index_column_list")).alias("key_columns"),
        F.col("c.create_date").alias("create_date"),
        F.when(F.col("c").isNull(), F.lit("there must be one or two captures")).alias("error"),
    )


def poll_captures(
    captures: DataFrame, tables: Mapping[str, DataFrame], schema: str, table: str, after_lsn: bytes | None = None,
    start_date: str | None = None, max_rows: int = 1000,
) -> DataFrame | None:
    """As :func:`poll`, over the capture instances of one source table; adds ``capture_instance``.

    ``captures`` as in :func:`choose_capture`; ``tables`` maps instance names to change tables.
    With two instances the older one counts below the start LSN of the newer one and the newer one from there on, so
    a poll may begin in one and end in the other, and a change that both
    hold comes once. Without an offset only the newer one is read, after ``start_date``, else after its creation.
    Columns are matched by name; one that an instance lacks is null in its rows.
    None if there are no instances or more than two: then a saved offset means nothing any more.
    """
    of_table = captures.where((F.col("schema_name") == schema) & (F.col("table_name") == table))
    found = of_table.select("capture_instance", "create_date", "start_lsn").orderBy("create_date").limit(3).collect()
    if len(found) not in (1, 2):
        return None
    named = [tables[r["capture_instance"]].withColumn("capture_instance", F.lit(r["capture_instance"])) for r in found]
    if after_lsn is None and start_date is None:
        return poll(named[-1].where(F.col("trx_time") > F.lit(found[-1]["create_date"])), max_rows=max_rows)
    if after_lsn is None or len(found) == 1:
        return poll(named[-1], after_lsn, start_date, max_rows)
    border = F.lit(bytes(found[-1]["start_lsn"]))
    rows = named[0].where(F.col("start_lsn") < border).unionByName(named[1].where(F.col("start_lsn") >= border), allowMissingColumns=True)
    return poll(rows, after_lsn, max_rows=max_rows)
