"""Pairing of before and after images into row changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowtables.functions.text import CHANGE_DATE_FORMAT, hex_text, timestamp_text, value_text

# --- fixed values: operation codes of a change table --------------------------
OPERATION_NAMES = {1: "delete", 2: "insert", 4: "update"}
BEFORE_IMAGE = 3
# ------------------------------------------------------------------------------


def operation_name(code: Column) -> Column:
    return (
        F.when(code == 1, OPERATION_NAMES[1]).when(code == 2, OPERATION_NAMES[2]).otherwise(OPERATION_NAMES[4])
    )


def row_changes(
    df: DataFrame,
    data_columns: Sequence[tuple[str, str]],
    key_columns: Sequence[str] | Column,
    schema: str,
    table: str,
    date_format: str | None = CHANGE_DATE_FORMAT,
) -> DataFrame:
    """Change-table rows as row changes with text values.

    ``data_columns`` lists (name, SQL type). Both images of one update carry the
    same start LSN and sequence value, so the window groups have two rows and a
    transaction of any size spreads over all tasks. An update whose before image
    is missing has a null ``before``.
    """
    texts = F.array(*[value_text(F.col(name), kind, date_format) for name, kind in data_columns])
    pair = Window.partitionBy("start_lsn", "seqval").orderBy("operation")
    images = df.select("start_lsn", "seqval", "operation", "trx_time", texts.alias("data"))
    images = images.withColumn(
        "before", F.lag(F.when(F.col("operation") == BEFORE_IMAGE, F.col("data"))).over(pair)
    )
    keys = key_columns if isinstance(key_columns, Column) else F.array(*[F.lit(k) for k in key_columns])
    return images.where(F.col("operation").isin(*OPERATION_NAMES)).select(
        F.array(*[F.lit(name) for name, _ in data_columns]).alias("columns"),
        F.array(*[F.lit(kind) for _, kind in data_columns]).alias("types"),
        keys.alias("keyColumns"),
        "data",
        F.when(F.col("operation") == 4, F.col("before")).alias("before"),
        operation_name(F.col("operation")).alias("operation"),
        timestamp_text(F.col("trx_time")).alias("trxDate"),
        F.lit(schema).alias("schema"),
        F.lit(table).alias("table"),
        hex_text(F.col("start_lsn")).alias("seq"),
    )


def column_value(name: str | Column) -> Column:
    """Value of a named column of a row change, ignoring case; null when absent."""
    wanted = F.lower(F.lit(name) if isinstance(name, str) else name)
    i = F.array_position(F.transform("columns", F.lower), wanted)
    return F.get(F.col("data"), (i - 1).cast("int"))


def row_change_json(df: DataFrame) -> DataFrame:
    """Row changes as JSON text in column ``value``; nulls are written."""
    fields = ["columns", "types", "keyColumns", "data", "before", "operation", "trxDate", "schema", "table", "seq"]
    return df.withColumn("value", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))
