"""Redo rows to decoded statements and typed before/after change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions import documents, redo
from flowtables.functions.once import with_columns_once
from flowtables.functions.text import json_number, json_text, timestamp_text

# a decimal text, and one that is a JSON number as it stands
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
PLAIN_NUMBER = r"^-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?$"


def decode_redo(df: DataFrame, sql_col: str = "sql_redo") -> DataFrame:
    """Add the raw tokens of each statement.

    New columns: ``redo_kind``, ``names``, ``tokens`` (current image) and
    ``before_tokens`` (null unless update). An update merges its WHERE image with
    its SET image: WHERE order first, SET values win, new SET columns follow.
    Text that does not decode from end to end gives empty arrays; the row is kept.
    """
    sql = F.col(sql_col)
    worked = with_columns_once(df, {"redo_kind": redo.redo_kind(sql), "_decoded": redo.decoded_tokens(sql)})
    return worked.select(*[c for c in worked.columns if c != "_decoded"], "_decoded.*")


def redo_columns(
    df: DataFrame,
    sql_col: str = "sql_redo",
    raw_quotes: bool = False,
    null_literal: bool = False,
    strict_types: bool = False,
) -> DataFrame:
    """Add ``columns array<struct<name, value, column_type, last_value>>``.

    ``last_value`` is null where the WHERE image does not name the column.
    """
    sql = F.col(sql_col)
    return df.withColumns({"redo_kind": redo.redo_kind(sql), "columns": redo.decoded_columns(sql, raw_quotes, null_literal, strict_types)})


def change_events(df: DataFrame, with_xid: bool = False, **options: bool) -> DataFrame:
    """Redo rows as change events.

    ``with_xid`` fills ``trx_code``; without it the column is null, as when
    changes are emitted before their transaction is decided.
    """
    return redo_columns(df, **options).select(
        F.lower("operation").alias("type"),
        timestamp_text(F.col("ts")).alias("timestamp"),
        F.col("seg_name").alias("table_name"),
        F.col("seg_owner").alias("database"),
        "row_id",
        (F.col("xid") if with_xid else F.lit(None)).cast("string").alias("trx_code"),
        F.col("scn").cast("string").alias("seq"),
        "columns",
    )


def _json_value(value: Column, kind: Column) -> Column:
    number = F.when(value.rlike(PLAIN_NUMBER), value).when(F.coalesce(value.rlike(DECIMAL_TEXT), F.lit(False)), json_number(value))
    return F.coalesce(F.when(kind == "number", number), json_text(value))


def document_json(columns: Column) -> Column:
    """Columns array as one flat JSON object; the last of equal names wins. An expression; :func:`documents.document` is the same by batches."""
    names = F.array_distinct(columns["name"])
    last = F.transform(names, lambda name: F.element_at(F.filter(columns, lambda x: x["name"] == name), -1))
    # names are seldom equal: then each entry is its own last
    entries = F.when(F.size(names) == F.size(columns), columns).otherwise(last)

    def member(c: Column) -> Column:
        return F.concat(json_text(c["name"]), F.lit(":"), _json_value(c["value"], c["column_type"]))

    return F.concat(F.lit("{"), F.array_join(F.transform(entries, member), ","), F.lit("}"))


def event_json(df: DataFrame) -> DataFrame:
    """Change events as JSON text in column ``value``; numbers are not quoted.

    ``last_value`` appears only where a before value exists.
    """
    heads = ["type", "timestamp", "table_name", "database", "row_id", "trx_code", "seq"]
    parts: list[Column] = []
    for name in heads:
        parts += [F.lit(f'"{name}":'), json_text(F.col(name)), F.lit(",")]
    return df.withColumn("value", F.concat(F.lit("{"), *parts, F.lit('"columns":['), documents.entries(F.col("columns")), F.lit("]}")))
