"""Text, date, hex and JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------
# characters removed from search-index names: white space _ + - < > " * / ? \
INDEX_NAME_STRIP = r'[\s_+\-<>"*/?\\]'
# text that stands in a JSON literal as it is
PLAIN_JSON_TEXT = r"\A[ !#-.0-\[\]-~]*+\z"
# text of window bounds
WINDOW_BOUND_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# text of date columns in SQL Server style row changes
CHANGE_DATE_FORMAT = "dd-MM-yyyy HH:mm:ss.SSS"
# SQL Server types rendered as 0x.. hex, and types rendered with a date pattern
BINARY_SQL_TYPES = ("binary", "varbinary", "image")
DATE_SQL_TYPES = ("datetime", "date", "time")
# ----------------------------------------------------------------------------


def index_name(col: Column) -> Column:
    """Search-index safe name: null becomes '', special characters go, lower case."""
    return F.lower(F.regexp_replace(F.coalesce(col, F.lit("")), INDEX_NAME_STRIP, ""))


def hex_text(col: Column) -> Column:
    """Bytes as ``0x`` plus lower-case hex."""
    return F.concat(F.lit("0x"), F.lower(F.hex(col)))


def bracket_list(col: Column) -> Column:
    """``[A], [B]`` as an array of names; null or empty text gives null."""
    names = F.transform(
        F.split(col, ","),
        lambda s: F.substring(F.trim(s), F.lit(2), F.length(F.trim(s)) - 2),
    )
    return F.when(F.length(col) > 0, names)


def timestamp_text(col: Column) -> Column:
    """``2021-03-25 17:42:18.0``: at least one digit of fraction, no padding."""
    return F.regexp_replace(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"(\.\d+?)0+$", "$1")


def value_text(col: Column, sql_type: str, date_format: str | None = CHANGE_DATE_FORMAT) -> Column:
    """Value of a change-table column as text, by its SQL type name.

    Null becomes the text ``null``. A date type without a pattern gives null.
    """
    kind = sql_type.lower()
    if kind in BINARY_SQL_TYPES:
        text = hex_text(col)
    elif kind in DATE_SQL_TYPES:
        text = F.date_format(col, date_format) if date_format else F.lit(None).cast("string")
    else:
        text = col.cast("string")
    return F.when(col.isNull(), F.lit("null")).otherwise(text)


def json_text(col: Column) -> Column:
    """A string column as a JSON string literal; null becomes ``null``."""
    quoted = F.to_json(F.array(col))
    return (
        F.when(col.isNull(), F.lit("null"))
        .when(col.rlike(PLAIN_JSON_TEXT), F.concat(F.lit('"'), col, F.lit('"')))
        .otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))
    )


def json_number(col: Column) -> Column:
    """Decimal text as a valid JSON number: no plus sign, no leading zeros."""
    text = F.regexp_replace(col, r"^\+", "")
    # the pattern has one group, so "$10." is group 1 followed by "0."
    text = F.regexp_replace(text, r"^(-?)\.", "$10.")
    text = F.regexp_replace(text, r"^(-?)0+(?=\d)", "$1")
    return F.regexp_replace(text, r"\.(?=$|[eE])", "")


def number_value(col: Column) -> Column:
    """Decimal text as ``decimal(38,18)``; null when it does not fit."""
    return col.try_cast("decimal(38,18)")
