"""Flat JSON messages as typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from flowtables.functions.once import with_columns_once
from flowtables.operators import quarantine


def read_json(df: DataFrame, column: str, schema: str | T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """Replace the JSON text in ``column`` by the fields of ``schema``, and add ``_error``.

    Text that is no JSON object, or holds a value of another type, is an error, and
    so is a ``required`` field that is null or missing; see
    :func:`flowtables.operators.quarantine.split`. A rejected row keeps its text in
    ``column``, which is null in good rows. Fields that the schema lacks are
    passed over; fields with the name of another column replace it.
    """
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    broken = "_broken"
    parsed = F.from_json(F.col(column), T.StructType([*fields.fields, T.StructField(broken, T.StringType())]), {"columnNameOfCorruptRecord": broken})
    df = with_columns_once(df, {"_json": parsed})
    error = F.when(F.col("_json").isNull() | F.col(f"_json.{broken}").isNotNull(), F.lit("text is no JSON object of the schema"))
    for name in required:
        error = F.coalesce(error, F.when(F.col("_json")[name].isNull(), F.lit(f"field {name} is null or missing")))
    names = [f.name for f in fields.fields]
    kept = [c for c in df.columns if c not in (*names, column, "_json", quarantine.ERROR)]
    rows = quarantine.mark(df, error)
    text = F.when(F.col(quarantine.ERROR).isNotNull(), F.col(column)).alias(column)
    shown = [] if column in names else [text]
    return rows.select(*kept, *shown, *[F.col("_json")[n].alias(n) for n in names], quarantine.ERROR)


def write_json(df: DataFrame, fields: Sequence[str], column: str = "value") -> DataFrame:
    """Replace ``fields`` by one column of JSON text; null fields are written as null."""
    kept = [c for c in df.columns if c not in fields and c != column]
    return df.select(*kept, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(column))
