"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f'CREATE VIEW "{name}" AS SELECT * FROM read_parquet(\'{path}\')')
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


FAMILY = {"tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "long", "long": "long",
          "hugeint": "hugeint", "varchar": "string", "string": "string", "double": "double", "boolean": "boolean"}


def compare(df, con, sql: str) -> list[str]:
    """Differences in column names, types and values; empty when all agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]).lower() for d in cursor.description}
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for field in df.schema.fields:
        ours = field.dataType.simpleString()
        ours, theirs = FAMILY.get(ours, ours), FAMILY.get(types[field.name], types[field.name])
        if ours != theirs and {ours, theirs} != {"int", "long"} and not (ours.startswith("decimal") and theirs.startswith("decimal")):
            problems.append(f"type of {field.name}: {ours} vs {theirs}")
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    right = _rows(names, cursor.fetchall())
    if left != right:
        problems.append(f"{sum(left.values())} vs {sum(right.values())} rows; only ours {list((left - right).items())[:2]}; only sql {list((right - left).items())[:2]}")
    return problems
