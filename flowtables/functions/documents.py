"""Decoded columns as JSON text, batch by batch as Arrow columns."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from flowtables.functions import redo

# a decimal text that is a JSON number as it stands
PLAIN_NUMBER = rf"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?{redo.LINE_END}"
# text that stands in a JSON literal as it is
PLAIN_JSON_TEXT = r"[ !#-\[\]-~]*+\Z"

_NUMBER, _DECIMAL, _PLAIN = (re.compile(p, re.ASCII) for p in (PLAIN_NUMBER, redo.DECIMAL_TEXT, PLAIN_JSON_TEXT))
_POINT_AT_END = re.compile(r"\.(?=(?:\r\n|[\n\r\u0085\u2028\u2029])?\Z|[eE])")


def json_string(text: str | None) -> str:
    """As :func:`flowtables.functions.text.json_text`, of one text."""
    if text is None:
        return "null"
    if _PLAIN.match(text):
        return f'"{text}"'
    # codes of control characters are in capitals, as Spark writes them
    return re.sub(r"(?<!\\)((?:\\\\)*)\\u00(..)", lambda m: f"{m[1]}\\u00{m[2].upper()}", json.dumps(text, ensure_ascii=False))


def json_decimal(text: str) -> str:
    """As :func:`flowtables.functions.text.json_number`, of one text."""
    text = re.sub(r"\A(-?)\.", r"\g<1>0.", text.removeprefix("+"))
    return _POINT_AT_END.sub("", re.sub(r"\A(-?)0+(?=[0-9])", r"\1", text))


def json_value(value: str | None, kind: str | None) -> str:
    if kind == "number" and value is not None:
        if _NUMBER.match(value):
            return value
        if _DECIMAL.match(value):
            return json_decimal(value)
    return json_string(value)


def _entries(columns: pa.Array, *names: str) -> tuple[list[list], list[int], list[bool]]:
    """Fields of all entries of a batch, where each row's entries begin (and the last end), and which rows are null."""
    flat = columns.flatten()
    sizes = columns.value_lengths().fill_null(0).to_pylist()
    begins = [0]
    for n in sizes:
        begins.append(begins[-1] + n)
    fields = dict(zip((flat.type.field(i).name for i in range(flat.type.num_fields)), flat.flatten(), strict=True))
    return [redo.texts_of(fields[n]) for n in names], begins, columns.is_null().to_pylist()


def _texts(rows: Callable[[pa.Array], list[str | None]]) -> Callable[[Column], Column]:
    def work(columns: pa.Array) -> pa.Array:
        return pa.array(rows(columns), pa.string())

    return F.arrow_udf(work, "string")


def document(columns: Column) -> Column:
    """Columns array as one flat JSON object; the last of equal names wins."""

    def rows(batch: pa.Array) -> list[str | None]:
        (names, values, kinds), begins, nulls = _entries(batch, "name", "value", "column_type")
        known = {n: json_string(n) + ":" for n in set(names)}
        out = []
        for low, high, null in zip(begins, begins[1:], nulls):
            members = {names[i]: i for i in range(low, high)}
            out.append(None if null else "{" + ",".join([known[n] + json_value(values[i], kinds[i]) for n, i in members.items()]) + "}")
        return out

    return _texts(rows)(columns)


def entries(columns: Column) -> Column:
    """The entries of a columns array as JSON objects, joined by commas; ``last_value`` appears only where there is one."""

    def rows(batch: pa.Array) -> list[str | None]:
        (names, values, kinds, last), begins, nulls = _entries(batch, "name", "value", "column_type", "last_value")
        known = {t: json_string(t) for t in {*names, *kinds}}
        out = []
        for low, high, null in zip(begins, begins[1:], nulls):
            parts = []
            for i in range(low, high):
                before = "" if last[i] is None else f',"last_value":{json_value(last[i], "number")}'
                parts.append(f'{{"name":{known[names[i]]},"value":{json_value(values[i], kinds[i])},"column_type":{known[kinds[i]]}{before}}}')
            out.append(None if null else ",".join(parts))
        return out

    return _texts(rows)(columns)


# workers get these functions by value and need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
