"""Decoding of redo statements (insert / update / delete text) into tokens and typed columns.

Statements are decoded batch by batch in the task that scanned them, as Arrow
columns: a handful of regular expressions per statement, and each token is cleaned
and typed once. All quantifiers over statement text are possessive: literals of any
length are matched without backtracking. Patterns are for ASCII names; ``END`` also
matches before a last line separator.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# --- fixed values: the redo dialect -----------------------------------------
LITERAL = r"'[^']*+'(?:'[^']*+')*+(?!')"
NAME = r'(?:"[^"]+"|[A-Za-z_][\w$#]*+)'
# arguments of a call, with calls inside one another up to four deep
ARGUMENTS = rf"(?:[^()']++|{LITERAL})*+"
for _ in range(3):
    ARGUMENTS = rf"(?:[^()']++|{LITERAL}|\({ARGUMENTS}\))*+"
TYPED_LITERAL = rf"(?i:DATE|TIMESTAMP|INTERVAL)\s++{LITERAL}"
VALUE = rf"(?:{TYPED_LITERAL}|[A-Za-z_]\w*+\s*+\({ARGUMENTS}\)|{LITERAL}|[^\s,;()']++)"
FILL = rf"""(?i:[^'"\s]++|{LITERAL}|"[^"]*+"|\s(?!where\s))*+"""
END = r"(?=[\u0085\u2028\u2029]?\Z)"
LINE_END = r"(?=(?:\r\n|[\n\r\u0085\u2028\u2029])?\Z)"
INSERT = rf"(?is)\s*insert\s+into\s+\S+?\s*\(([^)]*)\)\s*values\s*\((.*)\)\s*;?\s*{END}"
SET_PART = rf"(?is)\s*update\s+\S+\s+set\s+({FILL})\swhere\s"
WHERE_PART = rf"(?is)\s*(?:update|delete){FILL}\swhere\s+"
# both parts of an update at once; no match where they might be found at different places
UPDATE = rf"""(?is)\s*update\s+(?!where\s)(?:"[^"\s]*+"|[^\s"'])++\s+set\s++(?!where\s)({FILL})\swhere\s+"""
PAIR = rf"({NAME})\s*(?:=\s*({VALUE})|(?i:IS\s+NULL))"
# a clause is decoded only if such pieces cover it from end to end
_PIECE = rf"{NAME}\s*+(?:=\s*+{VALUE}|(?i:IS\s+NULL))\s*+"
SET_WHOLE = rf"\s*+{_PIECE}(?:,\s*+{_PIECE})*+{END}"
WHERE_WHOLE = rf"\s*+{_PIECE}(?:(?i:and)\s++{_PIECE})*+{END}"
NAMES_WHOLE = rf"\s*+{NAME}\s*+(?:,\s*+{NAME}\s*+)*+{END}"
VALUES_WHOLE = rf"\s*+{VALUE}\s*+(?:,\s*+{VALUE}\s*+)*+{END}"
DECIMAL_TEXT = rf"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?{LINE_END}"
DATE_CALLS = ("TO_DATE('", "TO_TIMESTAMP('")
SPACES = " \t\n\x0b\f\r"
LINE_BREAKS = "\n\r\u0085\u2028\u2029"
# ----------------------------------------------------------------------------

_KIND, _INSERT, _SET, _WHERE, _UPDATE, _PAIR, _NAME, _VALUE, _SET_WHOLE, _WHERE_WHOLE, _NAMES_WHOLE, _VALUES_WHOLE, _DECIMAL, _WRAPPED = (
    re.compile(p, re.ASCII) for p in (
        r"\s*([A-Za-z]+)", INSERT, SET_PART, WHERE_PART, UPDATE, PAIR, NAME, VALUE, SET_WHOLE, WHERE_WHOLE, NAMES_WHOLE, VALUES_WHOLE,
        DECIMAL_TEXT, rf'(?s)"(.*)"{LINE_END}'))
TEXTS = pa.list_(pa.string())
TOKENS = "struct<names:array<string>,tokens:array<string>,before_tokens:array<string>>"
COLUMNS = "array<struct<name:string,value:string,column_type:string,last_value:string>>"


def redo_kind(sql: Column) -> Column:
    """``insert``, ``update`` or ``delete``; null for any other text."""
    word = F.lower(F.regexp_extract(sql, r"^\s*([A-Za-z]+)", 1))
    return F.when(word.isin("insert", "update", "delete"), word)


def texts_of(values: pa.Array) -> list[str | None]:
    """The texts of a batch; bytes that are no UTF-8 are replaced."""
    try:
        return values.to_numpy(zero_copy_only=False).tolist()
    except UnicodeDecodeError:
        return [v if v is None else v.decode("utf-8", "replace") for v in values.cast(pa.binary()).to_pylist()]


def _name(token: str) -> str:
    quoted = token.startswith('"') and not any(c in token for c in LINE_BREAKS)
    return token[1:-1] if quoted else token


class Known(dict):
    """What ``make`` gives for a key, kept for the rows of a batch: statements name the same columns, and an update most values twice."""

    def __init__(self, make: Callable) -> None:
        self.make = make

    def __missing__(self, key):
        self[key] = made = self.make(key)
        return made


def known_names() -> tuple[Known, Known]:
    """Names by token, and by the clause of an insert, where they are none unless they cover it."""
    return Known(_name), Known(lambda clause: [_name(n) for n in _NAME.findall(clause)] if _NAMES_WHOLE.match(clause) else [])


def _pairs(clause: str, whole: re.Pattern, name: Known) -> list[tuple[str, str]]:
    """``NAME = VALUE`` pairs of a clause, a value of '' for ``IS NULL``; none unless they cover it."""
    return [(name[n], v) for n, v in _PAIR.findall(clause)] if whole.match(clause) else []


def _where_text(rest: str) -> str:
    """A WHERE clause without the end of its statement."""
    body = (rest[:-1] if rest.endswith(("\u0085", "\u2028", "\u2029")) else rest).rstrip(SPACES)
    return body[:-1] if body.endswith(";") else body


def tokens_of(sql: str | None, known: tuple[Known, Known]) -> tuple[list[str], list[str], list[str | None] | None]:
    """(names, tokens, tokens before) of a statement; the last is None unless an update.

    An update merges its WHERE image with its SET image: WHERE order first, SET values win, new SET columns follow.
    Text that does not decode from end to end has no names.
    """
    word = _KIND.match(sql) if sql is not None else None
    kind = word[1].lower() if word else ""
    name, named = known
    if kind == "insert":
        found = _INSERT.match(sql)
        names = named[found[1]] if found else []
        if names and _VALUES_WHOLE.match(found[2]):
            values = _VALUE.findall(found[2])
            if len(names) == len(values):
                return names, values, None
    elif kind == "update":
        both = _UPDATE.match(sql)
        if both:
            new, rest = both[1], sql[both.end() :]
        else:
            part, where = _SET.match(sql), _WHERE.match(sql)
            new, rest = (part[1], sql[where.end() :]) if part and where else ("", "")
        after, pairs = _pairs(new, _SET_WHOLE, name), _pairs(_where_text(rest), _WHERE_WHOLE, name)
        if after and pairs:
            before = dict(pairs)
            merged = {**before, **dict(after)}
            return list(merged), list(merged.values()), [before.get(n) for n in merged]
    elif kind == "delete":
        where = _WHERE.match(sql)
        pairs = _pairs(_where_text(sql[where.end() :]), _WHERE_WHOLE, name) if where else []
        return [n for n, _ in pairs], [v for _, v in pairs], None
    return [], [], None


def typed_values(raw_quotes: bool, null_literal: bool, strict_types: bool) -> Callable[[str | None], tuple[str | None, str | None]]:
    """A function from a token to its value as text, date calls reduced to the date in them, and its type.

    The type is ``number``, ``date`` or ``varchar``. ``strict_types`` lets only unquoted tokens be numbers, so a quoted
    ``'007'`` stays text. A token of '' stands for ``IS NULL``; no token has no type.
    """
    null = "NULL" if null_literal else None

    def typed(token: str | None) -> tuple[str | None, str | None]:
        if token is None:
            return None, None
        if token.startswith("'"):
            inner = token[1:-1]
            if raw_quotes:
                wrapped = _WRAPPED.match(inner)
                value = wrapped[1] + inner[wrapped.end() :] if wrapped else inner
            else:
                value = inner.replace("''", "'")
            return value, "number" if not strict_types and _DECIMAL.match(value) else "varchar"
        if token == "" or token.upper() == "NULL":
            return null, "varchar"
        if token.startswith(DATE_CALLS):
            return token.split("'")[1], "date"
        return token, "number" if _DECIMAL.match(token) else "varchar"

    return typed


def decoded_tokens(sql: Column) -> Column:
    """``struct<names, tokens, before_tokens>`` of statements, see :func:`tokens_of`."""

    def work(statements: pa.Array) -> pa.Array:
        known = known_names()
        rows = [tokens_of(s, known) for s in texts_of(statements)]
        parts = [pa.array([r[i] for r in rows], TEXTS) for i in range(3)]
        return pa.StructArray.from_arrays(parts, ["names", "tokens", "before_tokens"])

    return F.arrow_udf(work, TOKENS)(sql)


def decoded_columns(sql: Column, raw_quotes: bool, null_literal: bool, strict_types: bool) -> Column:
    """``array<struct<name, value, column_type, last_value>>`` of statements."""

    def work(statements: pa.Array) -> pa.Array:
        typed, known = Known(typed_values(raw_quotes, null_literal, strict_types)), known_names()
        names, values, kinds, last, ends = [], [], [], [], [0]
        for sql in texts_of(statements):
            found, tokens, before = tokens_of(sql, known)
            names += found
            for token in tokens:
                value, kind = typed[token]
                values.append(value)
                kinds.append(kind)
            last += [typed[token][0] for token in before] if before is not None else [None] * len(found)
            ends.append(len(names))
        fields = ["name", "value", "column_type", "last_value"]
        flat = pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in (names, values, kinds, last)], fields)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

    return F.arrow_udf(work, COLUMNS)(sql)


# workers get these functions by value and need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
