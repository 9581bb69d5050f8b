"""Trading messages (tag=value text) to typed report rows.

Input: ``raw`` text with SOH-separated ``tag=value`` pairs; other columns are
kept. A message type is described by a field table, so a new type is data.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions import fix_fields as X
from flowtables.functions.fix_fields import Field
from flowtables.functions.once import with_columns_once
from flowtables.functions.ordered import previous_value

MISSING = "FieldNotFound"
BAD_VALUE = "IncorrectDataFormat"
MANY = 1_000_000_000  # more than a group has entries
_AS_WRITTEN = {"allowUnquotedControlChars": "true"}


def tags(raw: Column) -> Column:
    """``array<struct<tag int, val string>>`` in message order."""
    pairs = F.filter(F.split(raw, X.SOH), lambda p: F.instr(p, "=") > 0)
    return F.transform(
        pairs,
        lambda p: F.struct(
            F.substring_index(p, "=", 1).try_cast("int").alias("tag"),
            F.substring(p, F.instr(p, "=") + 1, F.length(p)).alias("val"),
        ),
    )


def explode_tags(df: DataFrame) -> DataFrame:
    keep = [c for c in df.columns if c != "raw"]
    exploded = df.select(*keep, F.posexplode(tags(F.col("raw"))).alias("pos", "t"))
    return exploded.select(*keep, "pos", "t.tag", "t.val")


def _is_type(raw: Column, msg_type: str) -> Column:
    pair = f"{X.MSG_TYPE}={msg_type}{X.SOH}"
    return raw.contains(X.SOH + pair) | raw.startswith(pair)


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def _members(pairs: Column) -> Column:
    """Escaped pairs that start with SOH each, as members of a JSON object that follow a first text; what has no tag is named ``_``."""
    return F.replace(F.regexp_replace(pairs, rf"{X.SOH}(\d++)=", '","$1":"'), F.lit(X.SOH), F.lit('","_":"'))


def _texts(message: Column, wanted: Sequence[int]) -> Column:
    """Struct of the values of tags, by tag, in a message that starts with SOH; null when absent.

    One pass over the message, however many tags are wanted. A field repeats only inside groups; if one does
    elsewhere, its last value counts.
    """
    inside = F.concat(F.lit('{"_":"'), _members(_escaped(message)), F.lit('"}'))
    return F.from_json(inside, ",".join(f"`{t}` string" for t in wanted), _AS_WRITTEN)


def _text(message: Column, tag: int) -> Column:
    """Value of one tag in a message that starts with SOH; null when absent."""
    mark = f"{X.SOH}{tag}="
    found = F.substring_index(F.substring_index(message, mark, -1), X.SOH, 1)
    return F.when(message.contains(mark), found)


def _typed(value: Column, kind: str) -> Column:
    if kind == "string":
        return value
    if kind == "boolean":
        return F.when(value == "Y", True).when(value == "N", False)
    return value.try_cast(kind)


class Group(NamedTuple):
    """A repeating group: its column, count tag and fields, the first of which starts an entry.

    ``members`` are further tags that may stand in an entry; the first tag that is
    neither ends the group.
    """

    name: str
    count_tag: int
    fields: tuple[Field, ...]
    members: tuple[int, ...] = ()

    @property
    def pattern(self) -> str:
        inside = "|".join(str(t) for t in dict.fromkeys([*(f.tag for f in self.fields), *self.members]))
        return rf"{X.SOH}{self.count_tag}=[^{X.SOH}]*+((?:{X.SOH}(?:{inside})=[^{X.SOH}]*+)*+)"


def without_group(message: Column, group: Group) -> Column:
    """The message with the entries of a group cut out; its count stays."""
    return F.when(
        message.contains(f"{X.SOH}{group.count_tag}="),
        F.regexp_replace(message, group.pattern, rf"{X.SOH}{group.count_tag}=?"),
    ).otherwise(message)


def group_count(message: Column, group: Group) -> Column:
    """The number of entries that the count field states; null without one, -1 if it is no number."""
    return F.coalesce(_text(message, group.count_tag).try_cast("int"), F.when(message.contains(f"{X.SOH}{group.count_tag}="), -1))


def group_texts(message: Column, group: Group) -> Column:
    """Repeating group as an array of structs of texts, as many as there are."""
    fields = group.fields
    start = f"{X.SOH}{fields[0].tag}="
    region = F.regexp_extract(message, group.pattern, 1)
    opened = F.replace(_escaped(region), F.lit(start), F.lit(f'"}},{{"{fields[0].tag}":"'))
    inside = F.concat(F.lit('[{"_":"'), _members(opened), F.lit('"}]'))
    kind = ",".join(f"`{f.tag}`:string" for f in fields)
    named = ",".join(f"`{f.name}`:string" for f in fields)
    found = F.from_json(inside, f"array<struct<{kind}>>", _AS_WRITTEN).cast(f"array<struct<{named}>>")

    has_group = message.contains(f"{X.SOH}{group.count_tag}=")
    # what stands before the first entry is no entry
    return F.when(has_group, F.slice(found, 2, MANY)).otherwise(F.array().cast(f"array<struct<{named}>>"))


def _typed_group(texts: Column, fields: Sequence[Field]) -> Column:
    return F.transform(texts, lambda g: F.struct(*[_typed(g[f.name], f.type).alias(f.name) for f in fields]))


def _timestamp(text: Column) -> Column:
    """A UTC time with 0 to 9 fraction digits; those below a microsecond are dropped."""
    whole = F.try_to_timestamp(F.regexp_extract(text, X.UTC_TIMESTAMP_TEXT, 1), F.lit(X.UTC_TIMESTAMP_FORMAT))
    micros = F.rpad(F.substring(F.regexp_extract(text, X.UTC_TIMESTAMP_TEXT, 2), 1, 6), 6, "0").try_cast("int")
    return F.timestamp_micros(F.unix_micros(whole) + micros)


def local_time(text: Column, hours: int = 0, zone: str | None = None) -> Column:
    """UTC text of a message as local time.

    ``hours`` shifts by whole hours, ``zone`` follows the rules of a time zone.
    """
    stamp = _timestamp(text)
    return F.from_utc_timestamp(stamp, zone) if zone else stamp + F.make_dt_interval(hours=F.lit(hours))


class Report(NamedTuple):
    """A message type as data; see :func:`report`."""

    code: str
    kind: str
    fields: tuple[Field, ...]
    id_field: str
    has_transact_time: bool
    group: Group | None = None


EXECUTION = Report(X.EXECUTION_REPORT, "execution", X.EXECUTION_FIELDS, "OrderID", True, Group("NoLegs", X.NO_LEGS, X.LEG_FIELDS, X.NO_LEGS_MEMBERS))
TRADE = Report(X.TRADE_CAPTURE_REPORT, "trade", X.TRADE_FIELDS, "TradeID", True, Group("NoSides", X.NO_SIDES, X.SIDE_FIELDS, X.NO_SIDES_MEMBERS))
QUOTE = Report(X.QUOTE_STATUS_REPORT, "quote", X.QUOTE_FIELDS, "QuoteID", False)
REPORTS = (EXECUTION, TRADE, QUOTE)


def _wrong_type(text: Column, kind: str) -> Column:
    return text.isNotNull() & _typed(text, kind).isNull()


def _bad_group(report: Report) -> Column:
    """True when a group has not as many entries as it states, or a typed field holds text of another type."""
    if not report.group:
        return F.lit(False)
    entries = F.col(f"_g{report.group.count_tag}")
    miscounted = F.coalesce(F.col(f"_n{report.group.count_tag}") != F.size(entries), F.lit(False))
    typed = [f for f in report.group.fields if f.type != "string"]
    if not typed:
        return miscounted

    def bad(entry: Column) -> Column:
        wrong = F.lit(False)
        for f in typed:
            wrong = wrong | _wrong_type(entry[f.name], f.type)
        return wrong

    return miscounted | F.exists(entries, bad)


def _found(tag: int) -> Column:
    return F.col(f"_t{tag}")


def _classify(df: DataFrame, specs: Sequence[Report], all_fields: bool) -> DataFrame:
    """Add the texts of the fields (``_t<tag>``), the groups (``_g<tag>``), and
    ``msg_type``, ``kind``, ``error_code``, ``error_text``."""
    reports = {r.code: r for r in specs}
    fields = {f.tag for r in reports.values() for f in r.fields if all_fields or f.type != "string"}
    header = {X.MSG_TYPE, X.MSG_SEQ_NUM, X.SENDING_TIME, X.TRANSACT_TIME, X.TEXT}
    df = df.withColumn("_m", F.concat(F.lit(X.SOH), "raw"))
    groups = [r.group for r in reports.values() if r.group]
    if groups:
        # fields of the body are looked for outside the groups only
        body = F.col("_m")
        for r in reports.values():
            if r.group:
                body = F.when(_is_type(F.col("raw"), r.code), without_group(F.col("_m"), r.group)).otherwise(body)
        found = {f"_g{g.count_tag}": group_texts(F.col("_m"), g) for g in groups}
        df = with_columns_once(df, {**found, **{f"_n{g.count_tag}": group_count(F.col("_m"), g) for g in groups}, "_m": body})
    df = df.withColumn("_texts", _texts(F.col("_m"), sorted(fields | header)))
    texts = {f"_t{tag}": F.col("_texts")[str(tag)] for tag in sorted(fields | header)}
    df = df.withColumns({**texts, **{f"_bad{code}": _bad_group(r) for code, r in reports.items()}})

    kind = _found(X.MSG_TYPE)
    timed = [code for code, r in reports.items() if r.has_transact_time]
    needs_time = kind.isin(*timed) if timed else F.lit(False)
    time_text = _found(X.TRANSACT_TIME)
    missing = kind.isNull() | (needs_time & time_text.isNull()) | (
        kind.isin(*reports) & _found(X.MSG_SEQ_NUM).try_cast("int").isNull())
    bad = needs_time & _timestamp(time_text).isNull()
    name = F.lit("dropped")
    for code, r in reports.items():
        wrong = F.col(f"_bad{code}")
        for f in r.fields:
            if f.type != "string":
                wrong = wrong | _wrong_type(_found(f.tag), f.type)
        bad = bad | ((kind == code) & wrong)
        name = F.when(kind == code, r.kind).otherwise(name)
    error = (
        F.when(missing, MISSING).when(bad, BAD_VALUE)
        .when((kind == X.LOGOUT) & _found(X.TEXT).isNotNull(), X.LOGON_ERROR)
    )
    df = with_columns_once(df, {"error_code": error})
    return df.withColumns({
        "msg_type": kind,
        "kind": F.when(F.col("error_code").isNotNull(), "failure").otherwise(name),
        "error_text": F.when(kind == X.LOGOUT, _found(X.TEXT)),
    })


def route(df: DataFrame) -> DataFrame:
    """Add ``msg_type``, ``kind`` and ``error_code``/``error_text``.

    ``kind`` is execution, trade, quote, failure or dropped. A logout with a text
    is a failure, as is a report without its mandatory fields or with a value of
    the wrong type, or a group with other than the stated number of entries.
    """
    out = _classify(df, REPORTS, all_fields=False)
    return out.select(*df.columns, "msg_type", "kind", "error_code", "error_text")


def failures(df: DataFrame) -> DataFrame:
    """Messages that cannot become a report, with their raw text."""
    return route(df).where("kind = 'failure'").drop("kind")


def report(df: DataFrame, report: Report, hours: int = 0, zone: str | None = None, drop_time: bool = True) -> DataFrame:
    """The messages of one type as rows of typed fields.

    ``report`` describes the type, so a new type is data. Messages that
    :func:`failures` would name are left out.
    """
    code = report.code
    keep = [c for c in df.columns if c != "raw"]
    # messages of other types leave before they are parsed
    df = _classify(df.where(_is_type(F.col("raw"), code)), [report], all_fields=True)
    df = df.where(F.col("error_code").isNull())

    out = [F.lit(code).alias("MsgType")]
    out += [_typed(_found(f.tag), f.type).alias(f.name) for f in report.fields]
    if report.has_transact_time:
        stamp = local_time(_found(X.TRANSACT_TIME), hours, zone)
        out += [
            F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("TransactTime"),
            F.date_format(stamp, "yyyy-MM-dd").alias("TransactDate"),
        ]
    else:
        sent = _timestamp(_found(X.SENDING_TIME))
        fraction = F.date_format(sent, ".SSS")
        # no fraction, and no seconds, when they are zero
        seconds = F.when((fraction == ".000") & (F.second(sent) == 0), "").otherwise(
            F.concat(F.date_format(sent, ":ss"), F.when(fraction == ".000", "").otherwise(fraction))
        )
        out.append(F.concat(F.date_format(sent, "yyyy-MM-dd'T'HH:mm"), seconds).alias("TransactTime"))
    if report.group:
        out.append(_typed_group(F.col(f"_g{report.group.count_tag}"), report.group.fields).alias(report.group.name))
    id_tag = next(f.tag for f in report.fields if f.name == report.id_field)
    out.append(F.concat_ws(":", _found(X.MSG_SEQ_NUM), F.coalesce(_found(id_tag), F.lit("null"))).alias("Id"))
    if drop_time:
        out.append(F.current_timestamp().cast("string").alias("MessageDropTime"))
    return df.select(*keep, *out)


def executions(df: DataFrame, hours: int = 0, zone: str | None = None, drop_time: bool = True) -> DataFrame:
    """Execution reports, with their legs."""
    return report(df, EXECUTION, hours, zone, drop_time)


def trades(df: DataFrame, hours: int = 0, zone: str | None = None, drop_time: bool = True) -> DataFrame:
    """Trade capture reports, with their sides."""
    return report(df, TRADE, hours, zone, drop_time)


def quotes(df: DataFrame, drop_time: bool = True) -> DataFrame:
    """Quote status reports; the time is the sending time, not shifted."""
    return report(df, QUOTE, drop_time=drop_time)


def sequence_gaps(df: DataFrame, session: Sequence[str], seq: str, width: int | None = None) -> DataFrame:
    """Breaks in the numbering of each session.

    One row per message whose number is not one above the number before it:
    ``missing`` counts the skipped numbers, -1 marks a repeated number. A session
    of any size is checked in parallel.
    """
    prev = previous_value(df.select(*session, seq), session, seq, seq, "prev_seq", width=width)
    return prev.where(F.col(seq) - F.col("prev_seq") != 1).withColumn(
        "missing", F.col(seq) - F.col("prev_seq") - 1
    )
