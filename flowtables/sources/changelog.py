"""Scan of a redo log held as a table.

Expected columns: xid, sql_redo, scn, ts, operation, operation_code, rollback,
seg_owner, seg_name, row_id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: redo operation codes ---------------------------------------
DML_CODES = (1, 2, 3)  # insert, delete, update
COMMIT_CODE = 7
ROLLBACK_CODE = 36
# ------------------------------------------------------------------------------


def table_list(tables: str | Sequence[str]) -> Column:
    """Predicate for ``OWNER.TABLE,OWNER.TABLE`` (case-sensitive).

    Plain comparisons, so the scan can push them down.
    """
    names = tables.split(",") if isinstance(tables, str) else list(tables)
    cond = F.lit(False)
    for name in names:
        owner, dot, table = name.partition(".")
        if not dot or not table:
            raise ValueError(f"table name needs the form OWNER.TABLE: {name!r}")
        one = (F.col("seg_owner") == owner) & (F.col("seg_name") == table)
        cond = one if name is names[0] else cond | one
    return cond


def scn_range(df: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows with ``start <= scn <= end``; an open side is left out."""
    if start is not None:
        df = df.where(F.col("scn") >= start)
    if end is not None:
        df = df.where(F.col("scn") <= end)
    return df


def scan_all(df: DataFrame, tables: str | Sequence[str], start: int | None = None, end: int | None = None) -> DataFrame:
    """Every change of the listed tables, committed or not."""
    return scn_range(df, start, end).where(F.col("operation_code").isin(*DML_CODES) & table_list(tables))


def scan_transactional(df: DataFrame, tables: str | Sequence[str], start: int | None = None, end: int | None = None) -> DataFrame:
    """Changes of the listed tables plus every commit and rollback.

    Rows that undo a savepoint (``rollback <> 0``) are left out; the rows they
    undo stay.
    """
    dml = (F.col("rollback") == 0) & F.col("operation_code").isin(*DML_CODES) & table_list(tables)
    return scn_range(df, start, end).where(F.col("operation_code").isin(COMMIT_CODE, ROLLBACK_CODE) | dml)


def next_offset(df: DataFrame, start: int) -> DataFrame:
    """One row ``next_scn``: last SCN plus one, or ``start`` when no row was read."""
    return df.agg(F.coalesce(F.max("scn") + 1, F.lit(start).cast("long")).alias("next_scn"))


def select_segments(online: DataFrame, archived: DataFrame, members: DataFrame, scn: int) -> DataFrame:
    """Log segments needed to read from ``scn``, newest first.

    ``online``: group_no, first_change, next_change, first_time. ``members``:
    group_no, member. ``archived``: member, first_change, next_change,
    first_time. Archived segments are used only when ``scn`` is older than the
    oldest selected online segment, and only up to that segment.
    """
    first, nxt = F.col("first_change"), F.col("next_change")
    covers = (first <= scn) & (F.lit(scn) < nxt)
    cols = ["kind", "first_change", "first_time", "member"]
    live = (
        online.where((first >= scn) | covers)
        .join(members, "group_no")
        .withColumn("kind", F.lit("online")).select(*cols)
    )
    # null when no online segment qualifies: then no archived one does either
    oldest = live.agg(F.min("first_change").alias("oldest"))
    limit = oldest.scalar()
    old = (
        archived.where((F.lit(scn) < limit) & (((first >= scn) & (nxt <= limit)) | covers))
        .withColumn("kind", F.lit("archived")).select(*cols)
    )
    return live.unionByName(old).orderBy(F.col("kind").desc(), F.col("first_time").desc(), F.col("member"))
