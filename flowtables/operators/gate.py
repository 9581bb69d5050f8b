"""Commit gate: release the changes of committed transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flowtables.functions.ordered import next_value
from flowtables.sources.changelog import COMMIT_CODE, ROLLBACK_CODE


def decide(
    df: DataFrame, xid: str = "xid", pos: str = "scn", ties: Sequence[str] = (), width: int | None = None,
) -> DataFrame:
    """Add ``decision`` (struct of scn and code) to every row.

    The first commit or rollback at or after a change, inside its transaction id,
    decides it. Null means the transaction is still open. A transaction id may be
    used again after it was decided. A transaction may hold any share of the log:
    its rows are spread over position ranges.
    """
    code = F.col("operation_code")
    terminal = F.when(
        code.isin(COMMIT_CODE, ROLLBACK_CODE),
        F.struct(F.col(pos).alias("scn"), code.alias("code")),
    )
    return next_value(df, [xid], pos, terminal, "decision", ties=ties, width=width)


def committed_only(df: DataFrame, **options) -> DataFrame:
    """Committed changes with ``commit_scn``; release order is (commit_scn, scn)."""
    decided = decide(df, **options)
    is_change = ~F.col("operation_code").isin(COMMIT_CODE, ROLLBACK_CODE)
    return (
        decided.where(is_change & (F.col("decision.code") == COMMIT_CODE))
        .withColumn("commit_scn", F.col("decision.scn"))
        .drop("decision")
    )


def open_changes(df: DataFrame, **options) -> DataFrame:
    """Changes whose transaction is not decided yet."""
    is_change = ~F.col("operation_code").isin(COMMIT_CODE, ROLLBACK_CODE)
    return decide(df, **options).where(is_change & F.col("decision").isNull()).drop("decision")
