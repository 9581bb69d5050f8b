"""Good rows and rejected rows out of one frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ERROR = "_error"
OUTCOME = "_outcome"


def mark(df: DataFrame, error: Column) -> DataFrame:
    """Add or extend ``_error``; the first error of a row stays."""
    if ERROR in df.columns:
        error = F.coalesce(F.col(ERROR), error)
    return df.withColumn(ERROR, error)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without error, rows with error)."""
    return df.where(F.col(ERROR).isNull()).drop(ERROR), df.where(F.col(ERROR).isNotNull())


def write_split(df: DataFrame, path: str, mode: str = "error") -> tuple[DataFrame, DataFrame]:
    """As :func:`split`, but the rows are worked out once: written by outcome below ``path`` and read back.

    A reader of one half opens only that half's files. Without rows both halves are empty.
    """
    marked = df.withColumn(OUTCOME, F.when(F.col(ERROR).isNull(), "ok").otherwise("rejected"))
    marked.write.mode(mode).partitionBy(OUTCOME).parquet(path)
    written = df.sparkSession.read.schema(marked.schema).parquet(path)
    return (
        written.where(F.col(OUTCOME) == "ok").drop(ERROR, OUTCOME).select(*[c for c in df.columns if c != ERROR]),
        written.where(F.col(OUTCOME) == "rejected").select(*df.columns),
    )
