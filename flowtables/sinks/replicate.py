"""Copy the result of a source query into a target table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def replicate(source: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", compression: str | None = None) -> None:
    """Write a source frame to a target table held as files.

    For a database target use :func:`flowtables.sources.tables.write_table`.
    """
    writer = source.write.format(fmt).mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.save(path)
