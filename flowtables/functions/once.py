"""Compute costly columns once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like ``withColumns``, but later filters do not repeat the expressions.

    A filter on a computed column is normally pushed below the projection, and
    its expressions are then evaluated a second time. A one-element generator
    above the projection keeps them in place; it adds no shuffle, and the projection
    works out once what its expressions share.
    """
    keep = [c for c in df.columns if c not in columns]
    worked = df.select(*keep, *[c.alias(n) for n, c in columns.items()])
    return worked.select(*keep, F.inline(F.array(F.struct(*columns))))
