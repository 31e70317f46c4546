"""Turning a one-row summary into a list of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_rows(one_row: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    """One output row per tuple of columns or literals, from a single scan of the summary."""
    cells = [
        F.struct(*[_cell(value).alias(name) for name, value in zip(names, row, strict=True)]) for row in rows
    ]
    return one_row.select(F.inline(F.array(*cells)))


def _cell(value):
    return value if isinstance(value, Column) else F.lit(value)
