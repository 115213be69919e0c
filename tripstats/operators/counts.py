"""Counts per expected category, absent categories included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_per(frame: DataFrame, column: str, expected: Sequence[str], out: str) -> DataFrame:
    """Rows per expected value of `column`, 0 where there are none.

    One counter per value in a single aggregate: each task sends one row.
    """
    counters = frame.agg(
        *(F.count(F.when(F.col(column) == v, 1)).alias(f"n{i}") for i, v in enumerate(expected))
    )
    return unfolded(
        counters,
        [{column: F.lit(v), out: F.col(f"n{i}")} for i, v in enumerate(expected)],
    )


def unfolded(one_row: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """The given rows of named expressions out of a one-row frame."""
    structs = (F.struct(*(c.alias(name) for name, c in row.items())) for row in rows)
    return one_row.select(F.inline(F.array(*structs)))
