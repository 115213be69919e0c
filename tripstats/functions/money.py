"""Sums of money held in doubles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _cents(value: Column) -> Column:
    return F.rint(value * F.lit(100.0))


def _rest(value: Column) -> Column:
    # nanvl: infinity - infinity is NaN, but the cents already carry the infinity.
    return F.nanvl(value - _cents(value) / F.lit(100.0), F.lit(0.0))


def exact_sum(column: str | Column) -> Column:
    """Sum of a double column that does not depend on the order of the rows.

    A plain sum of doubles changes in the last digits with every other partitioning, so a
    replayed batch or a retried task would not reproduce its result. Amounts are cents: their
    sum is exact in a double up to 2**53 cents, whatever the order. What a value has beyond
    whole cents is summed beside it, so no amount is rounded; that part is 0.0 for cents.
    Both sums are primitive, unlike a decimal sum, which boxes every row.
    """
    value = _col(column)
    return F.sum(_cents(value)) / F.lit(100.0) + F.sum(_rest(value))


def exact_sum_over(column: str | Column, window: WindowSpec) -> Column:
    """`exact_sum` over a window."""
    value = _col(column)
    return F.sum(_cents(value)).over(window) / F.lit(100.0) + F.sum(_rest(value)).over(window)


def exact_add(*columns: str | Column) -> Column:
    """Sum of columns of one row, in cents like `exact_sum`; null if any of them is."""
    values = [_col(c) for c in columns]
    cents = reduce(Column.__add__, map(_cents, values))
    return cents / F.lit(100.0) + reduce(Column.__add__, map(_rest, values))
