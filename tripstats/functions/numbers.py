"""Ratios, shares, coercion and weighted categories."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def as_int(column: str | Column) -> Column:
    """Number as INT; what is no number, and null, becomes 0."""
    return F.coalesce(_col(column).try_cast("int"), F.lit(0))


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator, 0.0 where the denominator is 0 or missing."""
    divisor = _col(denominator).cast("double")
    return F.when(divisor != 0, F.coalesce(_col(numerator), F.lit(0)) / divisor).otherwise(0.0)


def share_percent(part: str | Column, total: str | Column, digits: int = 1) -> Column:
    """Percentage of a total, rounded."""
    return F.round(_col(part).cast("double") * F.lit(100.0) / _col(total), digits)


def weighted_category(
    bucket: str | Column, categories: Sequence[int], weights: Sequence[int]
) -> Column:
    """Category by cumulative percentage: `bucket` is 0..99, `weights` add up to 100."""
    if len(categories) != len(weights) or sum(weights) != 100:
        raise ValueError("one weight per category, adding up to 100")
    ladder = F
    for category, upper in zip(categories, accumulate(weights)):
        ladder = ladder.when(_col(bucket) < upper, category)
    return ladder
