"""Windows over aggregated statistics: rolling means, shares, first or last n per company.

All run on totals, whose rows per company are bounded by the calendar or the number of cities.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstats.functions import day_number, normalize_name, share_percent


def rolling_mean(
    daily: DataFrame, value: str, date: str, out: str, size: int = 7, calendar: bool = False
) -> DataFrame:
    """Mean of the last `size` rows of each company by date, fewer at the start.

    Days without a row are not filled in. With `calendar` the frame is the last `size` days
    instead, however many rows they hold.
    """
    window = Window.partitionBy("company_id")
    if calendar:
        frame = window.orderBy(day_number(date)).rangeBetween(-(size - 1), 0)
    else:
        frame = window.orderBy(date).rowsBetween(-(size - 1), 0)
    return daily.withColumn(out, F.avg(value).over(frame))


def with_share(counts: DataFrame, count: str, out: str) -> DataFrame:
    """Share of each row in the grand total, in percent with one decimal.

    For a handful of category rows: a window without partitions is a single task.
    """
    return counts.withColumn(out, share_percent(count, F.sum(count).over(Window.partitionBy())))


def ranked(
    stats: DataFrame, value: str, name: str, n: int, order: str = "asc",
    within: Sequence[str] = ("company_id",), rank: str = "posicao",
) -> DataFrame:
    """First `n` rows per company by `value`, ties by `name`, with their position.

    Spark plans the rank filter as a group limit, so a task forwards at most n rows per company.
    """
    if order not in ("asc", "desc"):
        raise ValueError("order is 'asc' or 'desc'")
    by_value = F.col(value).asc() if order == "asc" else F.col(value).desc()
    window = Window.partitionBy(*within).orderBy(by_value, F.col(name))
    return stats.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def first_per_name(
    rows: DataFrame, name: str, order: Sequence[str], within: Sequence[str] = ("company_id",)
) -> DataFrame:
    """One row per normalized name: the first by `order`.

    A minimum over structs rather than a window, so that spellings combine before the shuffle.
    """
    rest = [c for c in rows.columns if c not in within and c not in order]
    packed = F.struct(*order, *rest)
    return (
        rows.groupBy(*within, normalize_name(name).alias("_norm"))
        .agg(F.min(packed).alias("_first"))
        .select(*within, "_first.*")
        .select(*rows.columns)
    )
