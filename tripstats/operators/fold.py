"""Additive folding of partial statistics into totals."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.functions import exact_sum
from tripstats.operators.counts import counts_per
from tripstats.schemas import ALL_KEYS, ALL_VALUES, STAT_TABLES, WIDE_COLUMNS, StatTable


def _added(values: Mapping[str, str]) -> list[Column]:
    return [
        (exact_sum(v) if kind == "double" else F.sum(v)).alias(v) for v, kind in values.items()
    ]


def fold(table: StatTable, *parts: DataFrame) -> DataFrame:
    """Insert new keys, add to known ones: the sum of `parts` (totals, partials) by key."""
    rows = reduce(DataFrame.unionByName, (p.select(*table.columns) for p in parts))
    return rows.groupBy("company_id", *table.keys).agg(*_added(table.values))


def stamped(wide: DataFrame) -> DataFrame:
    """Wide rows with their insertion time, columns in store order."""
    return wide.withColumn("inserido_em", F.current_timestamp()).select(*WIDE_COLUMNS)


def fold_wide(*parts: DataFrame) -> DataFrame:
    """`fold` of all eleven tables in one aggregation over their wide form."""
    rows = reduce(DataFrame.unionByName, parts)
    return (
        rows.groupBy("table", "company_id", *ALL_KEYS)
        .agg(*_added(ALL_VALUES), F.max("inserido_em").alias("inserido_em"))
        .select(*WIDE_COLUMNS)
    )


def one_table(wide: DataFrame, table: StatTable, *also: str) -> DataFrame:
    """The rows and columns of one table out of the wide form."""
    return wide.where(F.col("table") == table.name).select(*also, *table.columns)


def pending_counts(wide: DataFrame, folded_up_to: int) -> DataFrame:
    """Partial rows per table that no fold has consumed yet."""
    waiting = wide.where(F.col("batch_id") > folded_up_to)
    return counts_per(waiting, "table", list(STAT_TABLES), "pending")
