"""Dense axes: every month 1..12 or star 1..5 of every company, whether it has data or not."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.functions import as_int

MONTHS = range(1, 13)
STARS = range(1, 6)


def dense_axis(
    stats: DataFrame,
    key: str,
    axis: Iterable[int],
    values: Sequence[str],
    axis_name: str,
    per: Sequence[str] = ("company_id",),
) -> DataFrame:
    """One row per company, or `per`, and axis point; missing points get 0, keys off the axis drop.

    Equivalent to a left join of companies x axis with the statistics, but reads `stats` once
    and needs neither a cross join nor a list of companies: one aggregate per company with a
    slot per axis point, unfolded again.
    """
    types = dict(stats.dtypes)
    keyed = stats.withColumn("_point", as_int(key))
    slots = [
        F.struct(
            F.lit(point).alias(axis_name),
            *(
                F.coalesce(F.sum(F.when(F.col("_point") == point, F.col(v))), F.lit(0))
                .cast(types[v])
                .alias(v)
                for v in values
            ),
        )
        for point in axis
    ]
    return (
        keyed.groupBy(*per)
        .agg(F.array(*slots).alias("_slots"))
        .select(*per, F.inline("_slots"))
    )
