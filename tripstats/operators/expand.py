"""Row expansion: nights of a stay, a calendar of departures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stay_nights(bookings: DataFrame, start: str, nights: str | Column) -> DataFrame:
    """One row per night of a booking: `data_reservada` = start + i, i as `noite` from 0.

    Every other column, the amount included, repeats.
    """
    count = (F.col(nights) if isinstance(nights, str) else nights).cast("int")
    expanded = bookings.select("*", F.explode(F.sequence(F.lit(0), count - 1)).alias("noite"))
    return expanded.withColumn(
        "data_reservada", F.date_add(F.col(start).cast("date"), F.col("noite"))
    )


def departures(routes: DataFrame, first: str, last: str, per_day: Column) -> DataFrame:
    """Calendar of departures: each route flies `per_day` times on each day first..last.

    `routes` holds one row per `cidade_origem`, `cidade_destino`; a route from a city to
    itself is left out. `per_day` may use the route and the day (`data`). Routes and days only
    ever unfold, nothing is joined.
    """
    days = routes.where(F.col("cidade_origem") != F.col("cidade_destino")).select(
        "cidade_origem",
        "cidade_destino",
        F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))).alias("data"),
    )
    return days.select(
        "*", F.explode(F.sequence(F.lit(1), per_day.cast("int"))).alias("partida")
    ).select(
        "cidade_origem",
        "cidade_destino",
        "data",
        "partida",
        F.dayofmonth("data").alias("dia"),
        F.month("data").alias("mes"),
        F.year("data").alias("ano"),
    )


def numbered(rows: DataFrame, group: str, order: Sequence[str], out: str) -> DataFrame:
    """Running number 1.. over (`group`, *order) without a single-task window over the rows.

    Rows are numbered inside their group and shifted by the size of the groups before; only the
    group sizes, one row per group, pass through one task.
    """
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        group, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    inside = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return (
        rows.withColumn("_inside", inside)
        .join(shifts, group)
        .withColumn(out, F.col("_shift") + F.col("_inside"))
        .drop("_inside", "_shift")
    )
