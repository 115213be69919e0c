"""Fact x dimension rollups: the one heavy step behind every statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.functions import exact_sum
from tripstats.operators.lookup import Dimension, touches_city

# Grains from which all eleven statistics follow. Both are bounded by companies x cities x
# calendar, however many events there are.
HOTEL_GRAIN = ("company_id", "cidade", "estrelas", "mes_reserva")
FLIGHT_GRAIN = ("company_id", "cidade_destino", "na_cidade", "dia_reserva")

# Grouping columns taken from the date of an event. Months collapse across years; add
# `ano_reserva` to a grain to keep years apart.
_DATE_KEYS = {
    "mes_reserva": F.month,
    "mes": F.month,
    "ano_reserva": F.year,
    "dia_reserva": F.to_date,
}


def _measures(value: bool) -> list[Column]:
    bookings = F.count(F.lit(1)).alias("num_reservas")
    return [exact_sum("valor").alias("sum_valor"), bookings] if value else [bookings]


def reaggregate(cube: DataFrame, by: Sequence[str]) -> DataFrame:
    """Coarser rollup of a rollup."""
    measures = [F.sum("num_reservas").alias("num_reservas")]
    if "sum_valor" in cube.columns:
        measures.insert(0, exact_sum("sum_valor").alias("sum_valor"))
    return cube.groupBy(*by).agg(*measures)


def rollup(
    events: DataFrame, dim: Dimension, by: Sequence[str], value: bool = True
) -> DataFrame:
    """Join events to `dim` and group by `by`: `sum_valor` (unless not wanted), `num_reservas`.

    `by` may mix event columns, dimension columns and the date keys above; only the columns
    named reach the scans.

    Small dimension: broadcast it and aggregate in the scan stage, so that what is shuffled is
    one row per group and task. Large dimension: events are first aggregated per id, which
    reduces a hot id to a few rows before anything is joined, then join and aggregate again. A
    stream is aggregated once, after the join, so that its state is the rollup itself.
    """
    taken = {
        k: (_DATE_KEYS[k]("data_reserva").alias(k) if k in _DATE_KEYS else F.col(k))
        for k in by
        if k in _DATE_KEYS or (k in events.columns and k != dim.key)
    }
    from_dim = [k for k in by if k not in taken]
    slim = events.select(dim.key, *taken.values(), *(["valor"] if value else []))
    if dim.small or events.isStreaming:
        return slim.join(dim.side(from_dim), dim.key).groupBy(*by).agg(*_measures(value))
    per_id = slim.groupBy(dim.key, *(k for k in taken)).agg(*_measures(value))
    return reaggregate(per_id.join(dim.side(from_dim), dim.key), by)


def hotel_cube(events: DataFrame, hotels: Dimension, also: Sequence[str] = ()) -> DataFrame:
    """Hotel events at HOTEL_GRAIN, in one pass; `also` adds keys such as a batch id."""
    return rollup(events, hotels, [*also, *HOTEL_GRAIN])


def flight_cube(
    events: DataFrame,
    flights: Dimension,
    city: str,
    any_spelling: bool = False,
    also: Sequence[str] = (),
) -> DataFrame:
    """Flight events at FLIGHT_GRAIN, in one pass; `na_cidade` flags routes touching `city`."""
    flagged = flights.reshaped(
        lambda d: d.withColumn(
            "na_cidade", F.coalesce(touches_city(city, any_spelling), F.lit(False))
        )
    )
    return rollup(events, flagged, [*also, *FLIGHT_GRAIN])
