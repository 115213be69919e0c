"""The eleven statistics, derived from the two cubes or from coarser rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.functions import exact_add, exact_sum
from tripstats.operators.fold import one_table
from tripstats.schemas import ALL_KEYS, ALL_VALUES, STAT_TABLES


def star_parts(cube: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sum of stars and number of bookings: the additive halves of a mean."""
    return cube.groupBy(*by).agg(
        F.sum(F.col("estrelas") * F.col("num_reservas")).alias("sum_estrelas"),
        F.sum("num_reservas").alias("num_reservas"),
    )


def city_revenue(city_month: DataFrame, by: Sequence[str]) -> DataFrame:
    """Revenue per city, with `num_reservas` counting its *month groups*, not its bookings.

    The average ticket is defined on month groups; see `ticket_inputs`. The input holds one row
    per city and month.
    """
    return city_month.groupBy(*by).agg(
        exact_sum("sum_valor").alias("sum_valor"),
        F.count(F.lit(1)).alias("num_reservas"),
    )


def _check_how(how: str) -> None:
    if how not in ("inner", "full"):
        raise ValueError("how is 'inner' (one-sided keys drop) or 'full' (the other side is 0)")


def _both(hotels: DataFrame, flights: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    _check_how(how)
    return hotels.join(flights, list(on), how)


def _either_or(left: str, right: str, both: Column) -> Column:
    """`both`, or the one side there is where the other is missing as a whole (full join)."""
    return (
        F.when(F.col("_h").isNull(), F.col(right))
        .when(F.col("_f").isNull(), F.col(left))
        .otherwise(both)
    )


def _amounts(left: str, right: str) -> Column:
    return _either_or(left, right, exact_add(left, right))


def _counts(left: str, right: str) -> Column:
    return _either_or(left, right, F.col(left) + F.col(right))


def combined_revenue(
    hotel_months: DataFrame, flight_months: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Hotel plus flight revenue per company and month as `total_valor`.

    Both inputs are aggregates by the join key, so the join reuses their partitioning.
    """
    joined = _both(
        hotel_months.select(*on, F.col("sum_valor").alias("h_valor"), F.lit(1).alias("_h")),
        flight_months.select(*on, F.col("sum_valor").alias("f_valor"), F.lit(1).alias("_f")),
        on,
        how,
    )
    return joined.select(*on, _amounts("h_valor", "f_valor").alias("total_valor"))


def ticket_inputs(
    hotel_cities: DataFrame, flight_cities: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Revenue and transactions of hotels plus flights per company and city.

    What counts as a transaction is what `num_reservas` of the inputs counts: month groups with
    `city_revenue`, bookings with a plain rollup.
    """
    hotels = hotel_cities.withColumnRenamed("cidade", "cidade_destino")
    joined = _both(
        hotels.select(
            *on,
            F.col("sum_valor").alias("h_valor"),
            F.col("num_reservas").alias("h_num"),
            F.lit(1).alias("_h"),
        ),
        flight_cities.select(
            *on,
            F.col("sum_valor").alias("f_valor"),
            F.col("num_reservas").alias("f_num"),
            F.lit(1).alias("_f"),
        ),
        on,
        how,
    )
    return joined.select(
        *on,
        _amounts("h_valor", "f_valor").alias("sum_valor"),
        _counts("h_num", "f_num").alias("num_transacoes"),
    )


# Which group feeds which table, when, and with what. The axis is the column a group is keyed by
# besides the company.
_FEEDS: dict[str, tuple[str, str, dict[str, str]]] = {
    "stats_month_hotel": ("mes", "h_num > 0", {"mes_reserva": "mes", "sum_valor": "h_valor"}),
    "stats_city_hotel": ("cidade", "h_num > 0", {"cidade": "cidade", "sum_valor": "h_valor"}),
    "stats_month_voos": ("mes", "f_num > 0", {"mes_reserva": "mes", "sum_valor": "f_valor"}),
    "stats_city_voos": (
        "cidade", "f_num > 0", {"cidade_destino": "cidade", "sum_valor": "f_valor"}
    ),
    "stats_faturamentos_totais": (
        "mes", "joined", {"mes_reserva": "mes", "total_valor": "t_valor"}
    ),
    "stats_ticket_medio": (
        "cidade",
        "joined",
        {"cidade_destino": "cidade", "sum_valor": "t_valor", "num_transacoes": "t_meses"},
    ),
    "stats_month_hotel_count": (
        "mes", "h_num > 0", {"mes_reserva": "mes", "num_hoteis_reservados": "h_num"}
    ),
    "stats_stars_hotel": (
        "estrelas", "h_num > 0", {"estrelas": "estrelas", "num_reservas": "h_num"}
    ),
    "stats_estrelas_medias_mes": (
        "mes",
        "h_num > 0",
        {"mes_reserva": "mes", "sum_estrelas": "h_estrelas", "num_reservas": "h_num"},
    ),
    "stats_month_sp_voos": ("mes", "c_num > 0", {"mes": "mes", "num_voos_reservados": "c_num"}),
    "stats_day_sp_voos": ("dia", "c_num > 0", {"data_reserva": "dia", "num_reservas": "c_num"}),
}
_AXES = ["mes", "cidade", "estrelas", "dia"]
_JOINED = {
    # An inner join needs both sides and a key; a full one either side.
    "inner": "h_num > 0 AND f_num > 0 AND company_id IS NOT NULL"
    " AND (mes IS NOT NULL OR cidade IS NOT NULL)",
    "full": "h_num > 0 OR f_num > 0",
}


def _month_bit(month: str) -> str:
    return f"shiftleft(1, coalesce({month}, 0))"


def wide_statistics(
    hotels: DataFrame, flights: DataFrame, also: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """All eleven tables, side by side, from the hotel and the flight cube in one aggregation.

    Hotels and flights are stacked and grouped by month, city, stars and day at once (grouping
    sets). Each group then unfolds into the tables it feeds; "months both sides have" is a test
    on the group, so nothing is joined. Month groups of a city are counted from a bit mask of
    months, which unlike a distinct count adds up in partial aggregates. With
    `also=["batch_id"]` every batch gets its own rows; `how` is as in `combined_revenue`.
    """
    _check_how(how)
    base = [*also, "company_id"]
    hotel_rows = hotels.selectExpr(
        *base,
        "mes_reserva AS mes",
        "cidade",
        "estrelas",
        "sum_valor AS h_valor",
        "num_reservas AS h_num",
        "estrelas * num_reservas AS h_estrelas",
        f"{_month_bit('mes_reserva')} AS h_meses",
    )
    flight_rows = flights.selectExpr(
        *base,
        "month(dia_reserva) AS mes",
        "cidade_destino AS cidade",
        "dia_reserva AS dia",
        "sum_valor AS f_valor",
        "num_reservas AS f_num",
        "CASE WHEN na_cidade THEN num_reservas END AS c_num",
        f"{_month_bit('month(dia_reserva)')} AS f_meses",
    )
    stacked = hotel_rows.unionByName(flight_rows, allowMissingColumns=True)
    groups = (
        stacked.groupingSets([[*base, axis] for axis in _AXES], *base, *_AXES)
        .agg(
            *(F.grouping(axis).alias(f"no_{axis}") for axis in _AXES),
            *(exact_sum(v).alias(v) for v in ("h_valor", "f_valor")),
            *(F.sum(v).alias(v) for v in ("h_num", "f_num", "c_num", "h_estrelas")),
            *(F.bit_count(F.bit_or(v)).alias(v) for v in ("h_meses", "f_meses")),
        )
        .selectExpr(
            "*",
            "CASE WHEN h_num > 0 THEN 1 END AS _h",
            "CASE WHEN f_num > 0 THEN 1 END AS _f",
            f"{_JOINED[how]} AS joined",
        )
        .withColumns(
            {"t_valor": _amounts("h_valor", "f_valor"), "t_meses": _counts("h_meses", "f_meses")}
        )
    )
    fed = [
        f"CASE WHEN no_{axis} = 0 AND {condition} THEN '{name}' END"
        for name, (axis, condition, _) in _FEEDS.items()
    ]
    unfolded = groups.selectExpr(
        "*", f"explode(array_compact(array({', '.join(fed)}))) AS table"
    )

    def filled(column: str, kind: str) -> str:
        cases = [
            f"WHEN '{name}' THEN {values[column]}"
            for name, (_, _, values) in _FEEDS.items()
            if column in values
        ]
        return f"CAST(CASE table {' '.join(cases)} END AS {kind}) AS {column}"

    columns = {**ALL_KEYS, **ALL_VALUES}
    return unfolded.selectExpr(*base, *(filled(c, k) for c, k in columns.items()), "table")


def all_statistics(
    hotels: DataFrame, flights: DataFrame, also: Sequence[str] = (), how: str = "inner"
) -> dict[str, DataFrame]:
    """`wide_statistics` as one frame per table."""
    wide = wide_statistics(hotels, flights, also, how)
    return {name: one_table(wide, table, *also) for name, table in STAT_TABLES.items()}
