"""Profiles of the dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.functions import date_text, is_weekend, safe_ratio
from tripstats.operators.ranking import with_share


def star_shares(hotels: DataFrame) -> DataFrame:
    """Hotels per number of stars and their share of all hotels."""
    counts = hotels.groupBy("estrelas").agg(F.count(F.lit(1)).alias("total"))
    return with_share(counts, "total", "percentual").orderBy("estrelas")


def top_hotel_cities(hotels: DataFrame, n: int = 10) -> DataFrame:
    """Cities with most hotels, ties by name."""
    counts = hotels.groupBy("cidade").agg(F.count(F.lit(1)).alias("total_hoteis"))
    return counts.orderBy(F.col("total_hoteis").desc(), "cidade").limit(n)


def flights_per_month(flights: DataFrame) -> DataFrame:
    return flights.groupBy("mes").agg(F.count(F.lit(1)).alias("total_voos")).orderBy("mes")


def hotel_profile(hotels: DataFrame) -> DataFrame:
    """Number of hotels and of cities, and their ratio."""
    per_city = hotels.groupBy("cidade").agg(F.count(F.lit(1)).alias("n"))
    return per_city.agg(
        F.sum("n").alias("hoteis"), F.count("cidade").alias("cidades")
    ).withColumn("hoteis_por_cidade", safe_ratio("hoteis", "cidades"))


def flight_profile(flights: DataFrame) -> DataFrame:
    """Number of flights, routes and days, and flights per day.

    Distinct counts by way of small distinct frames: flights collapse to one row per route and
    day in the scan stage.
    """
    per_route_day = flights.groupBy(
        "cidade_origem", "cidade_destino", "ano", "mes", "dia"
    ).agg(F.count(F.lit(1)).alias("n"))
    return per_route_day.agg(
        F.sum("n").alias("voos"),
        F.count_distinct("cidade_origem", "cidade_destino").alias("rotas"),
        F.count_distinct("ano", "mes", "dia").alias("dias"),
    ).withColumn("voos_por_dia", safe_ratio("voos", "dias"))


def calendar_parts(dates: DataFrame, column: str) -> DataFrame:
    """Distinct days with their text, day, month and year, and whether they are a weekend."""
    return (
        dates.select(F.to_date(column).alias("data"))
        .distinct()
        .select(
            "data",
            date_text("data").alias("texto"),
            F.dayofmonth("data").alias("dia"),
            F.month("data").alias("mes"),
            F.year("data").alias("ano"),
            is_weekend("data").alias("fim_de_semana"),
        )
    )
