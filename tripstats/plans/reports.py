"""Report tables: the shapes in which totals are read.

Every report covers all companies in one job; `where("company_id = ...")` picks one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstats.functions import month_name, normalize_name, normalized, safe_ratio
from tripstats.operators.ranking import first_per_name, ranked, rolling_mean
from tripstats.operators.spine import MONTHS, STARS, dense_axis
from tripstats.schemas import MANDATORY_CITIES

MAX_LOG_ROWS = 1000
CITY_REPORT_ROWS = 10


def of_company(stats: DataFrame, company: str) -> DataFrame:
    return stats.where(F.col("company_id") == company)


def by_value(stats: DataFrame, value: str) -> DataFrame:
    """Rows of each company from the lowest value up; ties by the other columns."""
    rest = [c for c in stats.columns if c not in ("company_id", value)]
    return stats.orderBy("company_id", value, *rest)


def by_key(stats: DataFrame, *keys: str) -> DataFrame:
    """Rows of each company by `keys`, such as its months or stars."""
    return stats.orderBy("company_id", *keys)


def month_report(
    stats: DataFrame,
    value: str,
    key: str = "mes_reserva",
    per: Sequence[str] = ("company_id",),
) -> DataFrame:
    """Twelve rows in order per company, or `per`, with the month's name, 0 for no data."""
    dense = dense_axis(stats, key, MONTHS, [value], "month_num", per)
    name = month_name("month_num").alias("month_name")
    return dense.select(*per, "month_num", name, value).orderBy(*per, "month_num")


def star_report(stats: DataFrame) -> DataFrame:
    """Bookings for each of 1..5 stars, in that order."""
    return by_key(dense_axis(stats, "estrelas", STARS, ["num_reservas"], "estrelas"), "estrelas")


def mean_star_report(stats: DataFrame) -> DataFrame:
    """Mean stars per month, 0 where there are no bookings."""
    dense = dense_axis(stats, "mes_reserva", MONTHS, ["sum_estrelas", "num_reservas"], "month_num")
    return dense.select(
        "company_id",
        "month_num",
        month_name("month_num").alias("month_name"),
        safe_ratio("sum_estrelas", "num_reservas").alias("media_estrelas"),
    ).orderBy("company_id", "month_num")


def ticket_report(stats: DataFrame) -> DataFrame:
    """Average ticket per city."""
    return stats.select(
        "company_id",
        "cidade_destino",
        safe_ratio("sum_valor", "num_transacoes").alias("ticket_medio"),
    )


def extreme_cities(
    stats: DataFrame, city: str, n: int = CITY_REPORT_ROWS, order: str = "asc"
) -> DataFrame:
    """The `n` cities with the lowest ('asc') or highest ('desc') revenue per company."""
    return ranked(stats.select("company_id", city, "sum_valor"), "sum_valor", city, n, order)


def missing_cities(stats: DataFrame, mandatory: Sequence[str] = MANDATORY_CITIES) -> DataFrame:
    """Mandatory cities a company has no row for under any spelling.

    One aggregate: a counter per mandatory city, unfolded where it stayed 0.
    """
    counters = [
        F.struct(
            F.lit(city).alias("cidade"),
            F.count_if(F.col("_norm") == normalized(city)).alias("held"),
        )
        for city in mandatory
    ]
    return (
        stats.withColumn("_norm", normalize_name("cidade"))
        .groupBy("company_id")
        .agg(F.array(*counters).alias("_counters"))
        .select("company_id", F.inline("_counters"))
        .where("held = 0")
        .drop("held")
    )


def city_report(
    stats: DataFrame,
    n: int = CITY_REPORT_ROWS,
    order: str = "asc",
    mandatory: Sequence[str] = MANDATORY_CITIES,
) -> DataFrame:
    """At most `n` cities per company, one row per name whatever its spelling.

    Mandatory cities without a row count as 0. The n extreme rows are taken first, then
    spellings of one city merge into the first of them; places freed that way go to mandatory
    cities not shown yet, in their order, with their true revenue. Reads `stats` more than
    once; hand it a table where a rollup would be dear.
    """
    padded = stats.select("company_id", "cidade", "sum_valor").unionByName(
        missing_cities(stats, mandatory).withColumn("sum_valor", F.lit(0.0))
    )
    names = F.array(*(F.lit(normalized(c)) for c in mandatory))
    place = F.array_position(names, normalize_name("cidade")).cast("int")
    extreme = ranked(padded, "sum_valor", "cidade", n, order, rank="_turn")
    named = padded.withColumn("_turn", place).where("_turn > 0")
    turns = ["_late", "_turn", "sum_valor"]
    merged = first_per_name(
        extreme.withColumn("_late", F.lit(False)).unionByName(
            named.withColumn("_late", F.lit(True))
        ),
        "cidade",
        turns,
    )
    window = Window.partitionBy("company_id").orderBy(*turns, "cidade")
    return (
        merged.withColumn("posicao", F.row_number().over(window))
        .where(F.col("posicao") <= n)
        .select("company_id", "cidade", "sum_valor", "posicao")
    )


def rolling_report(daily: DataFrame, calendar: bool = False) -> DataFrame:
    """Seven-row rolling mean of daily flight counts."""
    mean = rolling_mean(
        daily, "num_reservas", "data_reserva", "media_movel_7dias", 7, calendar=calendar
    )
    return by_key(mean.select("company_id", "data_reserva", "media_movel_7dias"), "data_reserva")


def clients(*stats: DataFrame) -> DataFrame:
    """Companies that occur in any of the tables, sorted."""
    names = stats[0].select("company_id").distinct()
    for other in stats[1:]:
        names = names.union(other.select("company_id").distinct())
    return names.dropna(subset=["company_id"]).distinct().orderBy("company_id")


def run_log_page(log: DataFrame, limit: int = 100, order: str = "desc") -> DataFrame:
    """Latest or earliest runs."""
    if not 1 <= limit <= MAX_LOG_ROWS:
        raise ValueError(f"limit is 1..{MAX_LOG_ROWS}")
    if order not in ("asc", "desc"):
        raise ValueError("order is 'asc' or 'desc'")
    start = F.col("start_time")
    return log.orderBy(start.asc() if order == "asc" else start.desc(), "id").limit(limit)
