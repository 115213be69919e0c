"""Registered queries: each operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.functions import exact_sum, normalize_name, weighted_category
from tripstats.operators import checks, distinct, expand, fold, gate, lookup, maintain, quarantine, ranking
from tripstats.operators.rollup import flight_cube, hotel_cube, rollup
from tripstats.operators.statistics import (
    city_revenue,
    combined_revenue,
    star_parts,
    ticket_inputs,
    wide_statistics,
)
from tripstats.plans import profile, reports
from tripstats.plans.tables import BATCHES, Tables
from tripstats.schemas import FLIGHT_SOURCE, HOTEL_SOURCE, STAT_TABLES, stat_table
from tripstats.sources.messages import decode_flights, decode_hotels, rejects, usable

CITY = "NATION_0"
MANDATORY = ("Nation_3", "nation_99", "NATION_0", "Náção_7")
FOLDED_UP_TO = 199
THRESHOLDS = {HOTEL_SOURCE: 50, FLIGHT_SOURCE: 50, "raw_cars": 1}

MONTH = ["company_id", "mes_reserva"]
HOTEL_CITY = ["company_id", "cidade"]
FLIGHT_CITY = ["company_id", "cidade_destino"]
BATCH = ["batch_id"]

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def _query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function: Callable[[Tables], DataFrame]):
        return lambda spark, folder: function(Tables(spark, folder))

    return {name: bound(function) for name, function in _QUERIES.items()}


# --- joins and lookups -----------------------------------------------------------------------


@_query
def join_hotel(t: Tables) -> DataFrame:
    return lookup.enrich(t.hotel_events.drop("batch_id"), t.hotel_dim)


@_query
def join_flight(t: Tables) -> DataFrame:
    return lookup.enrich(t.flight_events.drop("batch_id"), t.flight_dim)


@_query
def join_drops_unknown(t: Tables) -> DataFrame:
    """Reservations of suppliers in debt have no hotel and drop out."""
    solvent = t.read("supplier").where("s_acctbal >= 0").select(
        F.col("s_suppkey").alias("id_hotel")
    )
    known = t.hotel_dim.reshaped(lambda d: d.join(solvent, "id_hotel", "left_semi"))
    return rollup(t.hotel_events, known, MONTH)


@_query
def dim_semi_join(t: Tables) -> DataFrame:
    return lookup.rows_in_use(t.flights, t.flight_events, "id_voo")


@_query
def city_filter_flights(t: Tables) -> DataFrame:
    return lookup.flights_of_city(t.flight_events.drop("batch_id"), t.flight_dim, CITY)


@_query
def city_filter_any_spelling(t: Tables) -> DataFrame:
    spelling = (
        F.when(F.col("id_voo") % 3 == 0, F.col("cidade_origem"))
        .when(F.col("id_voo") % 3 == 1, F.lower("cidade_origem"))
        .otherwise(F.translate("cidade_origem", "AI", "ÃÍ"))
    )
    spelled = t.flight_dim.reshaped(lambda d: d.withColumn("cidade_origem", spelling))
    flights = lookup.flights_of_city(t.flight_events, spelled, "Nátion_0", any_spelling=True)
    return flights.groupBy("company_id", "cidade_origem", "cidade_destino").agg(
        F.count(F.lit(1)).alias("num_voos_reservados")
    )


# --- the statistics --------------------------------------------------------------------------


@_query
def city_month_hotel(t: Tables) -> DataFrame:
    by = [*HOTEL_CITY, "mes_reserva"]
    return rollup(t.hotel_events, t.hotel_dim, by).drop("num_reservas")


@_query
def city_month_flight(t: Tables) -> DataFrame:
    by = [*FLIGHT_CITY, "mes_reserva"]
    return rollup(t.flight_events, t.flight_dim, by).drop("num_reservas")


@_query
def month_hotel(t: Tables) -> DataFrame:
    return rollup(t.hotel_events, t.hotel_dim, MONTH).drop("num_reservas")


@_query
def month_flight(t: Tables) -> DataFrame:
    return rollup(t.flight_events, t.flight_dim, MONTH).drop("num_reservas")


@_query
def year_month_hotel(t: Tables) -> DataFrame:
    return rollup(t.hotel_events, t.hotel_dim, ["company_id", "ano_reserva", "mes_reserva"])


def _hotel_cities(t: Tables, also: list[str]) -> DataFrame:
    by_month = rollup(t.hotel_events, t.hotel_dim, [*also, *HOTEL_CITY, "mes_reserva"])
    return city_revenue(by_month, [*also, *HOTEL_CITY])


def _flight_cities(t: Tables, also: list[str]) -> DataFrame:
    by_month = rollup(t.flight_events, t.flight_dim, [*also, *FLIGHT_CITY, "mes_reserva"])
    return city_revenue(by_month, [*also, *FLIGHT_CITY])


@_query
def city_hotel(t: Tables) -> DataFrame:
    """Revenue per city with the number of month groups."""
    return _hotel_cities(t, [])


@_query
def city_flight(t: Tables) -> DataFrame:
    return _flight_cities(t, [])


def _hotel_counts(t: Tables, also: list[str]) -> DataFrame:
    counts = rollup(t.hotel_events, t.hotel_dim, [*also, *MONTH], value=False)
    return counts.withColumnRenamed("num_reservas", "num_hoteis_reservados")


def _stars(t: Tables, also: list[str]) -> DataFrame:
    return rollup(t.hotel_events, t.hotel_dim, [*also, "company_id", "estrelas"], value=False)


def _month_stars(t: Tables, also: list[str]) -> DataFrame:
    by = [*also, *MONTH]
    return star_parts(rollup(t.hotel_events, t.hotel_dim, [*by, "estrelas"], value=False), by)


@_query
def month_hotel_count(t: Tables) -> DataFrame:
    return _hotel_counts(t, [])


@_query
def stars_hotel(t: Tables) -> DataFrame:
    return _stars(t, [])


@_query
def month_stars(t: Tables) -> DataFrame:
    return _month_stars(t, [])


def _city_flights(t: Tables, also: list[str], day: str, out: str, count: str) -> DataFrame:
    routes = t.flight_dim.reshaped(lambda d: d.where(lookup.touches_city(CITY)))
    counts = rollup(t.flight_events, routes, [*also, "company_id", day], value=False)
    return counts.withColumnsRenamed({day: out, "num_reservas": count})


def _month_city(t: Tables, also: list[str]) -> DataFrame:
    return _city_flights(t, also, "mes", "mes", "num_voos_reservados")


def _day_city(t: Tables, also: list[str]) -> DataFrame:
    return _city_flights(t, also, "dia_reserva", "data_reserva", "num_reservas")


@_query
def month_city_flights(t: Tables) -> DataFrame:
    return _month_city(t, [])


@_query
def day_city_flights(t: Tables) -> DataFrame:
    return _day_city(t, [])


def _total(t: Tables, also: list[str], how: str = "inner") -> DataFrame:
    by = [*also, *MONTH]
    return combined_revenue(
        rollup(t.hotel_events, t.hotel_dim, by),
        rollup(t.flight_events, t.flight_dim, by),
        by,
        how,
    )


def _ticket(t: Tables, also: list[str]) -> DataFrame:
    return ticket_inputs(_hotel_cities(t, also), _flight_cities(t, also), [*also, *FLIGHT_CITY])


@_query
def total_revenue(t: Tables) -> DataFrame:
    return _total(t, [])


@_query
def total_revenue_full(t: Tables) -> DataFrame:
    """Months with revenue on one side only are kept."""
    return _total(t, [], "full")


@_query
def ticket_inputs_month_groups(t: Tables) -> DataFrame:
    return _ticket(t, [])


@_query
def ticket_inputs_bookings(t: Tables) -> DataFrame:
    """The same with bookings as transactions."""
    return ticket_inputs(
        rollup(t.hotel_events, t.hotel_dim, HOTEL_CITY),
        rollup(t.flight_events, t.flight_dim, FLIGHT_CITY),
        FLIGHT_CITY,
    )


def _cubes(
    t: Tables, also: list[str], batches: str = "true"
) -> tuple[DataFrame, DataFrame]:
    """Both cubes of the `batches`; others are dropped while events are scanned."""
    return (
        hotel_cube(t.hotel_events.where(batches), t.hotel_dim, also),
        flight_cube(t.flight_events.where(batches), t.flight_dim, CITY, also=also),
    )


@_query
def all_statistics_wide(t: Tables) -> DataFrame:
    """All eleven tables side by side, from one pass over each kind of event."""
    return wide_statistics(*_cubes(t, []))


# --- messages and the batch gate -------------------------------------------------------------


def _as_written(events: DataFrame) -> DataFrame:
    """Timestamps as the zone-less text of the messages has them, whatever the session's zone."""
    times = [name for name, kind in events.dtypes if kind == "timestamp"]
    return events.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@_query
def decode_hotel_messages(t: Tables) -> DataFrame:
    return _as_written(usable(decode_hotels(t.messages("id_hotel", "id_reserva_hotel"))))


@_query
def decode_flight_messages(t: Tables) -> DataFrame:
    return _as_written(usable(decode_flights(t.messages("id_voo", "id_reserva_voo"))))


@_query
def decode_rejects(t: Tables) -> DataFrame:
    set_aside = rejects(decode_hotels(t.messages("id_hotel", "id_reserva_hotel")))
    return set_aside.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@_query
def month_hotel_from_messages(t: Tables) -> DataFrame:
    """Messages of all reservations, decoded, joined and aggregated."""
    events = usable(decode_hotels(t.hotel_booking_messages()))
    return rollup(events, t.hotel_dim, MONTH).drop("num_reservas")


@_query
def month_flight_from_messages(t: Tables) -> DataFrame:
    events = usable(decode_flights(t.flight_booking_messages()))
    return rollup(events, t.flight_dim, MONTH).drop("num_reservas")


@_query
def ready_gate(t: Tables) -> DataFrame:
    return gate.readiness(t.pending_messages(), THRESHOLDS)


@_query
def backlog_length(t: Tables) -> DataFrame:
    return gate.backlog(t.pending_messages())


@_query
def backlog_peek(t: Tables) -> DataFrame:
    return gate.peek(t.pending_messages(), "event_id")


# --- partials folded into totals -------------------------------------------------------------


def _folded(name: str, partials: DataFrame) -> DataFrame:
    return fold.fold(stat_table(name), partials)


@_query
def fold_month_hotel(t: Tables) -> DataFrame:
    return _folded("month_hotel", rollup(t.hotel_events, t.hotel_dim, [*BATCH, *MONTH]))


@_query
def fold_city_hotel(t: Tables) -> DataFrame:
    return _folded("city_hotel", rollup(t.hotel_events, t.hotel_dim, [*BATCH, *HOTEL_CITY]))


@_query
def fold_month_flight(t: Tables) -> DataFrame:
    return _folded("month_voos", rollup(t.flight_events, t.flight_dim, [*BATCH, *MONTH]))


@_query
def fold_city_flight(t: Tables) -> DataFrame:
    return _folded("city_voos", rollup(t.flight_events, t.flight_dim, [*BATCH, *FLIGHT_CITY]))


@_query
def fold_month_hotel_count(t: Tables) -> DataFrame:
    return _folded("month_hotel_count", _hotel_counts(t, BATCH))


@_query
def fold_stars_hotel(t: Tables) -> DataFrame:
    return _folded("stars_hotel", _stars(t, BATCH))


@_query
def fold_month_stars(t: Tables) -> DataFrame:
    return _folded("estrelas_medias_mes", _month_stars(t, BATCH))


@_query
def fold_month_city_flights(t: Tables) -> DataFrame:
    return _folded("month_sp_voos", _month_city(t, BATCH))


@_query
def fold_day_city_flights(t: Tables) -> DataFrame:
    return _folded("day_sp_voos", _day_city(t, BATCH))


@_query
def fold_total_revenue(t: Tables) -> DataFrame:
    """Joined batch by batch, so months a batch has on one side only are lost."""
    return _folded("faturamentos_totais", _total(t, BATCH))


@_query
def fold_ticket(t: Tables) -> DataFrame:
    """Joined batch by batch; month groups count once per batch."""
    return _folded("ticket_medio", _ticket(t, BATCH))


@_query
def pending_partials(t: Tables) -> DataFrame:
    wide = wide_statistics(*_cubes(t, BATCH, f"batch_id > {FOLDED_UP_TO}"), also=BATCH)
    return fold.pending_counts(wide, FOLDED_UP_TO)


@_query
def upsert_days(t: Tables) -> DataFrame:
    """New batches folded into totals that stand: days known, new, and without new rows.

    `antes` is the total before, null for a new day.
    """
    table = stat_table("day_sp_voos")
    partials = _day_city(t, BATCH)
    totals = fold.fold(table, partials.where(F.col("batch_id") <= FOLDED_UP_TO))
    after = fold.fold(table, totals, partials.where(F.col("batch_id") > FOLDED_UP_TO))
    keys = ["company_id", *table.keys]
    before = totals.withColumnsRenamed({v: f"antes_{v}" for v in table.values})
    return after.join(before, keys, "left")


CUTS = (1, 7, BATCHES)


def _cut(t: Tables, n: int) -> DataFrame:
    """Changes of the joined totals when the reservations come in `n` batches."""
    cubes = _cubes(t, BATCH)
    chunk = (F.col("batch_id") % n).alias("batch_id")
    hotels, flights = (c.select(*(x for x in c.columns if x not in BATCH), chunk) for c in cubes)
    changes = maintain.changes_by_batch(maintain.sides(hotels, flights, ("batch_id",)))
    return changes.select(F.lit(n).cast("int").alias("cortes"), "*")


def _by_cuts(t: Tables, of: Callable[[DataFrame], DataFrame], table: str, also: list[str]) -> DataFrame:
    changes = reduce(DataFrame.unionByName, (of(_cut(t, n)) for n in CUTS))
    kept = stat_table(table)
    amounts = [F.sum(v) if kind == "bigint" else exact_sum(v) for v, kind in kept.values.items()]
    return changes.groupBy(*also, "company_id", *kept.keys).agg(*(a.alias(v) for a, v in zip(amounts, kept.values)))


@_query
def maintained_total_revenue(t: Tables) -> DataFrame:
    """Total revenue kept up by the changes of each batch, for three ways to cut the batches."""
    return _by_cuts(t, maintain.total_changes, "faturamentos_totais", ["cortes"])


@_query
def maintained_ticket(t: Tables) -> DataFrame:
    """Ticket inputs kept up the same way; a month that comes again is no new month group."""
    return _by_cuts(t, maintain.ticket_changes, "ticket_medio", ["cortes"])


def _folded_distinct(events: DataFrame, dimension: lookup.Dimension, values: list[str], name: str) -> DataFrame:
    """Distinct values per company from bitmaps of each batch, before and after later batches."""
    rows = lookup.enrich(events, dimension.reshaped(lambda d: distinct.numbered(d, dimension.key, values)))
    company = ["company_id"]
    parts = distinct.bitmaps(rows, [*company, *BATCH])
    standing = distinct.merged(company, parts.where(F.col("batch_id") <= FOLDED_UP_TO))
    after = distinct.merged(company, standing, parts.where(F.col("batch_id") > FOLDED_UP_TO))
    before = distinct.counted(standing, company, f"antes_{name}")
    return distinct.counted(after, company, name).join(before, company, "left")


@_query
def folded_distinct_cities(t: Tables) -> DataFrame:
    """Cities with hotel reservations per company."""
    return _folded_distinct(t.hotel_events, t.hotel_dim, ["cidade"], "cidades")


@_query
def folded_distinct_routes(t: Tables) -> DataFrame:
    """Routes with flight reservations per company."""
    return _folded_distinct(t.flight_events, t.flight_dim, ["cidade_origem", "cidade_destino"], "rotas")


# --- reports ---------------------------------------------------------------------------------


@_query
def month_spine_hotel(t: Tables) -> DataFrame:
    return reports.month_report(month_hotel(t), "sum_valor")


@_query
def month_spine_flight(t: Tables) -> DataFrame:
    return reports.month_report(month_flight(t), "sum_valor")


@_query
def month_spine_total(t: Tables) -> DataFrame:
    return reports.month_report(total_revenue(t), "total_valor")


@_query
def month_spine_hotel_count(t: Tables) -> DataFrame:
    return reports.month_report(month_hotel_count(t), "num_hoteis_reservados")


@_query
def month_spine_city_flights(t: Tables) -> DataFrame:
    return reports.month_report(month_city_flights(t), "num_voos_reservados", "mes")


@_query
def month_spine_gaps(t: Tables) -> DataFrame:
    """Months of each route: many have no reservation and are 0."""
    route = ["company_id", "cidade_origem", "cidade_destino"]
    months = rollup(t.flight_events, t.flight_dim, [*route, "mes_reserva"]).drop("num_reservas")
    return reports.month_report(months, "sum_valor", per=route)


@_query
def star_spine(t: Tables) -> DataFrame:
    return reports.star_report(stars_hotel(t))


@_query
def mean_stars_month(t: Tables) -> DataFrame:
    return reports.mean_star_report(month_stars(t))


@_query
def ticket_by_city(t: Tables) -> DataFrame:
    return reports.ticket_report(ticket_inputs_month_groups(t))


def _city_revenue(t: Tables) -> DataFrame:
    return rollup(t.flight_events, t.flight_dim, FLIGHT_CITY).drop("num_reservas")


@_query
def bottom_cities(t: Tables) -> DataFrame:
    return reports.extreme_cities(_city_revenue(t), "cidade_destino", order="asc")


@_query
def top_cities(t: Tables) -> DataFrame:
    return reports.extreme_cities(_city_revenue(t), "cidade_destino", order="desc")


def _spelled_hotel_cities(t: Tables) -> DataFrame:
    """Hotel revenue per city, each spelled in up to three ways that the hotel's key picks."""
    spelling = (
        F.when(F.col("id_hotel") % 3 == 0, F.col("cidade"))
        .when(F.col("id_hotel") % 3 == 1, F.lower("cidade"))
        .otherwise(F.translate("cidade", "AI", "ÃÍ"))
    )
    spelled = t.hotel_dim.reshaped(lambda d: d.withColumn("cidade", spelling))
    return rollup(t.hotel_events, spelled, HOTEL_CITY).drop("num_reservas")


@_query
def city_report(t: Tables) -> DataFrame:
    return reports.city_report(_spelled_hotel_cities(t), mandatory=MANDATORY)


@_query
def missing_cities(t: Tables) -> DataFrame:
    return reports.missing_cities(_spelled_hotel_cities(t), MANDATORY)


@_query
def normalized_city(t: Tables) -> DataFrame:
    """First spelling, by revenue, of each city."""
    cities = _spelled_hotel_cities(t)
    single = ranking.first_per_name(cities, "cidade", ["sum_valor", "cidade"])
    name = normalize_name("cidade").alias("nome")
    return single.select("company_id", name, "cidade", "sum_valor")


@_query
def rolling_mean_7(t: Tables) -> DataFrame:
    return reports.rolling_report(day_city_flights(t))


@_query
def rolling_mean_7_days(t: Tables) -> DataFrame:
    """The same over calendar days instead of rows."""
    return reports.rolling_report(day_city_flights(t), calendar=True)


@_query
def companies(t: Tables) -> DataFrame:
    return reports.clients(month_hotel(t), month_flight(t))


@_query
def read_by_company(t: Tables) -> DataFrame:
    return reports.of_company(month_hotel(t), "F")


@_query
def run_log_page(t: Tables) -> DataFrame:
    return reports.run_log_page(t.run_log())


@_query
def run_log_first_page(t: Tables) -> DataFrame:
    return reports.run_log_page(t.run_log(), limit=25, order="asc")


# --- profiles, integrity, expansion ----------------------------------------------------------


@_query
def star_share(t: Tables) -> DataFrame:
    return profile.star_shares(t.hotels)


@_query
def top_hotel_cities(t: Tables) -> DataFrame:
    return profile.top_hotel_cities(t.hotels)


@_query
def flights_per_month(t: Tables) -> DataFrame:
    return profile.flights_per_month(t.dated_flights)


@_query
def dim_profile_hotel(t: Tables) -> DataFrame:
    return profile.hotel_profile(t.hotels)


@_query
def dim_profile_flight(t: Tables) -> DataFrame:
    return profile.flight_profile(t.dated_flights)


@_query
def calendar_parts(t: Tables) -> DataFrame:
    return profile.calendar_parts(t.read("orders"), "o_orderdate")


@_query
def constraint_violations(t: Tables) -> DataFrame:
    """Both dimensions, and orders as flights: those repeat their key."""
    hotels = checks.violations(t.hotels, checks.HOTEL_RULES, ["id_hotel"], "hoteis")
    flights = checks.violations(t.dated_flights, checks.FLIGHT_RULES, ["id_voo"], "voos")
    stats = checks.violations(
        month_hotel(t), checks.rules_of(STAT_TABLES["stats_month_hotel"]), MONTH, "month_hotel"
    )
    repeated = checks.violations(
        t.flight_events, {"valor_over_1000": "valor > 1000"}, ["id_voo"], "reservas_voo"
    )
    return hotels.union(flights).union(stats).union(repeated)


RESERVATION_RULES = {
    "valor_over_1000": "valor > 1000",
    "empresa_known": "company_id IN ('F', 'O')",
    "year_after_1992": "year(data_reserva) > 1992",
}


@_query
def quarantined_reservations(t: Tables) -> DataFrame:
    """All flight reservations with the rules they break; a flight may be reserved once."""
    rows = t.flight_events.drop("batch_id")
    order = ["data_reserva", "valor", "company_id"]
    judged = quarantine.judged(rows, RESERVATION_RULES, ["id_voo"], order)
    kept, aside = quarantine.split(judged)
    reasons = F.array_join("reasons", ",")
    return kept.withColumn("motivos", F.lit("")).unionByName(
        aside.withColumn("motivos", reasons).drop("reasons")
    )


@_query
def stay_nights(t: Tables) -> DataFrame:
    stays = t.read("lineitem").select(
        F.col("l_orderkey").alias("id_reserva_hotel"),
        F.col("l_linenumber").alias("linha"),
        F.col("l_extendedprice").alias("valor"),
        F.col("l_shipdate").alias("inicio"),
        (F.col("l_linenumber") % 3 + 1).alias("noites"),
    )
    return expand.stay_nights(stays, "inicio", "noites").drop("inicio", "noites")


def _calendar(t: Tables) -> DataFrame:
    """Departures of every route that sold, on each day from its first to its last sale."""
    period = t.written(  # a row per route; the calendar is read twice for its numbers
        lookup.enrich(t.flight_events, t.flight_dim)
        .groupBy("cidade_origem", "cidade_destino")
        .agg(
            F.min("data_reserva").cast("date").alias("first"),
            F.max("data_reserva").cast("date").alias("last"),
        )
    )
    per_day = 1 + F.length(F.concat("cidade_origem", "cidade_destino")) % 2
    flights = expand.departures(period, "first", "last", per_day)
    order = ["cidade_origem", "cidade_destino", "partida"]
    return expand.numbered(flights, "data", order, "id_voo")


@_query
def route_calendar(t: Tables) -> DataFrame:
    """The whole calendar, shown as the flights of each day and origin and their id range."""
    return _calendar(t).groupBy("data", "dia", "mes", "ano", "cidade_origem").agg(
        F.count(F.lit(1)).alias("voos"),
        F.count_distinct("cidade_destino").alias("destinos"),
        F.min("id_voo").alias("primeiro"),
        F.max("id_voo").alias("ultimo"),
        F.sum("id_voo").alias("soma"),
    )


@_query
def star_assign(t: Tables) -> DataFrame:
    """Stars by weight: 10, 15, 35, 25 and 15 percent."""
    bucket = F.col("s_suppkey") % 1000003 * 48271 % 100
    return t.read("supplier").select(
        F.col("s_suppkey").alias("id_hotel"),
        weighted_category(bucket, [1, 2, 3, 4, 5], [10, 15, 35, 25, 15]).alias("estrelas"),
    )
