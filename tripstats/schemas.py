"""The data model: messages, dimensions and the eleven statistic tables."""

from __future__ import annotations

from dataclasses import dataclass

HOTEL_SOURCE = "raw_hotels"
FLIGHT_SOURCE = "raw_flights"

# Messages a source must hold before a batch is processed (fixed values).
DEFAULT_THRESHOLDS = {HOTEL_SOURCE: 50, FLIGHT_SOURCE: 50}

# The city whose flights are tracked, and the cities a city report always names (fixed values).
DEFAULT_CITY = "São Paulo"
MANDATORY_CITIES = ("São Paulo", "Rio de Janeiro", "Belo Horizonte", "Salvador")

ENVELOPE = "company_id STRING, data STRING, timestamp STRING"
# Ids are 64 bits wide: 32 bits end at two billion bookings.
HOTEL_PAYLOAD = (
    "id_reserva_hotel BIGINT, id_hotel BIGINT, valor DOUBLE, data_reservada STRING, "
    "data_reserva STRING"
)
FLIGHT_PAYLOAD = "id_voo BIGINT, id_reserva_voo BIGINT, valor DOUBLE, data_reserva STRING"

HOTEL_DIM = "id_hotel BIGINT, cidade STRING, estrelas INT"
RUN_LOG = (
    "id BIGINT, start_time TIMESTAMP, end_time TIMESTAMP, rows_hotels BIGINT, "
    "rows_flights BIGINT, spark_duration_seconds DOUBLE, db_write_duration_seconds DOUBLE, "
    "created_at TIMESTAMP"
)


@dataclass(frozen=True)
class StatTable:
    """One statistic table: additive `values` (name -> type) under company_id + `keys`."""

    name: str
    keys: dict[str, str]
    values: dict[str, str]

    @property
    def columns(self) -> list[str]:
        return ["company_id", *self.keys, *self.values]


_MONEY, _COUNT = "double", "bigint"

STAT_TABLES: dict[str, StatTable] = {
    t.name: t
    for t in (
        StatTable("stats_month_hotel", {"mes_reserva": "int"}, {"sum_valor": _MONEY}),
        StatTable("stats_city_hotel", {"cidade": "string"}, {"sum_valor": _MONEY}),
        StatTable("stats_month_voos", {"mes_reserva": "int"}, {"sum_valor": _MONEY}),
        StatTable("stats_city_voos", {"cidade_destino": "string"}, {"sum_valor": _MONEY}),
        StatTable("stats_faturamentos_totais", {"mes_reserva": "int"}, {"total_valor": _MONEY}),
        StatTable(
            "stats_ticket_medio",
            {"cidade_destino": "string"},
            {"sum_valor": _MONEY, "num_transacoes": _COUNT},
        ),
        StatTable(
            "stats_month_hotel_count", {"mes_reserva": "int"}, {"num_hoteis_reservados": _COUNT}
        ),
        StatTable("stats_stars_hotel", {"estrelas": "int"}, {"num_reservas": _COUNT}),
        StatTable(
            "stats_estrelas_medias_mes",
            {"mes_reserva": "int"},
            {"sum_estrelas": _COUNT, "num_reservas": _COUNT},
        ),
        StatTable("stats_month_sp_voos", {"mes": "int"}, {"num_voos_reservados": _COUNT}),
        StatTable("stats_day_sp_voos", {"data_reserva": "date"}, {"num_reservas": _COUNT}),
    )
}


def stat_table(name: str) -> StatTable:
    """Registry entry by full ('stats_month_hotel') or short ('month_hotel') name."""
    full = name if name.startswith("stats_") else f"stats_{name}"
    if full not in STAT_TABLES:
        raise KeyError(f"unknown statistic table: {name}")
    return STAT_TABLES[full]


def _columns_of(part: str) -> dict[str, str]:
    return {c: t for table in STAT_TABLES.values() for c, t in getattr(table, part).items()}


# All tables side by side: one row of one table fills its own keys and values, the rest is null.
ALL_KEYS = _columns_of("keys")
ALL_VALUES = _columns_of("values")
WIDE_COLUMNS = {
    "company_id": "string",
    **ALL_KEYS,
    **ALL_VALUES,
    "inserido_em": "timestamp",
    "table": "string",
}
WIDE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in WIDE_COLUMNS.items())
