"""The registered queries in plain SQL over the given tables, for checking."""

from __future__ import annotations

from tripstats.plans.queries import CITY, FOLDED_UP_TO, MANDATORY, THRESHOLDS
from tripstats.plans.tables import BATCHES
from tripstats.schemas import STAT_TABLES

_VIEWS = {
    "hoteis": """
        SELECT s_suppkey AS id_hotel, n_name AS cidade,
               CAST(1 + s_suppkey % 5 AS INTEGER) AS estrelas
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "voos": """
        SELECT c_custkey AS id_voo, o.n_name AS cidade_origem, d.n_name AS cidade_destino
        FROM customer JOIN nation d ON c_nationkey = d.n_nationkey
        JOIN nation o ON o.n_nationkey = (c_nationkey + 1 + c_custkey % 24) % 25""",
    "voos_data": """
        SELECT *, CAST(id_voo % 31 + 1 AS INTEGER) AS dia, CAST(id_voo % 12 + 1 AS INTEGER) AS mes,
               CAST(id_voo % 3 + 2024 AS INTEGER) AS ano FROM voos""",
    "eh": f"""
        SELECT l_linestatus AS company_id, l_suppkey AS id_hotel, l_extendedprice AS valor,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS v, l_shipdate AS data_reserva,
               CAST(month(l_shipdate) AS INTEGER) AS mes_reserva, l_orderkey % {BATCHES} AS lote
        FROM lineitem""",
    "ev": f"""
        SELECT o_orderstatus AS company_id, o_custkey AS id_voo, o_totalprice AS valor,
               CAST(o_totalprice AS DECIMAL(18,2)) AS v, o_orderdate AS data_reserva,
               CAST(month(o_orderdate) AS INTEGER) AS mes_reserva, o_orderkey % {BATCHES} AS lote
        FROM orders""",
    "jh": "SELECT * FROM eh JOIN hoteis USING (id_hotel)",
    "jv": "SELECT * FROM ev JOIN voos USING (id_voo)",
    "sp": f"SELECT * FROM jv WHERE cidade_origem = '{CITY}' OR cidade_destino = '{CITY}'",
    # Statistics with exact sums `s`; `n` bookings, `g` month groups.
    "hm": "SELECT company_id, mes_reserva, sum(v) AS s, count(*) AS n FROM jh GROUP BY ALL",
    "vm": "SELECT company_id, mes_reserva, sum(v) AS s, count(*) AS n FROM jv GROUP BY ALL",
    "hc": """
        SELECT company_id, cidade, sum(v) AS s, count(*) AS n, count(DISTINCT mes_reserva) AS g
        FROM jh GROUP BY ALL""",
    "vc": """
        SELECT company_id, cidade_destino, sum(v) AS s, count(*) AS n,
               count(DISTINCT mes_reserva) AS g
        FROM jv GROUP BY ALL""",
    "tot": """
        SELECT hm.company_id, hm.mes_reserva, hm.s + vm.s AS s
        FROM hm JOIN vm ON hm.company_id = vm.company_id AND hm.mes_reserva = vm.mes_reserva""",
    "tk": """
        SELECT hc.company_id, cidade_destino, hc.s + vc.s AS s, hc.g + vc.g AS g, hc.n + vc.n AS n
        FROM hc JOIN vc ON hc.company_id = vc.company_id AND cidade = cidade_destino""",
    "st": "SELECT company_id, estrelas, count(*) AS n FROM jh GROUP BY ALL",
    "ms": """
        SELECT company_id, mes_reserva, sum(estrelas) AS e, count(*) AS n FROM jh GROUP BY ALL""",
    "sm": "SELECT company_id, mes_reserva AS mes, count(*) AS n FROM sp GROUP BY ALL",
    "sd": """
        SELECT company_id, CAST(data_reserva AS DATE) AS data_reserva, count(*) AS n
        FROM sp GROUP BY ALL""",
    "mb": f"""
        SELECT unnest([{", ".join(f"'{c}'" for c in MANDATORY)}]) AS nome,
               generate_subscripts([{", ".join(f"'{c}'" for c in MANDATORY)}], 1) AS lugar""",
    "hs": """
        SELECT company_id, CASE id_hotel % 3 WHEN 0 THEN cidade WHEN 1 THEN lower(cidade)
               ELSE translate(cidade, 'AI', 'ÃÍ') END AS cidade,
               CAST(sum(v) AS DOUBLE) AS sum_valor
        FROM jh GROUP BY ALL""",
    "msgs": """
        SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "fila": """
        SELECT CASE WHEN event_type IN ('view', 'click') THEN 'raw_hotels'
                    ELSE 'raw_flights' END AS source, event_id, props AS value FROM events""",
    "runs": """
        SELECT date_trunc('hour', ts) AS created_at, min(event_id) AS id, min(ts) AS start_time,
               max(ts) AS end_time,
               count(*) FILTER (event_type IN ('view', 'click')) AS rows_hotels,
               count(*) FILTER (event_type NOT IN ('view', 'click')) AS rows_flights,
               max(value) AS spark_duration_seconds, min(value) AS db_write_duration_seconds
        FROM events GROUP BY 1""",
}
_USES = {
    "voos_data": ["voos"], "jh": ["eh", "hoteis"], "jv": ["ev", "voos"], "sp": ["jv"],
    "hm": ["jh"], "vm": ["jv"], "hc": ["jh"], "vc": ["jv"], "tot": ["hm", "vm"],
    "tk": ["hc", "vc"], "st": ["jh"], "ms": ["jh"], "sm": ["sp"], "sd": ["sp"], "hs": ["jh"],
}
_ORDER = list(_VIEWS)


def _sql(body: str, *views: str) -> str:
    """`body` behind the views it uses, directly or through other views."""
    needed, queue = set(), list(views)
    while queue:
        view = queue.pop()
        if view not in needed:
            needed.add(view)
            queue += _USES.get(view, [])
    parts = [f"{v} AS ({_VIEWS[v].strip()})" for v in _ORDER if v in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()


def _double(column: str, alias: str) -> str:
    return f"CAST({column} AS DOUBLE) AS {alias}"


def _big(column: str, alias: str) -> str:
    return f"CAST({column} AS BIGINT) AS {alias}"


def _spine(
    view: str, column: str, zero: str, kind: str, name: str, key: str = "mes_reserva"
) -> str:
    return f"""
        SELECT c.company_id, CAST(m AS INTEGER) AS month_num,
               strftime(make_date(2000, m, 1), '%b') AS month_name,
               CAST(coalesce({column}, {zero}) AS {kind}) AS {name}
        FROM (SELECT DISTINCT company_id FROM {view}) c CROSS JOIN range(1, 13) r(m)
        LEFT JOIN {view} x ON x.company_id = c.company_id AND x.{key} = m"""


_NORM = "lower(strip_accents({}))"

_HOTEL_MSG = """
    SELECT event_type AS company_id, ts AS event_timestamp, CAST(k AS BIGINT) AS {id},
           value AS valor, {extra}ts AS data_reserva, event_id AS {booking}
    FROM msgs WHERE k > 7"""


def _wide() -> str:
    keys = {c: t for s in STAT_TABLES.values() for c, t in s.keys.items()}
    values = {c: t for s in STAT_TABLES.values() for c, t in s.values.items()}
    types = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
             "date": "DATE"}
    source = {
        "stats_month_hotel": ("hm", {"sum_valor": "s"}),
        "stats_city_hotel": ("hc", {"sum_valor": "s"}),
        "stats_month_voos": ("vm", {"sum_valor": "s"}),
        "stats_city_voos": ("vc", {"sum_valor": "s"}),
        "stats_faturamentos_totais": ("tot", {"total_valor": "s"}),
        "stats_ticket_medio": ("tk", {"sum_valor": "s", "num_transacoes": "g"}),
        "stats_month_hotel_count": ("hm", {"num_hoteis_reservados": "n"}),
        "stats_stars_hotel": ("st", {"num_reservas": "n"}),
        "stats_estrelas_medias_mes": ("ms", {"sum_estrelas": "e", "num_reservas": "n"}),
        "stats_month_sp_voos": ("sm", {"num_voos_reservados": "n"}),
        "stats_day_sp_voos": ("sd", {"num_reservas": "n"}),
    }
    parts = []
    for name, (view, filled) in source.items():
        spec = STAT_TABLES[name]
        columns = ["company_id"]
        for c, t in keys.items():
            columns.append(f"CAST({c if c in spec.keys else 'NULL'} AS {types[t]}) AS {c}")
        for c, t in values.items():
            columns.append(f"CAST({filled.get(c, 'NULL')} AS {types[t]}) AS {c}")
        parts.append(f"SELECT {', '.join(columns)}, '{name}' AS \"table\" FROM {view}")
    return _sql(" UNION ALL ".join(parts), *dict.fromkeys(v for v, _ in source.values()))


def _pending() -> str:
    later = f"lote > {FOLDED_UP_TO}"
    groups = {
        "stats_month_hotel": ("jh", "mes_reserva"),
        "stats_city_hotel": ("jh", "cidade"),
        "stats_month_voos": ("jv", "mes_reserva"),
        "stats_city_voos": ("jv", "cidade_destino"),
        "stats_month_hotel_count": ("jh", "mes_reserva"),
        "stats_stars_hotel": ("jh", "estrelas"),
        "stats_estrelas_medias_mes": ("jh", "mes_reserva"),
        "stats_month_sp_voos": ("sp", "mes_reserva"),
        "stats_day_sp_voos": ("sp", "CAST(data_reserva AS DATE)"),
    }
    parts = [
        f"SELECT '{name}' AS \"table\", count(*) AS pending FROM "
        f"(SELECT DISTINCT lote, company_id, {key} FROM {view} WHERE {later})"
        for name, (view, key) in groups.items()
    ]
    both = {
        "stats_faturamentos_totais": ("mes_reserva", "mes_reserva"),
        "stats_ticket_medio": ("cidade", "cidade_destino"),
    }
    parts += [
        f"SELECT '{name}', count(*) FROM (SELECT lote, company_id, {h} FROM jh WHERE {later} "
        f"INTERSECT SELECT lote, company_id, {v} FROM jv WHERE {later})"
        for name, (h, v) in both.items()
    ]
    return _sql(" UNION ALL ".join(parts), "jh", "jv", "sp")


def _violations() -> str:
    def rows(table: str, view: str, key: str, rules: dict[str, str]) -> list[str]:
        checks = [
            f"SELECT '{table}' AS \"table\", '{rule}' AS rule, "
            f"CAST(count(*) FILTER (NOT ({condition})) AS BIGINT) AS violations FROM {view}"
            for rule, condition in rules.items()
        ]
        return checks + [
            f"SELECT '{table}', 'key_unique', count(*) FROM "
            f"(SELECT {key} FROM {view} GROUP BY {key} HAVING count(*) > 1)"
        ]

    parts = rows("hoteis", "hoteis", "id_hotel", {
        "id_hotel_not_null": "id_hotel IS NOT NULL", "cidade_not_null": "cidade IS NOT NULL",
        "estrelas_1_to_5": "estrelas BETWEEN 1 AND 5"})
    parts += rows("voos", "voos_data", "id_voo", {
        "id_voo_not_null": "id_voo IS NOT NULL",
        "cidade_origem_not_null": "cidade_origem IS NOT NULL",
        "cidade_destino_not_null": "cidade_destino IS NOT NULL",
        "origem_differs": "cidade_origem <> cidade_destino", "dia_1_to_31": "dia BETWEEN 1 AND 31", "mes_1_to_12": "mes BETWEEN 1 AND 12",
        "ano_positive": "ano > 0"})
    parts += rows("month_hotel", "hm", "company_id, mes_reserva", {
        "company_id_not_null": "company_id IS NOT NULL",
        "mes_reserva_not_null": "mes_reserva IS NOT NULL", "sum_valor_not_null": "s IS NOT NULL"})
    parts += rows("reservas_voo", "ev", "id_voo", {"valor_over_1000": "valor > 1000"})
    return _sql(" UNION ALL ".join(parts), "hoteis", "voos_data", "hm", "ev")


_CITY_REPORT = f"""
    , faltam AS (
        SELECT c.company_id, nome AS cidade, 0.0::DOUBLE AS sum_valor
        FROM (SELECT DISTINCT company_id FROM hs) c CROSS JOIN mb
        WHERE NOT EXISTS (SELECT 1 FROM hs WHERE hs.company_id = c.company_id
                          AND {_NORM.format("hs.cidade")} = {_NORM.format("nome")})),
    todas AS (SELECT company_id, cidade, sum_valor FROM hs UNION ALL SELECT * FROM faltam),
    ordem AS (SELECT *, row_number() OVER (PARTITION BY company_id
                                           ORDER BY sum_valor, cidade) AS p FROM todas),
    vez AS (
        SELECT company_id, cidade, sum_valor, 0 AS tarde, p FROM ordem WHERE p <= 10
        UNION ALL
        SELECT company_id, cidade, sum_valor, 1, (SELECT min(lugar) FROM mb
               WHERE {_NORM.format("nome")} = {_NORM.format("cidade")}) FROM todas
        WHERE {_NORM.format("cidade")} IN (SELECT {_NORM.format("nome")} FROM mb)),
    uma AS (SELECT *, row_number() OVER (PARTITION BY company_id, {_NORM.format("cidade")}
                                         ORDER BY tarde, p, sum_valor, cidade) AS q FROM vez),
    fim AS (SELECT company_id, cidade, sum_valor, CAST(row_number() OVER (
                   PARTITION BY company_id ORDER BY tarde, p, sum_valor, cidade) AS INTEGER)
                   AS posicao FROM uma WHERE q = 1)
"""


def _per_batch(views: str) -> str:
    """Statistics per batch, the inputs of the two tables that depend on how batches are cut."""
    return {
        "month": """
            SELECT company_id, mes_reserva, CAST(sum(h.s + v.s) AS DOUBLE) AS total_valor
            FROM (SELECT lote, company_id, mes_reserva, sum(v) AS s FROM jh GROUP BY ALL) h
            JOIN (SELECT lote, company_id, mes_reserva, sum(v) AS s FROM jv GROUP BY ALL) v
            USING (lote, company_id, mes_reserva) GROUP BY ALL""",
        "city": """
            SELECT company_id, cidade_destino, CAST(sum(h.s + v.s) AS DOUBLE) AS sum_valor,
                   CAST(sum(h.g + v.g) AS BIGINT) AS num_transacoes
            FROM (SELECT lote, company_id, cidade AS cidade_destino, sum(v) AS s,
                         count(DISTINCT mes_reserva) AS g FROM jh GROUP BY ALL) h
            JOIN (SELECT lote, company_id, cidade_destino, sum(v) AS s,
                         count(DISTINCT mes_reserva) AS g FROM jv GROUP BY ALL) v
            USING (lote, company_id, cidade_destino) GROUP BY ALL""",
    }[views]


def registered() -> dict[str, str]:
    month = "company_id, mes_reserva"
    day_counts = f"SELECT company_id, data_reserva, {_big('n', 'num_reservas')} FROM sd"
    sql = {
        "join_hotel": _sql(
            "SELECT id_hotel, company_id, valor, data_reserva, cidade, estrelas FROM jh", "jh"),
        "join_flight": _sql(
            "SELECT id_voo, company_id, valor, data_reserva, cidade_origem, cidade_destino FROM jv",
            "jv"),
        "join_drops_unknown": _sql(
            f"""SELECT {month}, {_double('sum(v)', 'sum_valor')}, count(*) AS num_reservas
            FROM jh JOIN supplier ON s_suppkey = id_hotel WHERE s_acctbal >= 0
            GROUP BY ALL""", "jh"),
        "dim_semi_join": _sql(
            """SELECT id_voo, cidade_origem, cidade_destino FROM voos
            WHERE id_voo IN (SELECT id_voo FROM ev)""", "voos", "ev"),
        "city_filter_flights": _sql(
            "SELECT id_voo, company_id, valor, data_reserva, cidade_origem, cidade_destino FROM sp",
            "sp"),
        "city_filter_any_spelling": _sql(
            """SELECT company_id, CASE id_voo % 3 WHEN 0 THEN cidade_origem
                 WHEN 1 THEN lower(cidade_origem) ELSE translate(cidade_origem, 'AI', 'ÃÍ') END
                 AS cidade_origem, cidade_destino, count(*) AS num_voos_reservados
            FROM sp GROUP BY ALL""", "sp"),
        "city_month_hotel": _sql(
            f"SELECT company_id, cidade, mes_reserva, {_double('sum(v)', 'sum_valor')} "
            "FROM jh GROUP BY ALL", "jh"),
        "city_month_flight": _sql(
            f"SELECT company_id, cidade_destino, mes_reserva, {_double('sum(v)', 'sum_valor')} "
            "FROM jv GROUP BY ALL", "jv"),
        "month_hotel": _sql(f"SELECT {month}, {_double('s', 'sum_valor')} FROM hm", "hm"),
        "month_flight": _sql(f"SELECT {month}, {_double('s', 'sum_valor')} FROM vm", "vm"),
        "year_month_hotel": _sql(
            f"""SELECT company_id, CAST(year(data_reserva) AS INTEGER) AS ano_reserva, mes_reserva,
            {_double('sum(v)', 'sum_valor')}, count(*) AS num_reservas FROM jh GROUP BY ALL""",
            "jh"),
        "city_hotel": _sql(
            f"SELECT company_id, cidade, {_double('s', 'sum_valor')}, g AS num_reservas FROM hc",
            "hc"),
        "city_flight": _sql(
            f"SELECT company_id, cidade_destino, {_double('s', 'sum_valor')}, g AS num_reservas "
            "FROM vc", "vc"),
        "month_hotel_count": _sql(f"SELECT {month}, n AS num_hoteis_reservados FROM hm", "hm"),
        "stars_hotel": _sql("SELECT company_id, estrelas, n AS num_reservas FROM st", "st"),
        "month_stars": _sql(
            f"SELECT {month}, {_big('e', 'sum_estrelas')}, n AS num_reservas FROM ms", "ms"),
        "month_city_flights": _sql(
            "SELECT mes, company_id, n AS num_voos_reservados FROM sm", "sm"),
        "day_city_flights": _sql(day_counts, "sd"),
        "total_revenue": _sql(f"SELECT {month}, {_double('s', 'total_valor')} FROM tot", "tot"),
        "total_revenue_full": _sql(
            f"""SELECT {month}, {_double('coalesce(hm.s, 0) + coalesce(vm.s, 0)', 'total_valor')}
            FROM hm FULL JOIN vm USING (company_id, mes_reserva)""", "hm", "vm"),
        "ticket_inputs_month_groups": _sql(
            f"SELECT company_id, cidade_destino, {_double('s', 'sum_valor')}, g AS num_transacoes "
            "FROM tk", "tk"),
        "ticket_inputs_bookings": _sql(
            f"SELECT company_id, cidade_destino, {_double('s', 'sum_valor')}, n AS num_transacoes "
            "FROM tk", "tk"),
        "all_statistics_wide": _wide(),
        "decode_hotel_messages": _sql(
            _HOTEL_MSG.format(
                id="id_hotel", booking="id_reserva_hotel",
                extra="CAST(CAST(ts AS DATE) + k AS TIMESTAMP) AS data_reservada, "), "msgs"),
        "decode_flight_messages": _sql(
            _HOTEL_MSG.format(id="id_voo", booking="id_reserva_voo", extra=""), "msgs"),
        "decode_rejects": _sql(
            """SELECT CASE k WHEN 0 THEN 'envelope_not_json' WHEN 1 THEN 'timestamp_missing'
                      WHEN 2 THEN 'timestamp_invalid' WHEN 3 THEN 'payload_invalid'
                      WHEN 4 THEN 'id_missing' WHEN 5 THEN 'value_missing'
                      WHEN 6 THEN 'date_invalid' ELSE 'company_missing' END AS reason,
               count(*) AS messages FROM msgs WHERE k <= 7 GROUP BY ALL""", "msgs"),
        "month_hotel_from_messages": _sql(
            f"SELECT {month}, {_double('s', 'sum_valor')} FROM hm", "hm"),
        "month_flight_from_messages": _sql(
            f"SELECT {month}, {_double('s', 'sum_valor')} FROM vm", "vm"),
        "ready_gate": _sql(
            "SELECT source, count(event_id) AS pending, CAST(threshold AS BIGINT) AS threshold, "
            "count(event_id) >= threshold AS source_ready, "
            "bool_and(count(event_id) >= threshold) OVER () AS batch_ready FROM (VALUES "
            + ", ".join(f"('{s}', {n})" for s, n in THRESHOLDS.items())
            + ") w(source, threshold) LEFT JOIN fila USING (source) GROUP BY source, threshold",
            "fila"),
        "backlog_length": _sql("SELECT source, count(*) AS pending FROM fila GROUP BY ALL", "fila"),
        "backlog_peek": _sql(
            """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source
               ORDER BY event_id) AS INTEGER) AS position FROM fila) WHERE position <= 6""",
            "fila"),
        "fold_total_revenue": _sql(_per_batch("month"), "jh", "jv"),
        "fold_ticket": _sql(_per_batch("city"), "jh", "jv"),
        "maintained_total_revenue": _sql(
            f"""SELECT CAST(c AS INTEGER) AS cortes, company_id, mes_reserva, {_double('s', 'total_valor')}
            FROM tot, (SELECT unnest([1, 7, {BATCHES}]) AS c)""", "tot"),
        "maintained_ticket": _sql(
            f"""SELECT CAST(c AS INTEGER) AS cortes, company_id, cidade_destino,
               {_double('s', 'sum_valor')}, g AS num_transacoes
            FROM tk, (SELECT unnest([1, 7, {BATCHES}]) AS c)""", "tk"),
        "pending_partials": _pending(),
        "upsert_days": _sql(
            f"""SELECT company_id, CAST(data_reserva AS DATE) AS data_reserva,
               count(*) AS num_reservas,
               nullif(count(*) FILTER (lote <= {FOLDED_UP_TO}), 0) AS antes_num_reservas
            FROM sp GROUP BY ALL""", "sp"),
        "month_spine_hotel": _sql(_spine("hm", "s", "0", "DOUBLE", "sum_valor"), "hm"),
        "month_spine_flight": _sql(_spine("vm", "s", "0", "DOUBLE", "sum_valor"), "vm"),
        "month_spine_total": _sql(_spine("tot", "s", "0", "DOUBLE", "total_valor"), "tot"),
        "month_spine_hotel_count": _sql(
            _spine("hm", "n", "0", "BIGINT", "num_hoteis_reservados"), "hm"),
        "month_spine_city_flights": _sql(
            _spine("sm", "n", "0", "BIGINT", "num_voos_reservados", "mes"), "sm"),
        "month_spine_gaps": _sql(
            """, rotas AS (SELECT company_id, cidade_origem, cidade_destino, mes_reserva, sum(v) AS s
                 FROM jv GROUP BY ALL)
            SELECT c.*, CAST(m AS INTEGER) AS month_num,
               strftime(make_date(2000, m, 1), '%b') AS month_name,
               CAST(coalesce(s, 0) AS DOUBLE) AS sum_valor
            FROM (SELECT DISTINCT company_id, cidade_origem, cidade_destino FROM rotas) c
            CROSS JOIN range(1, 13) r(m) LEFT JOIN rotas x ON x.company_id = c.company_id
            AND x.cidade_origem = c.cidade_origem AND x.cidade_destino = c.cidade_destino
            AND x.mes_reserva = m""", "jv"),
        "star_spine": _sql(
            """SELECT c.company_id, CAST(e AS INTEGER) AS estrelas,
               CAST(coalesce(n, 0) AS BIGINT) AS num_reservas
            FROM (SELECT DISTINCT company_id FROM st) c CROSS JOIN range(1, 6) r(e)
            LEFT JOIN st ON st.company_id = c.company_id AND st.estrelas = e""", "st"),
        "mean_stars_month": _sql(
            """SELECT c.company_id, CAST(m AS INTEGER) AS month_num,
               strftime(make_date(2000, m, 1), '%b') AS month_name,
               CASE WHEN coalesce(n, 0) = 0 THEN 0.0::DOUBLE
                    ELSE CAST(e AS DOUBLE) / CAST(n AS DOUBLE) END AS media_estrelas
            FROM (SELECT DISTINCT company_id FROM ms) c CROSS JOIN range(1, 13) r(m)
            LEFT JOIN ms ON ms.company_id = c.company_id AND mes_reserva = m""", "ms"),
        "ticket_by_city": _sql(
            """SELECT company_id, cidade_destino,
               CAST(s AS DOUBLE) / CAST(g AS DOUBLE) AS ticket_medio FROM tk""", "tk"),
        "city_report": _sql(
            _CITY_REPORT + "SELECT * FROM fim WHERE posicao <= 10", "hs", "mb"),
        "missing_cities": _sql(
            _CITY_REPORT + "SELECT company_id, cidade FROM faltam", "hs", "mb"),
        "normalized_city": _sql(
            f"""SELECT company_id, nome, cidade, sum_valor FROM (
                SELECT *, {_NORM.format('cidade')} AS nome, row_number() OVER (
                    PARTITION BY company_id, {_NORM.format('cidade')}
                    ORDER BY sum_valor, cidade) AS q FROM hs) WHERE q = 1""", "hs"),
        "rolling_mean_7": _sql(
            """SELECT company_id, data_reserva, avg(n) OVER (PARTITION BY company_id
               ORDER BY data_reserva ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
               AS media_movel_7dias FROM sd""", "sd"),
        "rolling_mean_7_days": _sql(
            """SELECT company_id, data_reserva, avg(n) OVER (PARTITION BY company_id
               ORDER BY data_reserva RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
               AS media_movel_7dias FROM sd""", "sd"),
        "companies": _sql(
            """SELECT company_id FROM hm WHERE company_id IS NOT NULL
               UNION SELECT company_id FROM vm WHERE company_id IS NOT NULL""", "hm", "vm"),
        "read_by_company": _sql(
            f"SELECT {month}, {_double('s', 'sum_valor')} FROM hm WHERE company_id = 'F'", "hm"),
        "run_log_page": _sql("SELECT * FROM runs ORDER BY start_time DESC, id LIMIT 100", "runs"),
        "run_log_first_page": _sql("SELECT * FROM runs ORDER BY start_time, id LIMIT 25", "runs"),
        "star_share": _sql(
            """SELECT estrelas, count(*) AS total,
               round(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), 1) AS percentual
            FROM hoteis GROUP BY estrelas""", "hoteis"),
        "top_hotel_cities": _sql(
            """SELECT cidade, count(*) AS total_hoteis FROM hoteis GROUP BY cidade
            ORDER BY total_hoteis DESC, cidade LIMIT 10""", "hoteis"),
        "flights_per_month": _sql(
            "SELECT mes, count(*) AS total_voos FROM voos_data GROUP BY mes", "voos_data"),
        "dim_profile_hotel": _sql(
            """SELECT count(*) AS hoteis, count(DISTINCT cidade) AS cidades,
               CAST(count(*) AS DOUBLE) / count(DISTINCT cidade) AS hoteis_por_cidade
            FROM hoteis""", "hoteis"),
        "dim_profile_flight": _sql(
            """SELECT count(*) AS voos, count(DISTINCT (cidade_origem, cidade_destino)) AS rotas,
               count(DISTINCT (ano, mes, dia)) AS dias,
               CAST(count(*) AS DOUBLE) / count(DISTINCT (ano, mes, dia)) AS voos_por_dia
            FROM voos_data""", "voos_data"),
        "calendar_parts": """
            SELECT DISTINCT CAST(o_orderdate AS DATE) AS data,
                   strftime(o_orderdate, '%Y-%m-%d') AS texto,
                   CAST(day(o_orderdate) AS INTEGER) AS dia,
                   CAST(month(o_orderdate) AS INTEGER) AS mes,
                   CAST(year(o_orderdate) AS INTEGER) AS ano,
                   isodow(o_orderdate) >= 6 AS fim_de_semana
            FROM orders""",
        "constraint_violations": _violations(),
        "stay_nights": """
            SELECT l_orderkey AS id_reserva_hotel, l_linenumber AS linha, l_extendedprice AS valor,
                   CAST(n AS INTEGER) AS noite,
                   CAST(l_shipdate AS DATE) + CAST(n AS INTEGER) AS data_reservada
            FROM lineitem, range(0, 3) r(n) WHERE n <= l_linenumber % 3""",
        "quarantined_reservations": _sql(
            """, regras AS (SELECT company_id, id_voo, valor, data_reserva, concat_ws(',',
                 CASE WHEN NOT valor > 1000 THEN 'valor_over_1000' END,
                 CASE WHEN company_id NOT IN ('F', 'O') THEN 'empresa_known' END,
                 CASE WHEN NOT year(data_reserva) > 1992 THEN 'year_after_1992' END) AS m FROM ev)
            SELECT company_id, id_voo, valor, data_reserva, CASE WHEN m = '' AND row_number() OVER (
                   PARTITION BY id_voo ORDER BY m <> '', data_reserva, valor, company_id) > 1
                 THEN 'key_unique' ELSE m END AS motivos FROM regras""", "ev"),
        "folded_distinct_cities": _sql(
            f"""SELECT company_id, count(DISTINCT cidade) AS cidades,
               nullif(count(DISTINCT cidade) FILTER (lote <= {FOLDED_UP_TO}), 0) AS antes_cidades
            FROM jh GROUP BY company_id""", "jh"),
        "folded_distinct_routes": _sql(
            f"""SELECT company_id, count(DISTINCT (cidade_origem, cidade_destino)) AS rotas,
               nullif(count(DISTINCT (cidade_origem, cidade_destino)) FILTER (lote <= {FOLDED_UP_TO}), 0)
                 AS antes_rotas
            FROM jv GROUP BY company_id""", "jv"),
        "route_calendar": _sql(
            """, rotas AS (SELECT cidade_origem, cidade_destino,
                      CAST(min(data_reserva) AS DATE) AS a, CAST(max(data_reserva) AS DATE) AS z
                      FROM jv GROUP BY ALL),
               dias AS (SELECT cidade_origem, cidade_destino, CAST(unnest(generate_series(
                      a, z, INTERVAL 1 DAY)) AS DATE) AS data FROM rotas
                      WHERE cidade_origem <> cidade_destino)
            SELECT data, CAST(day(data) AS INTEGER) AS dia, CAST(month(data) AS INTEGER) AS mes,
                   CAST(year(data) AS INTEGER) AS ano, cidade_origem, count(*) AS voos,
                   count(DISTINCT cidade_destino) AS destinos, min(id_voo) AS primeiro,
                   max(id_voo) AS ultimo, CAST(sum(id_voo) AS BIGINT) AS soma
            FROM (SELECT data, cidade_origem, cidade_destino, row_number() OVER (
                      ORDER BY data, cidade_origem, cidade_destino, p) AS id_voo
                  FROM dias, range(1, 3) r(p)
                  WHERE p <= 1 + length(cidade_origem || cidade_destino) % 2)
            GROUP BY ALL""", "jv"),
        "star_assign": """
            SELECT s_suppkey AS id_hotel, CAST(CASE WHEN b < 10 THEN 1 WHEN b < 25 THEN 2
                   WHEN b < 60 THEN 3 WHEN b < 85 THEN 4 ELSE 5 END AS INTEGER) AS estrelas
            FROM (SELECT s_suppkey, s_suppkey % 1000003 * 48271 % 100 AS b FROM supplier)""",
    }
    for name, direction in (("bottom_cities", "ASC"), ("top_cities", "DESC")):
        sql[name] = _sql(
            f"""SELECT * FROM (SELECT company_id, cidade_destino, {_double('s', 'sum_valor')},
                CAST(row_number() OVER (PARTITION BY company_id ORDER BY s {direction},
                cidade_destino) AS INTEGER) AS posicao FROM vc) WHERE posicao <= 10""", "vc")
    # Folding does not change these nine: the sum over batches is the sum.
    for folded, whole in {
        "fold_month_hotel": "month_hotel", "fold_month_flight": "month_flight",
        "fold_month_hotel_count": "month_hotel_count", "fold_stars_hotel": "stars_hotel",
        "fold_month_stars": "month_stars", "fold_month_city_flights": "month_city_flights",
        "fold_day_city_flights": "day_city_flights",
    }.items():
        sql[folded] = sql[whole]
    sql["fold_city_hotel"] = _sql(
        f"SELECT company_id, cidade, {_double('s', 'sum_valor')} FROM hc", "hc")
    sql["fold_city_flight"] = _sql(
        f"SELECT company_id, cidade_destino, {_double('s', 'sum_valor')} FROM vc", "vc")
    return sql
