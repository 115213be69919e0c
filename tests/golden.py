"""A small batch of reservations and the eleven statistics it must give."""

import json

HOTELS = [(1, "São Paulo", 3), (2, "Natal", 5), (3, "Recife", 1)]
FLIGHTS = [(10, "São Paulo", "Natal"), (11, "Natal", "São Paulo"), (12, "Natal", "Recife")]

HOTEL_EVENTS = [
    ("A", 1, 100.0, "2025-01-05"),
    ("A", 1, 50.0, "2025-02-10"),
    ("A", 2, 200.0, "2025-01-07"),
    ("B", 2, 80.0, "2025-03-01"),
    ("A", 99, 999.0, "2025-01-01"),  # no such hotel
]
FLIGHT_EVENTS = [
    ("A", 10, 300.0, "2025-01-05"),
    ("A", 11, 400.0, "2025-01-05"),
    ("A", 12, 500.0, "2025-02-01"),
    ("B", 12, 600.0, "2025-04-01"),
    ("C", 10, 700.0, "2025-01-09"),
]

EXPECTED = {
    "stats_month_hotel": [("A", 1, 300.0), ("A", 2, 50.0), ("B", 3, 80.0)],
    "stats_city_hotel": [("A", "Natal", 200.0), ("A", "São Paulo", 150.0), ("B", "Natal", 80.0)],
    "stats_month_voos": [("A", 1, 700.0), ("A", 2, 500.0), ("B", 4, 600.0), ("C", 1, 700.0)],
    "stats_city_voos": [
        ("A", "Natal", 300.0), ("A", "Recife", 500.0), ("A", "São Paulo", 400.0),
        ("B", "Recife", 600.0), ("C", "Natal", 700.0),
    ],
    "stats_faturamentos_totais": [("A", 1, 1000.0), ("A", 2, 550.0)],
    "stats_ticket_medio": [("A", "Natal", 500.0, 2), ("A", "São Paulo", 550.0, 3)],
    "stats_month_hotel_count": [("A", 1, 2), ("A", 2, 1), ("B", 3, 1)],
    "stats_stars_hotel": [("A", 3, 2), ("A", 5, 1), ("B", 5, 1)],
    "stats_estrelas_medias_mes": [("A", 1, 8, 2), ("A", 2, 3, 1), ("B", 3, 5, 1)],
    "stats_month_sp_voos": [("A", 1, 2), ("C", 1, 1)],
    "stats_day_sp_voos": [("A", "2025-01-05", 2), ("C", "2025-01-09", 1)],
}


def hotel_message(company, hotel, value, day, number=501):
    return _message(company, {
        "id_hotel": hotel, "id_reserva_hotel": number, "valor": value, "data_reservada": day,
        "data_reserva": f"{day}T00:00:00",
    })


def flight_message(company, flight, value, day, number=901):
    return _message(company, {
        "id_voo": flight, "id_reserva_voo": number, "valor": value,
        "data_reserva": f"{day}T00:00:00",
    })


def _message(company, payload, timestamp="2025-01-05T10:00:00"):
    return json.dumps(
        {"company_id": company, "data": json.dumps(payload), "timestamp": timestamp}
    )


def hotel_messages():
    return [hotel_message(*e) for e in HOTEL_EVENTS]


def flight_messages():
    return [flight_message(*e) for e in FLIGHT_EVENTS]


def bad_hotel_messages():
    """Reason to message."""
    payload = {
        "id_hotel": 1, "id_reserva_hotel": 1, "valor": 1.0, "data_reservada": "2025-01-01",
        "data_reserva": "2025-01-01T00:00:00",
    }

    def spoilt(**change):
        return _message("A", payload | change)

    return {
        "envelope_not_json": "bad",
        "company_missing": _message(None, payload),
        "timestamp_missing": json.dumps({"company_id": "A", "data": json.dumps(payload)}),
        "timestamp_invalid": _message("A", payload, "yesterday"),
        "payload_invalid": json.dumps(
            {"company_id": "A", "data": "{no", "timestamp": "2025-01-05T10:00:00"}
        ),
        "id_missing": spoilt(id_hotel=None),
        "value_missing": spoilt(valor=None),
        "date_missing": spoilt(data_reserva=None),
        "date_invalid": spoilt(data_reserva="x"),
    }


def rows(frame, table):
    """Rows of a statistic table in key order, dates as text."""
    return sorted(
        tuple(str(v) if hasattr(v, "isoformat") else v for v in row)
        for row in frame.select(*table.columns).collect()
    )
