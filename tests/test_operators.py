"""Operators against small tables and plain Python."""

import datetime
import random
import unicodedata

import golden
import pytest
from pyspark.sql import functions as F

from tripstats.functions import (
    exact_add, exact_sum, month_name, normalize_name, safe_ratio, weighted_category,
)
from tripstats.operators.lookup import (
    Dimension, enrich, flights_of_city, measured_bytes, rows_in_use, with_current_names,
)
from tripstats.operators.rollup import flight_cube, hotel_cube, rollup
from tripstats.operators.statistics import (
    all_statistics, city_revenue, combined_revenue, ticket_inputs,
)
from tripstats.plans import reports
from tripstats.schemas import STAT_TABLES
from tripstats.session import shuffle_width
from tripstats.sources import dimensions
from tripstats.sources.messages import decode_hotels, rejects, usable

HOTEL = "id_hotel INT, cidade STRING, estrelas INT"
FLIGHT = "id_voo INT, cidade_origem STRING, cidade_destino STRING"


def dated(spark, events, key):
    frame = spark.createDataFrame(events, f"company_id STRING, {key} INT, valor DOUBLE, d STRING")
    return frame.withColumn("data_reserva", F.to_timestamp("d")).drop("d")


@pytest.fixture(scope="module")
def golden_frames(spark):
    return (
        dated(spark, golden.HOTEL_EVENTS, "id_hotel"),
        dated(spark, golden.FLIGHT_EVENTS, "id_voo"),
        spark.createDataFrame(golden.HOTELS, HOTEL),
        spark.createDataFrame(golden.FLIGHTS, FLIGHT),
    )


@pytest.mark.parametrize("small", [True, False])
def test_golden_statistics_with_either_join_strategy(golden_frames, small):
    hotel_events, flight_events, hotels, flights = golden_frames
    cubes = (
        hotel_cube(hotel_events, Dimension(hotels, "id_hotel", small)),
        flight_cube(flight_events, Dimension(flights, "id_voo", small), "São Paulo"),
    )
    result = all_statistics(*cubes)
    assert {n: golden.rows(f, STAT_TABLES[n]) for n, f in result.items()} == golden.EXPECTED


def test_join_of_aggregates_equals_one_aggregation(golden_frames):
    hotel_events, flight_events, hotels, flights = golden_frames
    hotel_dim, flight_dim = Dimension(hotels, "id_hotel", True), Dimension(flights, "id_voo", True)
    for how in ("inner", "full"):
        together = all_statistics(
            hotel_cube(hotel_events, hotel_dim),
            flight_cube(flight_events, flight_dim, "São Paulo"),
            how=how,
        )
        month, city = ["company_id", "mes_reserva"], ["company_id", "cidade_destino"]
        total = combined_revenue(
            rollup(hotel_events, hotel_dim, month), rollup(flight_events, flight_dim, month),
            month, how,
        )
        ticket = ticket_inputs(
            city_revenue(
                rollup(hotel_events, hotel_dim, ["company_id", "cidade", "mes_reserva"]),
                ["company_id", "cidade"],
            ),
            city_revenue(rollup(flight_events, flight_dim, [*city, "mes_reserva"]), city),
            city, how,
        )
        for name, frame in (("stats_faturamentos_totais", total), ("stats_ticket_medio", ticket)):
            table = STAT_TABLES[name]
            assert golden.rows(frame, table) == golden.rows(together[name], table)
    with pytest.raises(ValueError):
        all_statistics(hotels, flights, how="left")


def test_years_can_be_kept_apart(spark, golden_frames):
    _, _, hotels, _ = golden_frames
    events = dated(spark, [("A", 1, 1.0, "2024-01-05"), ("A", 1, 2.0, "2025-01-05")], "id_hotel")
    dim = Dimension(hotels, "id_hotel", True)
    assert rollup(events, dim, ["company_id", "mes_reserva"]).collect()[0]["sum_valor"] == 3.0
    assert rollup(events, dim, ["company_id", "ano_reserva", "mes_reserva"]).count() == 2


def test_a_hot_id_does_not_travel(spark, testdata):
    """A third of the rows on one id: the large-dimension plan aggregates before it shuffles."""
    hot = spark.range(30000).select(
        F.lit("A").alias("company_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("int").alias("id_hotel"),
        (F.col("id") % 100 / 4).alias("valor"),
        F.timestamp_seconds(F.col("id") * 86400).alias("data_reserva"),
    )
    hotels = spark.range(1000).select(
        F.col("id").cast("int").alias("id_hotel"),
        F.concat(F.lit("c"), F.col("id") % 10).alias("cidade"),
        (F.col("id") % 5 + 1).cast("int").alias("estrelas"),
    )
    by = ["company_id", "cidade", "mes_reserva"]
    large = rollup(hot, Dimension(hotels, "id_hotel", False), by)
    small = rollup(hot, Dimension(hotels, "id_hotel", True), by)
    assert sorted(map(tuple, large.collect())) == sorted(map(tuple, small.collect()))
    plan = large._jdf.queryExecution().sparkPlan().toString()
    below_join = plan[plan.index("Join"):]
    assert "partial_sum" in below_join


def test_a_hot_id_is_split_in_a_row_join(spark):
    """Rows joined to a large dimension: the partition of the hot id is read in pieces."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    events = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("int").alias("id_hotel"),
        F.rand(1).alias("valor"),
    )
    hotels = spark.range(1000).select(F.col("id").cast("int").alias("id_hotel"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = enrich(events, Dimension(hotels, "id_hotel", False))
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_dimension_size_is_measured(spark):
    frame = spark.createDataFrame([(1, "abc", 1), (2, None, 2)], HOTEL)
    assert measured_bytes(frame) == 2 * (32 + 3 * 16) + 3
    assert Dimension.measured(frame, "id_hotel").small
    assert not Dimension.measured(frame, "id_hotel", budget=100).small
    assert not Dimension.measured(frame, "id_hotel", budget=0).small


def test_lookups(spark, golden_frames):
    hotel_events, flight_events, hotels, flights = golden_frames
    dim = Dimension(flights, "id_voo", True)
    assert enrich(hotel_events, Dimension(hotels, "id_hotel", True)).count() == 4
    used = rows_in_use(hotels, hotel_events, "id_hotel")
    assert sorted(r["id_hotel"] for r in used.collect()) == [1, 2]
    assert flights_of_city(flight_events, dim, "São Paulo").count() == 3
    assert flights_of_city(flight_events, dim, "sao paulo").count() == 0
    assert flights_of_city(flight_events, dim, "sao paulo", any_spelling=True).count() == 3
    legacy = flights.toDF("id_voo", "cidade_ida", "cidade_volta")
    assert with_current_names(legacy).columns == flights.columns
    assert with_current_names(flights).columns == flights.columns


def test_sums_do_not_depend_on_order(spark):
    rng = random.Random(5)
    cents = [rng.randint(-10**9, 10**9) for _ in range(5000)]
    frame = spark.createDataFrame([(c / 100, i) for i, c in enumerate(cents)], "v DOUBLE, i INT")
    for shuffled in (frame, frame.repartition(7, "i"), frame.orderBy(F.col("v"))):
        assert shuffled.agg(exact_sum("v")).first()[0] == sum(cents) / 100
    odd = spark.createDataFrame([(0.001,), (0.0025,), (None,)], "v DOUBLE")
    assert odd.agg(exact_sum("v")).first()[0] == pytest.approx(0.0035)
    assert odd.where("v IS NULL").agg(exact_sum("v")).first()[0] is None
    infinite = spark.createDataFrame([(float("inf"),), (1.0,)], "v DOUBLE")
    assert infinite.agg(exact_sum("v")).first()[0] == float("inf")
    assert spark.range(1).select(exact_add(F.lit(0.1), F.lit(0.2))).first()[0] == 0.3


def test_names_normalize_like_unicode_says(spark):
    def expected(text):
        return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()

    names = ["São Paulo", "SAO PAULO", "São Paulo", "Ñandú", "ﬁm", "½ nº 1", "Œuvre", "東京", ""]
    names += [f"a{chr(c)}Z" for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000]
    frame = spark.createDataFrame([(n,) for n in names], "n STRING").coalesce(1)
    result = dict(frame.select("n", normalize_name("n")).collect())
    assert result == {n: expected(n) for n in names}


def test_small_functions(spark):
    row = spark.range(1)
    months = [month_name(F.lit(m)).alias(f"m{m}") for m in (0, 1, 12, 13)]
    assert tuple(row.select(*months).first()) == (None, "Jan", "Dec", None)
    ratios = [safe_ratio(F.lit(a), F.lit(b)) for a, b in ((6, 4), (6, 0))]
    assert tuple(row.select(*ratios).first()) == (1.5, 0.0)
    assert row.select(safe_ratio(F.lit(None).cast("int"), F.lit(2))).first()[0] == 0.0
    stars = spark.range(100).select(
        weighted_category("id", [1, 2, 3, 4, 5], [10, 15, 35, 25, 15]).alias("s")
    )
    assert sorted(map(tuple, stars.groupBy("s").count().collect())) == [
        (1, 10), (2, 15), (3, 35), (4, 25), (5, 15),
    ]
    with pytest.raises(ValueError):
        weighted_category("id", [1], [99])
    assert shuffle_width(10 * 2**40, 8000) == 81920
    assert shuffle_width(1, 8) == 8


def test_messages_that_cannot_be_used(spark):
    bad = golden.bad_hotel_messages()
    lines = [*golden.hotel_messages(), *bad.values()]
    decoded = decode_hotels(spark.createDataFrame([(line,) for line in lines], "value STRING"))
    assert dict((r["value"], r["reason"]) for r in rejects(decoded).collect()) == {
        message: reason for reason, message in bad.items()
    }
    odd = golden.hotel_message("A", 1, 5.0, "2025-01-01", number="unreadable")
    kept = usable(decode_hotels(spark.createDataFrame([(odd,)], "value STRING"))).collect()
    assert [(r["valor"], r["id_reserva_hotel"]) for r in kept] == [(5.0, None)]
    events = usable(decoded).orderBy("company_id", "id_hotel", "valor").collect()
    assert len(events) == 5
    assert events[0]["data_reserva"] == datetime.datetime(2025, 2, 10)
    assert events[0]["event_timestamp"] == datetime.datetime(2025, 1, 5, 10)


def test_dense_months_and_rolling_mean(spark):
    stats = spark.createDataFrame(
        [("A", 2, 5.0), ("A", None, 7.0), ("B", 13, 1.0)],
        "company_id STRING, mes_reserva INT, sum_valor DOUBLE",
    )
    report = reports.month_report(stats, "sum_valor").orderBy("company_id", "month_num").collect()
    assert [(r["company_id"], r["month_num"]) for r in report] == [
        (c, m) for c in "AB" for m in range(1, 13)
    ]
    assert [tuple(r) for r in report if r["sum_valor"]] == [("A", 2, "Feb", 5.0)]
    daily = spark.createDataFrame(
        [("A", datetime.date(2025, 1, d), n) for d, n in ((1, 1), (2, 3), (20, 5))],
        "company_id STRING, data_reserva DATE, num_reservas BIGINT",
    )

    def means(calendar):
        report = reports.rolling_report(daily, calendar).orderBy("data_reserva")
        return [r["media_movel_7dias"] for r in report.collect()]

    assert means(False) == [1.0, 2.0, 3.0]
    assert means(True) == [1.0, 2.0, 5.0]


def test_reports_come_in_order(spark):
    rows = [("B", 3, 1.0), ("A", 7, 2.0), ("B", 1, 5.0), ("A", 2, 9.0), ("A", 1, 4.0)]
    stats = spark.createDataFrame(rows, "company_id STRING, mes_reserva INT, sum_valor DOUBLE").repartition(4)
    assert [tuple(r) for r in reports.by_value(stats, "sum_valor").collect()] == sorted(
        rows, key=lambda r: (r[0], r[2])
    )
    assert [tuple(r) for r in reports.by_key(stats, "mes_reserva").collect()] == sorted(rows)
    months = [(r.company_id, r.month_num) for r in reports.month_report(stats, "sum_valor").collect()]
    assert months == [(c, m) for c in "AB" for m in range(1, 13)]


def test_pending_batches_are_chosen_at_the_scan(spark, testdata):
    from tripstats.plans.queries import registered

    plan = registered()["pending_partials"](spark, testdata)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Filter" in line and "> 199" in line]
    assert sum("Relation" in line for line in below) == 2


def test_city_report(spark):
    revenue = [(f"c{i:02d}", float(i)) for i in range(1, 13)]
    rows = [("A", c, v) for c, v in revenue] + [
        ("A", "C01", 1.5), ("A", "São Paulo", 900.0), ("A", "SALVADOR", 800.0),
    ]
    stats = spark.createDataFrame(rows, "company_id STRING, cidade STRING, sum_valor DOUBLE")
    missing = reports.missing_cities(stats).collect()
    assert sorted(r["cidade"] for r in missing) == ["Belo Horizonte", "Rio de Janeiro"]
    report = reports.city_report(stats).orderBy("posicao").collect()
    # Two missing cities at 0, seven of the eight lowest rows (C01 merges), then São Paulo.
    assert [(r["cidade"], r["sum_valor"]) for r in report] == [
        ("Belo Horizonte", 0.0), ("Rio de Janeiro", 0.0),
        *[(f"c{i:02d}", float(i)) for i in range(1, 8)], ("São Paulo", 900.0),
    ]
    highest = reports.city_report(stats, n=3, order="desc").orderBy("posicao").collect()
    assert [r["cidade"] for r in highest] == ["São Paulo", "SALVADOR", "c12"]
    assert reports.city_report(stats, n=50).count() == 16


def test_run_log_page_checks_its_arguments(spark):
    log = spark.createDataFrame([(1, 1)], "id INT, start_time INT")
    for wrong in ({"limit": 0}, {"limit": 1001}, {"order": "up"}):
        with pytest.raises(ValueError):
            reports.run_log_page(log, **wrong)


def test_dimensions_load_once(spark, tmp_path, golden_frames):
    frames = {"hoteis": golden_frames[2], "voos": golden_frames[3]}
    paths = {name: str(tmp_path / name) for name in frames}
    assert dimensions.load_dimensions(spark, frames, paths)
    assert not dimensions.load_dimensions(spark, frames, paths)
    hotels = dimensions.read_hotels(spark, paths["hoteis"])
    assert sorted(map(tuple, hotels.collect())) == golden.HOTELS
    assert dimensions.read_flights(spark, paths["voos"]).count() == 3
