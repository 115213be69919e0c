"""Lookups bounded by the events' ids, counts observed while landing, rows set aside by rules."""

import golden
import pytest
from pyspark.sql import functions as F

from tripstats.operators import lookup, quarantine
from tripstats.operators.lookup import Dimension
from tripstats.schemas import FLIGHT_SOURCE, HOTEL_SOURCE
from tripstats.sources.dimensions import write_dimension
from tripstats.sources.messages import decode_both
from tripstats.sources.store import Store
from tripstats.streaming import Job, ingest

ROWS = "id int, nome string, valor double"


def test_lookup_reads_between_the_ids(spark, tmp_path):
    path = str(tmp_path / "dim")
    dim = spark.range(20_000).select(F.col("id").cast("int").alias("id_voo"), F.col("id").cast("string").alias("cidade_origem"))
    write_dimension(dim.repartition(5), path, rows_per_file=1000, key="id_voo")
    stored = spark.read.parquet(path)
    # Files hold ranges of the key.
    spans = stored.groupBy(F.input_file_name()).agg(F.max("id_voo") - F.min("id_voo") + 1, F.count("*")).collect()
    assert len(spans) >= 20 and all(r[1] == r[2] for r in spans)
    events = spark.createDataFrame([(7000,), (7003,), (7003,), (None,), (7500,)], "id_voo int")
    found = lookup.rows_in_use(stored, events, "id_voo")
    assert sorted(r[0] for r in found.collect()) == [7000, 7003, 7500]
    bounded = lookup.within_ids(stored, events, "id_voo")
    plan = bounded._jdf.queryExecution().executedPlan()
    assert "GreaterThanOrEqual(id_voo,7000)" in plan.toString().split("PushedFilters")[1]
    # Two files of 1000 rows have one of the ids; of twenty, the others are not read.
    assert {7000, 7003, 7500} <= {r["id_voo"] for r in bounded.collect()} < set(range(7000, 7501))
    scan = bounded._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() <= 2000
    assert lookup.rows_in_use(stored, events.limit(0), "id_voo").isEmpty()


def test_landing_counts_and_the_gate_reads_nothing_again(spark, tmp_path, monkeypatch):
    hotels = spark.createDataFrame(golden.HOTELS, "id_hotel INT, cidade STRING, estrelas INT")
    flights = spark.createDataFrame(golden.FLIGHTS, "id_voo INT, cidade_origem STRING, cidade_destino STRING")
    store = Store(spark, str(tmp_path / "store"))
    limits = {HOTEL_SOURCE: 12, FLIGHT_SOURCE: 5}
    job = Job(store, Dimension.measured(hotels, "id_hotel", 0), Dimension.measured(flights, "id_voo"), thresholds=limits)
    frames = [spark.createDataFrame([(m,) for m in x], "value STRING") for x in (golden.hotel_messages(), golden.flight_messages())]
    reads = []
    gate = ingest.readiness
    monkeypatch.setattr(ingest, "readiness", lambda *a: reads.append(1) or gate(*a))
    for i in range(2):
        job(decode_both(*frames), i)
    assert not reads and store.processed_up_to() == -1
    # A job that starts anew counts what waits once.
    again = Job(store, job.hotels, job.flights, thresholds=limits)
    again(decode_both(*frames), 2)
    assert len(reads) == 1
    (log,) = store.run_log().collect()
    sql = store.landed().groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in sql} == {HOTEL_SOURCE: log["rows_hotels"], FLIGHT_SOURCE: log["rows_flights"]}


@pytest.fixture
def table(spark):
    rows = [(1, "a", 1.0), (1, "a", 2.0), (1, None, 0.5), (2, "b", None), (3, "c", -1.0), (None, "d", 4.0), (None, "d", 4.0), (5, None, -2.0)]
    return spark.createDataFrame(rows, ROWS)


RULES = {"nome_not_null": "nome IS NOT NULL", "valor_positive": "valor > 0", "id_not_null": "id IS NOT NULL"}


def test_rows_that_break_rules_are_set_aside(spark, tmp_path, table):
    kept = quarantine.write_checked(table, str(tmp_path / "t"), RULES, ["id"], ["valor"])
    good = spark.read.schema(ROWS).parquet(kept)
    assert sorted(map(tuple, good.collect())) == [(1, "a", 1.0), (2, "b", None)]
    bad = quarantine.quarantined(spark, str(tmp_path / "t"), table)
    assert sorted((r["id"] or 0, r["valor"], r["reasons"]) for r in bad.collect()) == [
        (0, 4.0, ["id_not_null"]), (0, 4.0, ["id_not_null"]), (1, 0.5, ["nome_not_null"]), (1, 2.0, ["key_unique"]),
        (3, -1.0, ["valor_positive"]), (5, -2.0, ["nome_not_null", "valor_positive"]),
    ]
    assert good.count() + bad.count() == table.count()


def test_no_rules_and_no_rows(table):
    kept, aside = quarantine.split(quarantine.judged(table, {}, ["id"], ["valor"]))
    assert kept.count() == 6 and [r["reasons"] for r in aside.collect()] == [["key_unique"]] * 2
    assert quarantine.judged(table.limit(0), RULES, ["id"]).isEmpty()
