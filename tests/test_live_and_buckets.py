"""Totals as streaming state across restarts; dimensions that joins don't shuffle."""

import golden
import pytest

from tripstats.operators.lookup import Dimension, enrich
from tripstats.operators.rollup import rollup
from tripstats.schemas import HOTEL_SOURCE, stat_table
from tripstats.sources.dimensions import read_bucketed, write_bucketed
from tripstats.sources.messages import decode_hotels, file_messages, usable
from tripstats.streaming.live import keep_live, live_totals


@pytest.fixture(scope="module")
def hotels(spark):
    frame = spark.createDataFrame(golden.HOTELS, "id_hotel INT, cidade STRING, estrelas INT")
    return Dimension.measured(frame, "id_hotel")


@pytest.mark.parametrize("small", [True, False])
def test_state_goes_on_over_restarts(spark, tmp_path, hotels, small):
    source, checkpoint = tmp_path / HOTEL_SOURCE, str(tmp_path / "checkpoint")
    source.mkdir()
    dim = Dimension(hotels.frame, hotels.key, small)
    by = ["company_id", "mes_reserva"]
    lines = golden.hotel_messages()
    counts = []
    for i in range(3):  # a new query each time
        (source / f"{i}.txt").write_text("\n".join(lines[i::3]) + "\n", encoding="utf-8")
        events = usable(decode_hotels(file_messages(spark, str(source))))
        keep_live(events, dim, by, checkpoint).awaitTermination()
        counts.append(live_totals(spark, checkpoint, by).agg({"num_reservas": "sum"}).first()[0])
    assert golden.rows(live_totals(spark, checkpoint, by), stat_table("month_hotel")) == golden.EXPECTED["stats_month_hotel"]
    assert counts == sorted(set(counts))
    before = live_totals(spark, checkpoint, by, batch=0).agg({"num_reservas": "sum"}).first()[0]
    assert before == counts[0]


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]


def test_bucketed_dimension_is_not_shuffled(spark, tmp_path, hotels, testdata):
    path = str(tmp_path / "flights")
    flights = spark.read.parquet(f"{testdata}/part.parquet").selectExpr("CAST(p_partkey AS INT) AS id_voo", "p_brand AS cidade_destino", "p_size AS n")
    events = spark.read.parquet(f"{testdata}/lineitem.parquet").selectExpr(
        "CAST(l_partkey AS INT) AS id_voo", "l_returnflag AS company_id", "l_extendedprice AS valor", "CAST(l_shipdate AS TIMESTAMP) AS data_reserva"
    )
    write_bucketed(flights, path, "id_voo", 3)
    write_bucketed(flights, path, "id_voo", 8)
    stored = Dimension(read_bucketed(spark, path, "id_voo"), "id_voo", small=False)
    by = ["company_id", "cidade_destino", "mes_reserva"]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for make in (lambda d: rollup(events, d, by), lambda d: enrich(events, d)):
            plan = plan_of(make(stored))
            assert "SelectedBucketsCount: 8 out of 8" in plan
            exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning(id_voo" in x]
            plain = [x for x in plan_of(make(Dimension(flights, "id_voo", False))).splitlines() if "Exchange hashpartitioning(id_voo" in x]
            assert len(exchanges) < len(plain)
            expected = make(Dimension(flights, "id_voo", True))
            assert sorted(make(stored).select(expected.columns).collect()) == sorted(expected.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_bucketed_dimension_of_no_rows_and_none(spark, tmp_path, hotels):
    with pytest.raises(ValueError, match="0 bucketed tables"):
        read_bucketed(spark, str(tmp_path / "none"), "id_hotel")
    path = str(tmp_path / "hotels")
    write_bucketed(hotels.frame, path, "id_hotel", 4)
    assert sorted(read_bucketed(spark, path, "id_hotel").collect()) == sorted(hotels.frame.collect())
