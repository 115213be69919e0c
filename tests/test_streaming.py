"""Messages through the stream into the store, and from there into totals."""

import random
from pathlib import Path

import golden
import pytest
from pyspark.sql import functions as F

from tripstats.__main__ import main
from tripstats.operators.lookup import Dimension
from tripstats.operators.rollup import flight_cube, hotel_cube, rollup
from tripstats.operators.statistics import all_statistics
from tripstats.schemas import FLIGHT_SOURCE, HOTEL_SOURCE, STAT_TABLES, stat_table
from tripstats.sources.dimensions import load_dimensions
from tripstats.sources.messages import decode_both, decode_hotels, file_messages, usable
from tripstats.sources.store import Store
from tripstats.streaming import Job, fold_all, recomputed, start

DEPENDS_ON_CUT = {"stats_faturamentos_totais", "stats_ticket_medio"}
OPEN = {HOTEL_SOURCE: 1, FLIGHT_SOURCE: 1}


@pytest.fixture(scope="module")
def dims(spark):
    hotels = spark.createDataFrame(golden.HOTELS, "id_hotel INT, cidade STRING, estrelas INT")
    flights = spark.createDataFrame(
        golden.FLIGHTS, "id_voo INT, cidade_origem STRING, cidade_destino STRING"
    )
    return Dimension.measured(hotels, "id_hotel"), Dimension.measured(flights, "id_voo")


def texts(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value STRING")


class Feed:
    """Folders of message files and the store they stream into."""

    def __init__(self, spark, folder: Path, dims, thresholds):
        self.spark, self.folder = spark, folder
        for source in OPEN:
            (folder / source).mkdir(parents=True)
        self.store = Store(spark, str(folder / "store"))
        self.job = Job(self.store, *dims, thresholds=thresholds)
        self.files = 0

    def push(self, hotels=(), flights=()):
        self.files += 1
        for source, lines in ((HOTEL_SOURCE, hotels), (FLIGHT_SOURCE, flights)):
            if lines:
                path = self.folder / source / f"{self.files:05d}.txt"
                path.write_text("\n".join(lines) + "\n", encoding="utf-8")

    def run(self):
        streams = (file_messages(self.spark, str(self.folder / source)) for source in OPEN)
        start(*streams, self.job).awaitTermination()

    def totals(self):
        return {name: golden.rows(self.store.stat(name), t) for name, t in STAT_TABLES.items()}


@pytest.fixture
def feed(spark, tmp_path, dims):
    return lambda thresholds=OPEN: Feed(spark, tmp_path / "feed", dims, thresholds)


def test_stream_gives_the_golden_statistics(feed):
    f = feed()
    f.push(golden.hotel_messages(), golden.flight_messages())
    f.run()
    assert fold_all(f.store) == 1
    assert f.totals() == golden.EXPECTED
    assert fold_all(f.store) is None


def test_second_batch_adds(feed):
    f = feed()
    for _ in range(2):
        f.push(golden.hotel_messages(), golden.flight_messages())
        f.run()
    assert [r["id"] for r in f.store.run_log().orderBy("id").collect()] == [0, 1]
    assert {r["pending"] for r in f.store.pending().collect()} != {0}
    assert fold_all(f.store, max_batches=1) == 1
    assert f.totals() == golden.EXPECTED
    assert f.store.partials("month_hotel").where("processed").count() == 3
    assert fold_all(f.store) == 2
    doubled = {
        name: [
            (*row[: 1 + len(table.keys)], *(2 * v for v in row[1 + len(table.keys):]))
            for row in golden.EXPECTED[name]
        ]
        for name, table in STAT_TABLES.items()
    }
    assert f.totals() == doubled
    assert {r["pending"] for r in f.store.pending().collect()} == {0}
    f.store.prune(keep_versions=1)
    assert f.totals() == doubled
    assert f.store.partials("month_hotel").isEmpty()
    assert f.store.processed_up_to() == 1
    assert sorted(r["id"] for r in f.store.run_log().collect()) == [0, 1]
    assert [p.name for p in (f.folder / "store" / "run_log").iterdir()] == ["batch_id=-3"]
    f.store.prune(keep_versions=1)
    assert f.store.processed_up_to() == 1
    assert [p.name for p in (f.folder / "store" / "totals").iterdir()] == ["version=2"]


def test_prune_that_stops_counts_nothing_twice(feed, monkeypatch):
    f = feed()
    f.push(golden.hotel_messages(), golden.flight_messages())
    f.run()
    fold_all(f.store)

    def stop(*_, **__):
        raise OSError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(Store, "_drop", stop)
        with pytest.raises(OSError):
            f.store.prune()
    assert f.store.processed_up_to() == 0
    assert [r["id"] for r in f.store.run_log().collect()] == [0]
    f.store.prune()
    f.run()
    assert fold_all(f.store) is None
    assert f.totals() == golden.EXPECTED


def test_replayed_batch_changes_nothing(feed, spark):
    f = feed()
    batch = decode_both(
        texts(spark, golden.hotel_messages()), texts(spark, golden.flight_messages())
    )
    f.job(batch, 0)
    # Lost between the partials and the commit: the batch comes again.
    f.job.process(range(1))
    f.job(batch, 0)
    # A batch that wrote its partials and never committed does not count.
    f.store.write_partials(f.store.wide_partials().drop("batch_id").limit(1), 1)
    fold_all(f.store)
    assert f.totals() == golden.EXPECTED


def test_gate_waits_for_both_sources(feed):
    f = feed({HOTEL_SOURCE: 6, FLIGHT_SOURCE: 5})
    f.push(golden.hotel_messages(), golden.flight_messages())
    f.run()
    assert f.store.processed_up_to() == -1
    assert {r["source"]: r["pending"] for r in f.store.backlog().collect()} == {
        HOTEL_SOURCE: 5, FLIGHT_SOURCE: 5,
    }
    assert f.store.backlog_peek(2).count() == 4
    f.push(["bad"])
    f.run()
    assert f.store.backlog().isEmpty()
    log = f.store.run_log_page().collect()
    assert [(r["rows_hotels"], r["rows_flights"]) for r in log] == [(6, 5)]
    fold_all(f.store)
    assert f.totals() == golden.EXPECTED


def test_bad_messages_are_set_aside(feed):
    f = feed()
    bad = golden.bad_hotel_messages()
    f.push(["junk"], ["junk"])  # a batch without any usable message
    f.run()
    assert fold_all(f.store) == 1
    assert f.store.stat("month_hotel").isEmpty()
    f.push([*golden.hotel_messages(), *bad.values()], golden.flight_messages())
    f.run()
    fold_all(f.store)
    assert f.totals() == golden.EXPECTED
    assert {r["value"]: r["reason"] for r in f.store.rejects().collect()} == {
        message: reason for reason, message in bad.items()
    } | {"junk": "envelope_not_json"}


def test_command_line(feed, dims, capsys):
    f = feed()
    f.push(golden.hotel_messages(), golden.flight_messages())
    paths = {name: str(f.folder / name) for name in ("hotels", "flights")}
    load_dimensions(f.spark, {"hotels": dims[0].frame, "flights": dims[1].frame}, paths)
    store = ["--store", f.store.root]
    main([
        "ingest", *store, "--hotels", paths["hotels"], "--flights", paths["flights"],
        "--hotel-messages", str(f.folder / HOTEL_SOURCE), "--hotel-threshold", "5",
        "--flight-messages", str(f.folder / FLIGHT_SOURCE), "--flight-threshold", "5",
    ])
    main(["fold", *store, "--prune"])
    assert f.totals() == golden.EXPECTED
    capsys.readouterr()
    main(["fold", *store])
    assert "nothing to fold" in capsys.readouterr().out


def test_reads(feed):
    f = feed()
    assert f.store.stat("month_hotel").isEmpty()
    assert f.store.clients().isEmpty()
    f.push(golden.hotel_messages(), golden.flight_messages())
    f.run()
    fold_all(f.store)
    assert [r[0] for r in f.store.clients().collect()] == ["A", "B", "C"]
    table = stat_table("city_hotel")
    assert golden.rows(f.store.stat("stats_city_hotel", "B"), table) == [("B", "Natal", 80.0)]
    with pytest.raises(KeyError):
        f.store.stat("month_cars")
    with pytest.raises(KeyError):
        f.store.partials("month_cars")


@pytest.mark.parametrize("seed", [1, 2])
def test_cutting_into_batches(feed, spark, dims, seed):
    """Nine tables do not depend on the cut; the two joined per batch do, and can be recomputed."""
    rng = random.Random(seed)
    hotels = [
        golden.hotel_message(rng.choice("AB"), rng.randint(1, 4), rng.randint(1, 99999) / 100,
                             f"2025-{rng.randint(1, 4):02d}-{rng.randint(1, 28):02d}")
        for _ in range(60)
    ]
    flights = [
        golden.flight_message(rng.choice("AB"), rng.randint(9, 12), rng.randint(1, 99999) / 100,
                              f"2025-{rng.randint(1, 4):02d}-{rng.randint(1, 28):02d}")
        for _ in range(60)
    ]
    whole_hotels = usable(decode_hotels(texts(spark, hotels)))
    decoded = usable(decode_both(texts(spark, hotels), texts(spark, flights)))
    assert whole_hotels.count() == 60
    expected = {
        name: golden.rows(frame, STAT_TABLES[name])
        for name, frame in all_statistics(
            hotel_cube(decoded.where(F.col("source") == HOTEL_SOURCE), dims[0]),
            flight_cube(decoded.where(F.col("source") == FLIGHT_SOURCE), dims[1], "São Paulo"),
        ).items()
    }
    f = feed()
    cuts = sorted(rng.sample(range(1, 60), 3))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, 60])):
        f.job(decode_both(texts(spark, hotels[a:b]), texts(spark, flights[a:b])), i)
    fold_all(f.store)
    totals = f.totals()
    for name in STAT_TABLES.keys() - DEPENDS_ON_CUT:
        assert totals[name] == expected[name], name
    assert totals["stats_ticket_medio"] != expected["stats_ticket_medio"]
    again = recomputed(f.store)
    for name, table in STAT_TABLES.items():
        assert golden.rows(again[name], table) == expected[name], name
    # Invariants between tables.
    counts = {r[:2]: r[2] for r in totals["stats_month_hotel_count"]}
    assert counts == {r[:2]: r[3] for r in totals["stats_estrelas_medias_mes"]}
    for company in "AB":
        by_month = sum(r[2] for r in totals["stats_month_hotel"] if r[0] == company)
        by_city = sum(r[2] for r in totals["stats_city_hotel"] if r[0] == company)
        assert round(by_month, 2) == round(by_city, 2)


def test_rollup_runs_as_a_streaming_aggregation(spark, feed, dims):
    f = feed()
    f.push(golden.hotel_messages())
    stream = usable(decode_hotels(file_messages(spark, str(f.folder / HOTEL_SOURCE))))
    live = rollup(stream, dims[0], ["company_id", "mes_reserva"])
    query = (
        live.writeStream.format("memory").queryName("live_month_hotel").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    result = golden.rows(spark.table("live_month_hotel"), stat_table("month_hotel"))
    assert result == golden.EXPECTED["stats_month_hotel"]


def test_dimension_rows_added_between_batches_count(spark, tmp_path, dims):
    hotels, flights = dims
    known = [hotels.frame.where("id_hotel = 1"), hotels.frame]
    store = Store(spark, str(tmp_path / "store"))
    job = Job(store, lambda: Dimension.measured(known[0], "id_hotel"), flights, thresholds=OPEN)
    assert {r["id_hotel"] for r in job.hotels().frame.collect()} == {1}
    known.pop(0)
    assert job.hotels().frame.count() == hotels.frame.count()


def test_a_folded_batch_stays_committed_without_its_log_row(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.processed_up_to() == -1
    log = spark.range(1).selectExpr("CAST(4 AS BIGINT) AS up_to", "current_timestamp() AS folded_at")
    log.write.parquet(f"{store.root}/fold_log/version=1")
    assert store.processed_up_to() == 4
