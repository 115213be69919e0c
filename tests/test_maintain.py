"""Joined totals kept up by changes, and totals of which a fold rewrites only parts."""

import random

import golden
import pytest
from pyspark.sql import functions as F

from tripstats.operators import maintain
from tripstats.operators.lookup import Dimension
from tripstats.operators.rollup import flight_cube, hotel_cube
from tripstats.operators.statistics import all_statistics
from tripstats.schemas import FLIGHT_SOURCE, HOTEL_SOURCE, STAT_TABLES
from tripstats.sources.messages import decode_both, usable
from tripstats.sources.store import Store
from tripstats.streaming import Job, fold_all

JOINED = ("stats_faturamentos_totais", "stats_ticket_medio")
OPEN = {HOTEL_SOURCE: 1, FLIGHT_SOURCE: 1}


@pytest.fixture(scope="module")
def dims(spark):
    hotels = spark.createDataFrame(golden.HOTELS, "id_hotel INT, cidade STRING, estrelas INT")
    flights = spark.createDataFrame(golden.FLIGHTS, "id_voo INT, cidade_origem STRING, cidade_destino STRING")
    return Dimension.measured(hotels, "id_hotel"), Dimension.measured(flights, "id_voo")


def made(n, companies, seed):
    rng = random.Random(seed)

    def day():
        return f"2025-{rng.randint(1, 4):02d}-{rng.randint(1, 28):02d}"

    hotels = [golden.hotel_message(rng.choice(companies), rng.randint(1, 4), rng.randint(1, 99999) / 100, day()) for _ in range(n)]
    flights = [golden.flight_message(rng.choice(companies), rng.randint(9, 12), rng.randint(1, 99999) / 100, day()) for _ in range(n)]
    return hotels, flights


def decoded(spark, hotels, flights):
    frames = (spark.createDataFrame([(m,) for m in lines], "value STRING") for lines in (hotels, flights))
    return decode_both(*frames)


def whole(spark, dims, hotels, flights):
    events = usable(decoded(spark, hotels, flights))
    cubes = (
        hotel_cube(events.where(F.col("source") == HOTEL_SOURCE), dims[0]),
        flight_cube(events.where(F.col("source") == FLIGHT_SOURCE), dims[1], "São Paulo"),
    )
    return {name: golden.rows(frame, STAT_TABLES[name]) for name, frame in all_statistics(*cubes).items()}


@pytest.mark.parametrize("batches, folds", [(1, 1), (4, 4)])
def test_joined_totals_do_not_depend_on_the_cut(spark, tmp_path, dims, batches, folds):
    hotels, flights = made(60, "AB", 5)
    expected = whole(spark, dims, hotels, flights)
    store = Store(spark, str(tmp_path / "store"))
    job = Job(store, *dims, thresholds=OPEN)
    assert store.joined("ticket_medio").isEmpty()
    for i in range(batches):
        job(decoded(spark, hotels[i::batches], flights[i::batches]), i)
        if folds > 1:
            assert fold_all(store) == i + 1
    if folds == 1:
        fold_all(store)
    for name in JOINED:
        assert golden.rows(store.joined(name), STAT_TABLES[name]) == expected[name]
    only = store.joined("ticket_medio", "A")
    assert golden.rows(only, STAT_TABLES[JOINED[1]]) == [r for r in expected[JOINED[1]] if r[0] == "A"]
    store.prune(keep_versions=1)
    for name in STAT_TABLES.keys() - set(JOINED):
        assert golden.rows(store.stat(name), STAT_TABLES[name]) == expected[name]
    for name in JOINED:
        assert golden.rows(store.joined(name), STAT_TABLES[name]) == expected[name]


def test_changes_lead_from_one_state_to_the_next(spark, dims):
    """The changes of a batch, over what stands, add up to the joined totals after it."""
    hotels, flights = made(80, "ABC", 11)
    sums = {name: {} for name in JOINED}
    standing = spark.createDataFrame([], maintain.SIDES)
    for i in range(3):
        events = usable(decoded(spark, hotels[: 20 + i] if i == 0 else hotels[i::3], flights[40:] if i == 0 else flights[i : 10 * i]))
        new = maintain.sides(
            hotel_cube(events.where(F.col("source") == HOTEL_SOURCE), dims[0]),
            flight_cube(events.where(F.col("source") == FLIGHT_SOURCE), dims[1], "São Paulo"),
        )
        change = maintain.delta(standing, new)
        for name, rows in zip(JOINED, (maintain.total_changes(change), maintain.ticket_changes(change))):
            for company, key, *values in rows.collect():
                old = sums[name].setdefault((company, key), [0] * len(values))
                sums[name][company, key] = [round(x + y, 2) for x, y in zip(old, values)]
        rows = maintain.merge_sides(standing, new).collect()
        standing = spark.createDataFrame(rows, maintain.SIDES)
        for name, rows in zip(JOINED, maintain.joined_totals(standing)):
            assert {(c, k): v for c, k, *v in rows.collect()} == sums[name]
    assert all(len(s) > 5 for s in sums.values())


def test_a_fold_writes_only_the_parts_it_touches(spark, tmp_path, dims):
    store = Store(spark, str(tmp_path / "store"))
    job = Job(store, *dims, thresholds=OPEN)
    companies = [f"C{i}" for i in range(5)]
    first, second = made(80, companies, 3), made(6, ["C3"], 4)
    job(decoded(spark, *first), 0)
    fold_all(store)
    job(decoded(spark, *second), 1)
    fold_all(store)

    def files(folder):
        return len(list((tmp_path / "store" / folder).rglob("*.parquet")))

    # One company is in one part of each of eleven tables, and of the two axes.
    assert files("totals/version=1") > 40 and files("totals/version=2") <= 30
    assert len(list((tmp_path / "store/totals/version=2").glob("part=*"))) <= 11
    assert files("sides/version=2") <= 2 < files("sides/version=1")
    expected = whole(spark, dims, first[0] + second[0], first[1] + second[1])
    for _ in range(2):
        for name in STAT_TABLES.keys() - set(JOINED):
            assert golden.rows(store.stat(name), STAT_TABLES[name]) == expected[name]
        for name in JOINED:
            assert golden.rows(store.joined(name), STAT_TABLES[name]) == expected[name]
        store.prune(keep_versions=1)
    assert store.wide_totals(1).isEmpty()


def test_a_batch_without_usable_rows_writes_no_part(spark, tmp_path, dims):
    store = Store(spark, str(tmp_path / "store"))
    job = Job(store, *dims, thresholds=OPEN)
    job(decoded(spark, ["junk"], ["junk"]), 0)
    assert fold_all(store) == 1
    assert not (tmp_path / "store/totals").exists() and not (tmp_path / "store/sides").exists()
    assert store.stat("month_hotel").isEmpty() and fold_all(store) is None
