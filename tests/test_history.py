"""Pruned batches: their folders go, what they add up to and what was set aside stays."""

import golden
import pytest
from pyspark.sql import functions as F
from test_maintain import OPEN, decoded, made

from tripstats.operators import distinct
from tripstats.operators.lookup import Dimension
from tripstats.schemas import STAT_TABLES
from tripstats.sources import store as stores
from tripstats.sources.store import Store
from tripstats.streaming import Job, fold_all, recomputed


@pytest.fixture(scope="module")
def dims(spark):
    hotels = spark.createDataFrame(golden.HOTELS, "id_hotel INT, cidade STRING, estrelas INT")
    flights = spark.createDataFrame(golden.FLIGHTS, "id_voo INT, cidade_origem STRING, cidade_destino STRING")
    return Dimension.measured(hotels, "id_hotel"), Dimension.measured(flights, "id_voo")


def tables(store):
    return {name: golden.rows(frame, STAT_TABLES[name]) for name, frame in recomputed(store).items()}


def test_folders_stay_few_and_nothing_else_changes(spark, tmp_path, dims, monkeypatch):
    monkeypatch.setattr(stores, "FAN", 2)
    pruned, plain = (Store(spark, str(tmp_path / name)) for name in ("pruned", "plain"))
    jobs = [Job(store, *dims, thresholds=OPEN) for store in (pruned, plain)]
    hotels, flights = made(30, "AB", 7)

    def folders(pattern):
        return sorted(p.name for p in (tmp_path / "pruned").glob(pattern))

    for i in range(4):
        lines = [*hotels[i::4], f"junk {i}"], flights[i::4]
        for job in jobs:
            job(decoded(spark, *lines), i)
        assert fold_all(pruned) == i + 1
        pruned.prune(keep_versions=1, keep_batches=1)
        # The last batch is whole; ranges of two are gathered into one of the next level.
        assert folders("landed/batch_id=*") == folders("cubes/hotel/batch_id=*") == [f"batch_id={i}"]
        assert len(folders("history/upto=*")) <= 2 and len(folders("history_log/upto=*")) <= 1
    assert pruned.history() == (2, [(1, 1), (0, 2)])
    assert tables(pruned) == tables(plain)
    assert pruned.waiting().isEmpty()
    assert sorted(r["value"] for r in pruned.rejects().collect()) == [f"junk {i}" for i in range(4)]
    # A stop after the log row: folders that are back count for nothing, and go again.
    pruned.land(decoded(spark, hotels, flights), 0)
    assert tables(pruned) == tables(plain) and pruned.rejects().count() == 4
    pruned.prune(keep_batches=1)
    assert folders("landed/batch_id=*") == ["batch_id=3"]


def test_bitmaps_add_up(spark):
    dim = spark.createDataFrame([(5, "a"), (3, "b"), (9, "a"), (70_000, "c"), (4, None)], "k LONG, v STRING")
    numbers = distinct.numbered(dim, "k", ["v"])
    assert {(r["k"], r["number"]) for r in numbers.collect()} == {(5, 5), (3, 3), (9, 5), (70_000, 70_000), (4, None)}
    rows = [("x", 1, 5), ("x", 1, 9), ("x", 2, 9), ("x", 2, 70_000), ("y", 1, 4), ("y", 2, 3)]
    events = spark.createDataFrame(rows, "g STRING, batch INT, k LONG").join(F.broadcast(numbers), "k")
    parts = distinct.bitmaps(events, ["g", "batch"])
    first, second = (distinct.merged(["g"], parts.where(F.col("batch") == b)) for b in (1, 2))
    both = distinct.merged(["g"], first, second)
    assert dict(distinct.counted(first, ["g"], "n").collect()) == {"x": 1}
    assert dict(distinct.counted(both, ["g"], "n").collect()) == {"x": 2, "y": 1}
    none = distinct.bitmaps(events.limit(0), ["g"])
    assert distinct.counted(distinct.merged(["g"], none, none), ["g"], "n").isEmpty()
