"""Partials to totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.operators.fold import fold_wide
from tripstats.operators.maintain import merge_sides, sides
from tripstats.operators.rollup import FLIGHT_GRAIN, HOTEL_GRAIN, reaggregate
from tripstats.operators.statistics import all_statistics
from tripstats.schemas import WIDE_COLUMNS
from tripstats.sources.store import Store, touched_parts


def fold_all(store: Store, max_batches: int | None = None) -> int | None:
    """Add pending partials to the totals of all tables; the new version, None if nothing pends.

    Takes the oldest `max_batches` batches at most and opens only their folders. Of the totals
    only the parts with a key of these batches are read and written. All tables advance in one
    version: readers see the old totals until it is committed. Beside the totals, both sides of
    the joined ones are kept up, from which `Store.joined` gives them whatever the cut.
    """
    version, up_to = store.folded()
    ids = store.run_log().where(F.col("id") > up_to).select("id").orderBy("id")
    pending = [r["id"] for r in (ids.limit(max_batches) if max_batches else ids).collect()]
    if not pending:
        return None
    partials = store.wide_partials(pending).select(*WIDE_COLUMNS)
    touched = touched_parts(partials, "table")
    totals = fold_wide(store.wide_totals(version, touched).select(*WIDE_COLUMNS), partials)
    new = sides(store.cubes("hotel", pending), store.cubes("flight", pending))
    touched_sides = touched_parts(new, "axis")
    merged = merge_sides(store.sides(version, touched_sides), new)
    store.write_totals(totals, version + 1, pending[-1], touched, merged, touched_sides)
    return version + 1


def recomputed(store: Store, how: str = "inner") -> dict[str, DataFrame]:
    """The eleven totals as if all processed messages had come in one batch.

    Total revenue and ticket inputs join hotels with flights inside a batch, so their folded
    totals depend on how messages were cut into batches; these do not. `how="full"` keeps
    months and cities that only one side has.
    """
    done = F.col("batch_id") <= store.processed_up_to()
    hotels = reaggregate(store.cubes("hotel").where(done), HOTEL_GRAIN)
    flights = reaggregate(store.cubes("flight").where(done), FLIGHT_GRAIN)
    return all_statistics(hotels, flights, how=how)
