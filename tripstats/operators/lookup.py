"""Dimensions and joins to them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstats.functions import is_named

# What one executor may hold of a dimension as a hash table: enough for some two million flights.
BROADCAST_BYTES = 256 * 1024 * 1024


def measured_bytes(frame: DataFrame) -> int:
    """In-memory size of a frame as hash-table rows, measured by one aggregate.

    Rows are counted and text is measured rather than estimated from file sizes: dictionary
    encoding can make a file of city names a hundred times smaller than its rows. Fixed parts
    are taken on the safe side (slots of the table, null bits, padding).
    """
    text = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    row_bytes = 32 + 16 * len(frame.columns)
    total = F.count(F.lit(1)) * F.lit(row_bytes)
    for name in text:
        total = total + F.coalesce(F.sum(F.octet_length(name)), F.lit(0))
    return frame.agg(total.alias("bytes")).first()["bytes"]


@dataclass(frozen=True)
class Dimension:
    """A dimension with its key, and whether its measured size allows broadcasting it."""

    frame: DataFrame
    key: str
    small: bool

    @classmethod
    def measured(cls, frame: DataFrame, key: str, budget: int = BROADCAST_BYTES) -> Dimension:
        """Measure once; every statistic of a batch then reuses the verdict."""
        return cls(frame, key, budget > 0 and measured_bytes(frame) <= budget)

    def reshaped(self, change: Callable[[DataFrame], DataFrame]) -> Dimension:
        """The same dimension with fewer rows or columns, which keeps the verdict."""
        return Dimension(change(self.frame), self.key, self.small)

    def side(self, columns: Sequence[str] | None = None) -> DataFrame:
        """Key and `columns` (all by default), marked for broadcast if that is known to be safe."""
        others = self.frame.columns if columns is None else columns
        slim = self.frame.select(*dict.fromkeys([self.key, *others]))
        return F.broadcast(slim) if self.small else slim


def enrich(events: DataFrame, dim: Dimension, columns: Sequence[str] | None = None) -> DataFrame:
    """Inner join of events with their dimension; unknown and null ids drop.

    A small dimension is broadcast, so events never shuffle. Otherwise Spark shuffles both
    sides by the key and AQE splits partitions swollen by a hot key.
    """
    return events.join(dim.side(columns), dim.key)


def keys_of(events: DataFrame, key: str) -> DataFrame:
    """Distinct ids of a batch, as a frame; null is no id."""
    return events.select(key).where(F.col(key).isNotNull()).distinct()


def id_ranges(events: DataFrame, key: str, pieces: int = 32) -> list[tuple[int, int]]:
    """Up to `pieces` ranges that hold all ids of the events, by two aggregates over the id column.

    Gaps between the ids of a batch stay out, as each range ends with ids that are there.
    """
    ids = events.select(F.col(key).cast("bigint").alias("id")).where("id IS NOT NULL")
    low, high = ids.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return []
    width = (high - low) // pieces + 1
    found = ids.groupBy(F.expr(f"(id - {low}L) div {width}L").alias("piece")).agg(F.min("id").alias("a"), F.max("id").alias("z"))
    return sorted((r["a"], r["z"]) for r in found.collect())


def within_ids(dim: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Dimension rows in the ranges of the events' ids.

    The ranges are constants, so they are pushed into the scan: of a dimension written in the
    order of its key (`write_dimension`) other files and row groups are not read. No row the
    events refer to is left out. Subqueries instead of constants would not be pushed.
    """
    known = [F.col(key).between(a, z) for a, z in id_ranges(events, key)]
    return dim.where(reduce(Column.__or__, known) if known else F.lit(False))


def rows_in_use(dim: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Dimension rows the events refer to.

    The scan is bounded by the events' ids first. The ids are made distinct before the join, so a
    hot id costs one row per task. Their number is not bounded, hence no broadcast hint: AQE
    decides from the shuffled size.
    """
    return within_ids(dim, events, key).join(keys_of(events, key), key, "left_semi")


def with_current_names(flights: DataFrame) -> DataFrame:
    """Rename the legacy origin and destination columns where a table still has them."""
    return flights.withColumnsRenamed(
        {"cidade_ida": "cidade_origem", "cidade_volta": "cidade_destino"}
    )


def touches_city(city: str, any_spelling: bool = False) -> Column:
    """Predicate: the route starts or ends in `city`, by exact name or by any spelling of it."""

    def matches(column: str) -> Column:
        if any_spelling:
            return is_named(column, city)
        return F.col(column) == city

    return matches("cidade_origem") | matches("cidade_destino")


def flights_of_city(
    events: DataFrame, flights: Dimension, city: str, any_spelling: bool = False
) -> DataFrame:
    """Flight events whose route touches `city`; the filter runs on the dimension side."""
    routes = flights.reshaped(lambda d: d.where(touches_city(city, any_spelling)))
    return enrich(events, routes)
