"""Messages to partial statistics, batch by batch.

Both sources feed one query, so a batch holds both and is committed once. Each batch is landed;
as soon as every source has enough messages waiting, all that wait are processed together under
the id of the current batch. A batch that is replayed after a failure finds the same messages
waiting and overwrites the same folders.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripstats.operators.fold import stamped
from tripstats.operators.gate import readiness
from tripstats.operators.lookup import Dimension, within_ids
from tripstats.operators.rollup import flight_cube, hotel_cube
from tripstats.operators.statistics import wide_statistics
from tripstats.schemas import DEFAULT_CITY, DEFAULT_THRESHOLDS, FLIGHT_SOURCE, HOTEL_SOURCE
from tripstats.sources.messages import decode_both
from tripstats.sources.store import USABLE, Store


@dataclass
class Job:
    """What a batch is processed with.

    A dimension that changes while the stream runs is given as a function; every batch calls it,
    and so sees rows added since and measures the size anew.
    """

    store: Store
    hotels: Dimension | Callable[[], Dimension]
    flights: Dimension | Callable[[], Dimension]
    city: str = DEFAULT_CITY
    any_spelling: bool = False
    thresholds: Mapping[str, int] = field(default_factory=lambda: dict(DEFAULT_THRESHOLDS))
    # Last batch processed: read from the store once, then known, as one query owns the store.
    _done: int | None = field(default=None, init=False)
    # Messages per source of batches that wait, so that the gate reads none of them again.
    _waiting: dict[int, dict[str, int]] = field(default_factory=dict, init=False)

    def __call__(self, decoded: DataFrame, batch_id: int) -> None:
        """One micro-batch."""
        if self._done is None:
            self._done = self.store.processed_up_to()
        if batch_id > self._done:
            self._waiting[batch_id] = self.store.land(decoded, batch_id, list(self.thresholds))
            if self.process(range(self._done + 1, batch_id + 1)):
                self._done = batch_id
                self._waiting.clear()

    def _pending(self, batches: range) -> dict[str, int]:
        """Messages per source in `batches`: as counted when landed, or else read once."""
        if any(b not in self._waiting for b in batches):
            gate = readiness(self.store.landed(batches), self.thresholds).collect()
            self._waiting = dict.fromkeys(batches, {})
            self._waiting[batches[-1]] = {row["source"]: row["pending"] for row in gate}
        return {s: sum(self._waiting[b].get(s, 0) for b in batches) for s in self.thresholds}

    def process(self, batches: range) -> bool:
        """Process the messages landed in `batches` if every source has enough of them."""
        batch_id = batches[-1]
        pending = self._pending(batches)
        if any(pending[source] < least for source, least in self.thresholds.items()):
            return False

        waiting = self.store.landed(batches)
        hotels, flights = (d() if callable(d) else d for d in (self.hotels, self.flights))
        start, clock = datetime.now(timezone.utc), time.perf_counter()
        usable = waiting.where(F.col("outcome") == USABLE)
        hotel_events = usable.where(F.col("source") == HOTEL_SOURCE)
        flight_events = usable.where(F.col("source") == FLIGHT_SOURCE)
        # A dimension too large to broadcast is read between the ids of these events only.
        hotels, flights = (
            dim if dim.small else dim.reshaped(partial(within_ids, events=events, key=dim.key))
            for dim, events in ((hotels, hotel_events), (flights, flight_events))
        )
        # Each kind of event is read once; the eleven tables come from the small written cubes.
        cubes = (
            self.store.write_cube("hotel", hotel_cube(hotel_events, hotels), batch_id),
            self.store.write_cube(
                "flight",
                flight_cube(flight_events, flights, self.city, self.any_spelling),
                batch_id,
            ),
        )
        computed = time.perf_counter()
        self.store.write_partials(stamped(wide_statistics(*cubes)), batch_id)
        written = time.perf_counter()
        rows = {
            "hotels": pending.get(HOTEL_SOURCE, 0),
            "flights": pending.get(FLIGHT_SOURCE, 0),
        }
        self.store.log_run(
            batch_id, start, datetime.now(timezone.utc), rows, computed - clock, written - computed
        )
        return True


def start(
    hotel_messages: DataFrame,
    flight_messages: DataFrame,
    job: Job,
    interval: str | None = None,
) -> StreamingQuery:
    """Start the query: every `interval` ('10 seconds'), or once over all there is without it.

    The checkpoint lives in the store, since batch ids only mean something together with it.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        decode_both(hotel_messages, flight_messages)
        .writeStream.foreachBatch(job)
        .option("checkpointLocation", f"{job.store.root}/checkpoint")
        .trigger(**trigger)
        .start()
    )
