"""Totals kept as streaming state, and read from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripstats.operators.lookup import Dimension
from tripstats.operators.rollup import rollup

# What the state holds for a group: the parts of an exact sum, and the count.
_PARTS = "struct<cents:double,rest:double,num_reservas:bigint>"


def keep_live(
    events: DataFrame, dim: Dimension, by: Sequence[str], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start the rollup of a stream of events, or go on with it: every `interval`, or once without.

    The state is the only result: one row per group, partial sums added up in the scan stage
    first, so it is bounded by the groups and not by the events. A restart goes on from the last
    committed batch; a batch that failed is run again from the state before it, so no event
    counts twice. The number of shuffle partitions is that of the first start. Events with unknown or
    null ids drop, as in any rollup.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        rollup(events, dim, by).writeStream.format("noop").outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def live_totals(spark: SparkSession, checkpoint: str, by: Sequence[str], batch: int | None = None) -> DataFrame:
    """`by`, `sum_valor`, `num_reservas` of the state as committed, or as it was after a batch.

    The query may run on meanwhile. Reading is distributed over the partitions of the state.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint).select("key.*", F.col("value").cast(_PARTS).alias("_state"))
    total = F.col("_state.cents") / F.lit(100.0) + F.col("_state.rest")
    return state.select(*by, total.alias("sum_valor"), F.col("_state.num_reservas").alias("num_reservas"))
