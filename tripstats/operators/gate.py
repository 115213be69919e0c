"""Readiness of sources and a look at their backlog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstats.operators.counts import counts_per


def readiness(pending: DataFrame, thresholds: Mapping[str, int]) -> DataFrame:
    """Per configured source: pending messages, threshold, whether it is met, whether all are.

    A source without any message counts 0. The result has one row per configured source.
    """
    limits = F.create_map(*(F.lit(x) for pair in thresholds.items() for x in pair))
    counted = counts_per(pending, "source", list(thresholds), "pending").withColumn(
        "threshold", limits[F.col("source")].cast("bigint")
    )
    ready = counted.withColumn("source_ready", F.col("pending") >= F.col("threshold"))
    return ready.withColumn(
        "batch_ready", F.bool_and("source_ready").over(Window.partitionBy())
    )


def backlog(pending: DataFrame) -> DataFrame:
    """Messages waiting per source."""
    return pending.groupBy("source").agg(F.count(F.lit(1)).alias("pending"))


def peek(pending: DataFrame, order: str, n: int = 6) -> DataFrame:
    """The first `n` messages of each source by `order`.

    The rank filter is planned as a group limit: a task forwards n rows per source at most.
    """
    window = Window.partitionBy("source").orderBy(order)
    return pending.withColumn("position", F.row_number().over(window)).where(
        F.col("position") <= n
    )
