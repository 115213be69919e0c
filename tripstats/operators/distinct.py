"""Distinct counts that add up: exact bitmaps per group, merged by OR.

A count of distinct values can't be added to another one, as both may have the same values. A bitmap
can: bit n says that value number n is there. Numbers come from the dimension that the values are
columns of, so batches agree on them; a bitmap is held in buckets of 32,768 bits, and only buckets
with a bit exist. A group's size is bounded by the dimension, not by its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMBER = "number"


def numbered(dimension: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The dimension with `number`: the smallest key of a row with the same `values`.

    Null where a value is null; keys must not be negative. Rows added with larger keys leave
    the numbers as they are.
    """
    lowest = dimension.groupBy(*values).agg(F.min(key).cast("long").alias(NUMBER))
    return dimension.join(lowest, list(values), "left")


def bitmaps(rows: DataFrame, by: Sequence[str], number: str = NUMBER) -> DataFrame:
    """Bitmaps of the numbers of each group: `by`, `bucket`, `bits`; null numbers are left out."""
    return (
        rows.where(F.col(number).isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def merged(by: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Bitmaps of `parts` together, by fewer or the same columns."""
    rows = reduce(DataFrame.unionByName, (p.select(*by, "bucket", "bits") for p in parts))
    return rows.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bits: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many distinct values each group has."""
    return bits.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
