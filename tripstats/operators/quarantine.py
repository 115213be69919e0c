"""Rows that break a rule are set aside before a table is written.

A rule is a CHECK or NOT NULL constraint as a SQL condition; as there, null is no violation. A key
held by several rows is a PRIMARY KEY violation of all but one of those that break nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEPT, QUARANTINED = "kept", "quarantined"
KEY_RULE = "key_unique"


def judged(frame: DataFrame, rules: Mapping[str, str], key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """`frame` with `reasons`, the names of the rules a row breaks, in the order of `rules`.

    Of the sound rows of a key the first by `order` stays; the others break KEY_RULE. Rules are
    tested in the scan; the key takes one shuffle by a hash of it, whose partitions hold rows of
    one key only as a stream, so a hot key needs no memory. Rows without a full key are not
    compared. Ties in `order` are rows that the order can't tell apart; any of them stays.
    """
    broken = [F.when(~F.expr(rule), F.lit(name)) for name, rule in rules.items()]
    tested = frame.withColumn("reasons", F.array_compact(F.array(*broken)) if broken else F.expr("CAST(array() AS ARRAY<STRING>)"))
    whole = F.lit(True)
    for column in key:
        whole &= F.col(column).isNotNull()
    sound = (F.size("reasons") == 0) & whole
    # Broken rows come last in their key and rows without a key have one of their own kind.
    of_key = Window.partitionBy(*key).orderBy((~sound).cast("int"), *order)
    return (
        tested.withColumn("_place", F.row_number().over(of_key))
        .withColumn(
            "reasons",
            F.when(sound & (F.col("_place") > 1), F.array(F.lit(KEY_RULE))).otherwise(F.col("reasons")),
        )
        .drop("_place")
    )


def split(judged_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to keep, without reasons, and rows in quarantine, with them."""
    good = F.size("reasons") == 0
    return judged_rows.where(good).drop("reasons"), judged_rows.where(~good)


def write_checked(
    frame: DataFrame, path: str, rules: Mapping[str, str], key: Sequence[str], order: Sequence[str] = ()
) -> str:
    """Write sound and broken rows in one job, side by side; the folder of the sound ones.

    `path`/outcome=kept is the table, sorted by key so that readers skip what they don't need;
    `path`/outcome=quarantined has the rest with its reasons.
    """
    rows = judged(frame, rules, key, order)
    outcome = F.when(F.size("reasons") == 0, KEPT).otherwise(QUARANTINED)
    rows.withColumn("outcome", outcome).sortWithinPartitions("outcome", *key).write.mode("overwrite").partitionBy(
        "outcome"
    ).parquet(path)
    return f"{path}/outcome={KEPT}"


def quarantined(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What `write_checked` set aside of a frame `like` the one written."""
    schema = like.withColumn("reasons", F.expr("CAST(array() AS ARRAY<STRING>)")).withColumn("outcome", F.lit("")).schema
    return spark.read.schema(schema).parquet(path).where(F.col("outcome") == QUARANTINED).drop("outcome")
