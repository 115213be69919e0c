"""Integrity rules of the dimensions and totals: not null, ranges, unique keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.operators.counts import unfolded
from tripstats.schemas import StatTable

HOTEL_RULES = {
    "id_hotel_not_null": "id_hotel IS NOT NULL",
    "cidade_not_null": "cidade IS NOT NULL",
    "estrelas_1_to_5": "estrelas BETWEEN 1 AND 5",
}
FLIGHT_RULES = {
    "id_voo_not_null": "id_voo IS NOT NULL",
    "cidade_origem_not_null": "cidade_origem IS NOT NULL",
    "cidade_destino_not_null": "cidade_destino IS NOT NULL",
    "origem_differs": "cidade_origem <> cidade_destino",
    "dia_1_to_31": "dia BETWEEN 1 AND 31",
    "mes_1_to_12": "mes BETWEEN 1 AND 12",
    "ano_positive": "ano > 0",
}


def rules_of(table: StatTable) -> dict[str, str]:
    """Key and value columns of a statistic table must not be null."""
    return {f"{c}_not_null": f"{c} IS NOT NULL" for c in table.columns}


def violations(
    frame: DataFrame, rules: Mapping[str, str], key: Sequence[str], label: str
) -> DataFrame:
    """Number of rows that break each rule, and of keys held by more than one row.

    As in a CHECK constraint, a rule that is null is not broken. Rules and key are checked in
    one aggregation; what is shuffled is one row per key and task.
    """
    broken = [F.count_if(~F.expr(rule)).alias(f"r{i}") for i, rule in enumerate(rules.values())]
    per_key = frame.groupBy(*key).agg(F.count(F.lit(1)).alias("held"), *broken)
    totals = per_key.agg(
        F.count_if(F.col("held") > 1).alias("shared_keys"),
        *(F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"r{i}") for i in range(len(rules))),
    )
    named = {rule: f"r{i}" for i, rule in enumerate(rules)} | {"key_unique": "shared_keys"}
    return unfolded(
        totals,
        [
            {"table": F.lit(label), "rule": F.lit(rule), "violations": F.col(column)}
            for rule, column in named.items()
        ],
    )
