"""Incremental maintenance of the joined totals.

Total revenue and ticket inputs join hotel with flight aggregates. With H and F the aggregates so
far and dH, dF those of new batches, the join after them is

    (H + dH) join (F + dF)  =  H join F  +  dH join F  +  H join dF  +  dH join dF,

where + adds what is summed under a key. So a fold needs the new batches and, of what stands, only
the keys they touch; the result does not depend on how the batches were cut.

The state of both sides is one table: per company, axis (month or city) and key the amounts of
hotels and of flights, how many bookings each has, and the months of each as bits (a city's
month groups are counted, and a month that comes again in a later batch is no new group).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstats.functions import exact_add, exact_sum, exact_sum_over

MONTH, CITY = "mes", "cidade"
SIDES_KEY = ("company_id", "axis", "axis_key")
SIDES = (
    "company_id STRING, axis STRING, axis_key STRING, h_valor DOUBLE, f_valor DOUBLE, "
    "h_num BIGINT, f_num BIGINT, h_meses INT, f_meses INT"
)
_AMOUNTS, _COUNTS, _MASKS = ("h_valor", "f_valor"), ("h_num", "f_num"), ("h_meses", "f_meses")
_VALUES = [*_AMOUNTS, *_COUNTS, *_MASKS]
_KINDS = {c: "double" for c in _AMOUNTS} | {c: "long" for c in _COUNTS} | {c: "int" for c in _MASKS}


def _month_bit(month: str) -> Column:
    return F.expr(f"shiftleft(1, coalesce({month}, 0))")


def _merged() -> list[Column]:
    """Sums of amounts and counts, unions of months; null where a side has no rows."""
    return [
        *(exact_sum(c).alias(c) for c in _AMOUNTS),
        *(F.sum(c).alias(c) for c in _COUNTS),
        *(F.bit_or(c).alias(c) for c in _MASKS),
    ]


def sides(hotels: DataFrame, flights: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Both sides of the joins from the hotel and the flight cube, in one aggregation.

    A row per company, axis and key. Null keys join nothing and are left out. `also` names
    further keys, such as a batch id.
    """
    h = hotels.select(
        *also, "company_id", F.col("mes_reserva").alias("mes"), "cidade", F.col("sum_valor").alias("h_valor"),
        F.col("num_reservas").alias("h_num"), _month_bit("mes_reserva").alias("h_meses"),
    )
    f = flights.select(
        *also, "company_id", F.month("dia_reserva").alias("mes"), F.col("cidade_destino").alias("cidade"),
        F.col("sum_valor").alias("f_valor"), F.col("num_reservas").alias("f_num"),
        _month_bit("month(dia_reserva)").alias("f_meses"),
    )
    stacked = h.unionByName(f, allowMissingColumns=True)
    keyed = stacked.select(
        "*", F.inline(F.array(
            F.struct(F.lit(MONTH).alias("axis"), F.col("mes").cast("string").alias("axis_key")),
            F.struct(F.lit(CITY).alias("axis"), F.col("cidade").alias("axis_key")),
        )),
    )
    return (
        keyed.where("company_id IS NOT NULL AND axis_key IS NOT NULL")
        .groupBy(*also, *SIDES_KEY).agg(*_merged()).select(*also, *SIDES_KEY, *_VALUES)
    )


def delta(standing: DataFrame, new: DataFrame) -> DataFrame:
    """What the `new` sides change in the joined totals over the `standing` ones.

    Columns: the key, `valor`, `num` and `reservas` (changes of revenue, month groups and bookings
    of a key both sides have, null for others), and the merged sides. What stands is looked up
    for the keys of the new sides only.
    """
    old = standing.select(*SIDES_KEY, *(F.col(c).alias(f"o_{c}") for c in _VALUES))
    return _changes(new.join(old, list(SIDES_KEY), "left"))


def changes_by_batch(sides_of_batches: DataFrame, batch: str = "batch_id") -> DataFrame:
    """`delta` of every batch over all batches before it, in one pass over the batches' sides.

    The standing sides of a key are running sums over its batches, so no fold waits for another.
    """
    before = Window.partitionBy(*SIDES_KEY).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    running = {
        **{c: exact_sum_over(c, before) for c in _AMOUNTS},
        **{c: F.sum(c).over(before) for c in _COUNTS},
        **{c: F.bit_or(c).over(before) for c in _MASKS},
    }
    return _changes(sides_of_batches.select("*", *(v.alias(f"o_{c}") for c, v in running.items())), batch)


def _changes(rows: DataFrame, *also: str) -> DataFrame:
    merged = {
        **{c: _with_old(c, exact_add) for c in _AMOUNTS},
        **{c: _with_old(c, lambda x, y: F.col(x) + F.col(y)) for c in _COUNTS},
        **{c: _with_old(c, lambda x, y: F.col(x).bitwiseOR(F.col(y))) for c in _MASKS},
    }
    wide = rows.select("*", *(v.alias(f"m_{c}") for c, v in merged.items()))
    met_before = F.col("o_h_num").isNotNull() & F.col("o_f_num").isNotNull()
    meets = F.col("m_h_num").isNotNull() & F.col("m_f_num").isNotNull()
    # Sides that met before gain what is new; sides that meet now bring all they have.
    zero = [F.coalesce(F.col(c), F.lit(0.0)) for c in _AMOUNTS]
    amount = F.when(met_before, exact_add(*zero)).otherwise(exact_add("m_h_valor", "m_f_valor"))

    def gained(of) -> Column:
        return of("m_") - F.when(met_before, of("o_")).otherwise(0)

    def groups(p: str) -> Column:
        return (F.bit_count(f"{p}h_meses") + F.bit_count(f"{p}f_meses")).cast("long")

    changes = {
        "valor": amount,
        "num": gained(groups),
        "reservas": gained(lambda p: F.col(f"{p}h_num") + F.col(f"{p}f_num")),
    }
    return wide.select(
        *also, *SIDES_KEY, *(F.when(meets, v).alias(c) for c, v in changes.items()), *(F.col(f"m_{c}").alias(c) for c in _VALUES)
    )


def _with_old(column: str, add) -> Column:
    """New and old value together; the one there is where the other is missing."""
    old = f"o_{column}"
    return F.when(F.col(column).isNull(), F.col(old)).when(F.col(old).isNull(), F.col(column)).otherwise(add(column, old))


def merge_sides(*parts: DataFrame) -> DataFrame:
    """Sides of all `parts` together, in one aggregation."""
    rows = reduce(DataFrame.unionByName, (p.select(*SIDES_KEY, *_VALUES) for p in parts))
    return rows.groupBy(*SIDES_KEY).agg(*_merged())


def _also(change: DataFrame) -> list[str]:
    known = {*SIDES_KEY, *_VALUES, "valor", "num", "reservas"}
    return [c for c in change.columns if c not in known]


def total_changes(change: DataFrame) -> DataFrame:
    """Changes of total revenue per company and month."""
    some = change.where((F.col("axis") == MONTH) & F.col("valor").isNotNull())
    return some.select(*_also(change), "company_id", F.col("axis_key").cast("int").alias("mes_reserva"), F.col("valor").alias("total_valor"))


def ticket_changes(change: DataFrame) -> DataFrame:
    """Changes of revenue and transactions (month groups) per company and city."""
    some = change.where((F.col("axis") == CITY) & F.col("valor").isNotNull())
    return some.select(
        *_also(change), "company_id", F.col("axis_key").alias("cidade_destino"), F.col("valor").alias("sum_valor"), F.col("num").alias("num_transacoes")
    )


def joined_totals(standing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Total revenue and ticket inputs that follow from the sides as they stand, row by row."""
    change = _changes(standing.select("*", *(F.lit(None).cast(kind).alias(f"o_{c}") for c, kind in _KINDS.items())))
    return total_changes(change), ticket_changes(change)
