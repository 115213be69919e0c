"""Repair of conversations: the cheapest edits that give alternating roles.

Repair items are derived by weighted deductions: `at(i, q)`, the first i rows are edited and their
roles lead to state q, together with an edit of row i or an insertion, gives a further item. The
agenda pops items by (cost, audit); an item popped is final (Knuth's lightest derivation).

A conversation of any length is cut into segments. Every segment is derived by itself, from every
state to every state, and the segments of a conversation are chained in order.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstats.llm.shared import Stored

BLANKS = " \t\n\x0b\x0c\r"
SEGMENT_ROWS = 256
SEGMENT_CHARS = 4_000_000

# States of roles that fit (s?(ua)+)?: nothing yet, after s, after u, after a.
START, ENDS = "e", "ea"
NEXT = {("e", "s"): "s", ("e", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
KEEP, REROLE, DELETE, INSERT = ("K", 0), ("R", 3), ("D", 4), ("I", 3)
TRUNCATED = 3
# A row as a symbol: its role's initial (x: no role that may stay), in upper case if the text is
# truncated, or GONE if it has to be deleted.
GONE = "-"


def edits(symbol: str) -> list[tuple[tuple[int, str], str]]:
    """Weights (cost, audit) of the edits of a row, and the initial each leaves ('' for none)."""
    found = [((DELETE[1], DELETE[0]), "")]
    if symbol != GONE:
        more = TRUNCATED if symbol.isupper() else 0
        if symbol.lower() != "x":
            found.append(((KEEP[1] + more, KEEP[0]), symbol.lower()))
        found += [((REROLE[1] + more, REROLE[0]), role) for role in "ua"]
    return found


@lru_cache(maxsize=20_000)
def derived(symbols: str, start: str) -> dict[str, tuple[int, str]]:
    """Lightest (cost, audit) from state `start` before the rows to each state after them.

    A deduction joins an item with an edit; costs add up and audits are joined, which is monotone
    and superior: of two derivations of one item with equal costs, neither audit begins the other,
    as they differ by more than insertions.
    """
    n = len(symbols)
    facts = [edits(s) for s in symbols]
    agenda: list[tuple[int, str, int, str]] = [(0, "", 0, start)]
    final: dict[tuple[int, str], tuple[int, str]] = {}
    best: dict[tuple[int, str], tuple[int, str]] = {(0, start): (0, "")}
    ends: dict[str, tuple[int, str]] = {}
    while agenda:
        cost, audit, at, state = heappop(agenda)
        if (at, state) in final:
            continue
        final[at, state] = cost, audit
        if at == n:
            ends[state] = cost, audit
        found = [(INSERT[1], INSERT[0], at, NEXT[state, role]) for role in "ua" if (state, role) in NEXT]
        if at < n:
            for (more, letter), role in facts[at]:
                to = NEXT.get((state, role)) if role else state
                if to:
                    found.append((more, letter, at + 1, to))
        for more, letter, to_at, to in found:
            item, weight = (to_at, to), (cost + more, audit + letter)
            if item not in final and (item not in best or weight < best[item]):
                best[item] = weight
                heappush(agenda, (*weight, to_at, to))
    return ends


class Chain:
    """Lightest path through the segments so far, per state; paths share their beginnings."""

    def __init__(self):
        self.paths: dict[str, tuple] = {START: (0, None)}  # cost, (path before, segment, state before, audit)

    def add(self, segment: int, table: dict[str, dict[str, tuple[int, str]]]) -> None:
        following: dict[str, tuple] = {}
        for start, (cost, before) in self.paths.items():
            for end, (more, audit) in table.get(start, {}).items():
                path = (cost + more, (before, segment, start, audit))
                if end not in following or self._lighter(path, following[end]):
                    following[end] = path
        self.paths = following

    @staticmethod
    def _lighter(x: tuple, y: tuple) -> bool:
        if x[0] != y[0]:
            return x[0] < y[0]
        # Equal costs: audits decide, from where the paths part.
        (p, q), left, right = (x[1], y[1]), [], []
        while p is not q:
            left.append(p[3])
            right.append(q[3])
            p, q = p[0], q[0]
        return "".join(reversed(left)) < "".join(reversed(right))

    def result(self) -> tuple[int, list[tuple[int, str, str]]]:
        """Cost and, per segment, its number, the state before it and its edits."""
        best = None
        for state in ENDS:
            path = self.paths.get(state)
            if path and (best is None or self._lighter(path, best)):
                best = path
        steps, path = [], best[1]
        while path:
            path, segment, start, audit = path
            steps.append((segment, start, audit))
        return best[0], steps[::-1]


def repaired(rows: list[tuple[str, str]], start: str, audit: str) -> list[str]:
    """`role:text` of what the edits leave of the rows (role, text)."""
    state, left, out = start, iter(rows), []
    for letter in audit:
        role, text = ("", "") if letter == INSERT[0] else next(left)
        if letter == DELETE[0]:
            continue
        if letter != KEEP[0]:
            role = "assistant" if state == "u" else "user"
        state = NEXT[state, role[0]]
        out.append(f"{role}:{text}")
    return out


def damaged(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text) with rows lost, emptied, repeated or changed by a hash."""
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *as_text).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return (
        rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("_kind"))
        .where("_kind <> 0")
        .withColumn(
            "text", F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
        )
        .withColumn("role", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))))
        .drop("_kind", "_copy")
    )


def _key() -> Column:
    """Conversations by name; those without one are one conversation."""
    return F.when(F.col("conv_id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string")))


def examined(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) in order, with their faults, symbols and segments."""
    rows = rows.select(_key().alias("key"), "turn", "role", "text")
    in_order = Window.partitionBy("key").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    rows = (
        rows.withColumn("pos", F.row_number().over(in_order))
        .withColumn("chars", F.sum(F.length("text").cast("long")).over(so_far))
        .withColumn("pair", F.concat(F.lag(initial).over(in_order), initial))
        .withColumn("nth", F.row_number().over(Window.partitionBy("key", "role", "text").orderBy("pos")))
        .withColumn(
            "fault",
            F.when(bare == "", "blank").when(F.col("nth") > 1, "duplicate")
            .when(~F.substring(bare, -1, 1).isin(*".!?"), "truncated"),
        )
    )
    plain = F.when(initial.isin(*"sua"), initial).otherwise("x")
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(plain)).otherwise(plain)
    )
    segment = F.floor((F.col("pos") - 1) / SEGMENT_ROWS) + F.floor(F.col("chars") / SEGMENT_CHARS)
    return rows.select("key", "pos", segment.cast("long").alias("segment"), "turn", "role", "text", "fault", "pair", symbol.alias("symbol"))


_TABLE = "array<struct<start:string,end:string,cost:long,audit:string>>"


def _derive(batches):
    kind = pa.list_(pa.struct([("start", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        tables = []
        for segment, symbols in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            starts = START if segment == 0 else "esua"
            tables.append([
                {"start": s, "end": e, "cost": cost, "audit": audit}
                for s in starts for e, (cost, audit) in derived(symbols, s).items()
            ])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tables, kind)], names=["key", "segment", "table"])


def _conversations(batches, width: int):
    """Rows of each conversation, which come one after the other, as (key, iterator of rows)."""
    from itertools import groupby

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(width)), strict=True)

    return groupby(rows(), key=lambda row: row[0])


def _batched(rows, schema: pa.Schema, size: int = 1000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _chain(batches):
    def steps():
        for key, rows in _conversations(batches, 3):
            chain = Chain()
            for _, segment, table in rows:
                own: dict[str, dict[str, tuple[int, str]]] = {}
                for x in table:
                    own.setdefault(x["start"], {})[x["end"]] = x["cost"], x["audit"]
                chain.add(segment, own)
            cost, found = chain.result()
            for segment, start, audit in found:
                yield key, segment, start, audit, cost

    yield from _batched(
        steps(),
        pa.schema([("key", pa.string()), ("segment", pa.int64()), ("start", pa.string()), ("audit", pa.string()), ("cost", pa.int64())]),
    )


def _write(batches):
    def pieces():
        for batch in batches:
            for key, segment, start, audit, cost, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = repaired([(r["role"], r["text"]) for r in rows], start, audit)
                yield key, segment, audit, cost, "\n".join(lines) if lines else None

    yield from _batched(
        pieces(),
        pa.schema([("key", pa.string()), ("segment", pa.int64()), ("audit", pa.string()), ("cost", pa.int64()), ("piece", pa.string())]),
        size=64,
    )


def _digest(batches):
    def results():
        for key, rows in _conversations(batches, 5):
            digest, audits, cost, some = hashlib.sha256(), [], 0, False
            for _, _, audit, cost, piece in rows:
                audits.append(audit)
                if piece is not None:
                    digest.update((("\n" if some else "") + piece).encode())
                    some = True
            yield key, cost, "".join(audits), digest.hexdigest()

    yield from _batched(
        results(),
        pa.schema([("key", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]),
    )


def repaired_pieces(rows: DataFrame) -> DataFrame:
    """Of rows as `examined` gives them: key, segment, audit, cost of the conversation, piece.

    `piece` is the repaired text of the segment, null if nothing is left of it.
    """
    in_order = F.array_sort(F.collect_list(F.struct("pos", "symbol")))  # of one segment, so bounded
    symbols = rows.groupBy("key", "segment").agg(F.array_join(in_order["symbol"], "").alias("symbols"))
    tables = symbols.mapInArrow(_derive, f"key string, segment long, table {_TABLE}")
    chosen = Stored(
        tables.repartition("key").sortWithinPartitions("key", "segment")
        .mapInArrow(_chain, "key string, segment long, start string, audit string, cost long")
    ).frame
    texts = rows.groupBy("key", "segment").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text"))).alias("rows"))
    return (
        chosen.join(texts, ["key", "segment"]).select("key", "segment", "start", "audit", "cost", "rows")
        .mapInArrow(_write, "key string, segment long, audit string, cost long, piece string")
    )


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows` (conv_id, turn, role, text), which are taken as they are.

    Columns: key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Rows
    come by turn (nulls first), role and text. A null role or text is one space. A role that
    begins with none of s, u, a (an empty one too) can't be kept. Columns of other names are not
    read; an empty table gives an empty result.
    """
    plain = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    seen = Stored(examined(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *plain))).frame
    counts = seen.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
        F.count_if(~F.col("pair").isin("su", "ua", "au")).alias("illegal"),
    )
    found = (
        repaired_pieces(seen).repartition("key").sortWithinPartitions("key", "segment")
        .mapInArrow(_digest, "key string, cost long, audit string, repaired_sha256 string")
    )
    return counts.join(found, "key")


def report(conversations: DataFrame) -> DataFrame:
    """Per conv_id of `conversations`: the faults of its damaged rows and their cheapest repair.

    A conversation of which no row is left has zeros, an empty audit and the hash of no text.
    """
    found = repaired_conversations(damaged(conversations))
    names = conversations.select("conv_id", _key().alias("key")).distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return names.join(found, "key", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
