"""Secrets in texts, with DataFrame functions only.

Base patterns stand on their own. Weak parts (identifiers, keys, endpoints) count only where
parts that complement them lie within a scope of SCOPE characters: an interval join on buckets
of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.llm.shared import Stored, beside

SCOPE = 200
SLICE = 512  # pieces of a text that are folded together, an even number
BUCKET = 256

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Kind, pattern, role. Runs of a class are matched whole, so a lower bound in the pattern drops
# the short ones; a short assignment still takes up its characters and is dropped afterwards, as
# is a weak key without a digit, an upper and a lower case letter.
BASE = (
    ("assign", ASSIGN, "secret"),
    ("access", r"AKIA[A-Z0-9]{14,}", "id"),
    ("hex", r"[0-9a-f]{16,}", "secret"),
)
WEAK = (
    ("weak_id", r"""(?i:access_?key(?:_?id)?|client_?id|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}""", "id"),
    ("weak_key", r"[A-Za-z0-9+/]{20,}={0,2}", "secret"),
    ("endpoint", r"""(?i:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|ssh)://[^\s"'<>]{4,}""", "endpoint"),
)
# Characters that mark matches; those a text has itself are exchanged for a third, one for one.
OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ue002"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _spans(text: Column, kind: str, order: int, pattern: str, role: str) -> Column:
    """Array of (start, end, order, kind, role) of the leftmost matches that don't overlap."""
    marked = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, f"{OPEN}$0{CLOSE}"))
    none = F.array().cast("array<struct<start:int,end:int,order:int,kind:string,role:string>>")

    def step(seen: Column, piece: Column) -> Column:
        end = seen["at"] + F.length(piece)
        span = F.struct(
            seen["at"].alias("start"), end.alias("end"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), F.lit(role).alias("role")
        )
        match = seen["odd"]
        if kind == "assign":
            match = match & (F.length(F.regexp_extract(piece, pattern, 2)) >= 12)
        if kind == "weak_key":
            match = match & piece.rlike("[0-9]") & piece.rlike("[A-Z]") & piece.rlike("[a-z]")
        found = F.when(match, F.concat(seen["found"], F.array(span))).otherwise(seen["found"])
        return F.struct(end.alias("at"), (~seen["odd"]).alias("odd"), found.alias("found"))

    def folded(pieces: Column) -> Column:
        """Spans of the pieces of one slice, from its own start, and its length."""
        start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("odd"), none.alias("found"))
        return F.aggregate(pieces, start, step, lambda x: F.struct(x["at"].alias("size"), x["found"].alias("found")))

    # An aggregate copies what it has found at each piece, so texts of many matches are folded
    # slice by slice; slices have an even number of pieces and begin outside a match.
    def sliced(pieces: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / SLICE))
        return F.transform(numbers, lambda i: folded(F.slice(pieces, (i * SLICE + 1).cast("int"), SLICE)))

    def joined(parts: Column) -> Column:
        """Spans of slices put one after the other."""
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            parts, first,
            lambda seen, part: F.struct((seen["at"] + part["size"]).alias("at"), F.concat(seen["starts"], F.array(seen["at"])).alias("starts")),
            lambda x: x["starts"],
        )

        def moved(by: Column, part: Column) -> Column:
            return F.transform(
                part["found"],
                lambda s: F.struct(
                    (s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["order"].alias("order"), s["kind"].alias("kind"), s["role"].alias("role")
                ),
            )

        return F.flatten(F.zip_with(starts, parts, moved))

    def spans(pieces: Column) -> Column:
        return F.when(F.size(pieces) <= SLICE, folded(pieces)["found"]).otherwise(_let(sliced(pieces), joined))

    return F.coalesce(_let(F.split(marked, f"[{OPEN}{CLOSE}]", -1), spans), none)


def _written(spans: Column) -> Column:
    ordered = F.array_sort(spans)  # by start, end, order: of one kind no two start together
    ordered = F.array_sort(F.transform(ordered, lambda s: F.struct(s["start"], s["order"], s["end"], s["kind"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _buckets(start: Column, end: Column) -> Column:
    return F.sequence(F.floor(start / BUCKET), F.floor(end / BUCKET))


def linked_parts(parts: DataFrame) -> DataFrame:
    """Weak parts that complementary parts lie near, from rows key, start, end, order, kind, role.

    An identifier needs a secret, a secret needs an identifier or an endpoint, an endpoint needs
    both. Parts that overlap a base span are part of it and left out.
    """
    weak = parts.where(F.col("order") >= len(BASE)).withColumn(
        "bucket", F.explode(_buckets(F.greatest(F.col("start") - SCOPE, F.lit(0)), F.col("end") + SCOPE))
    )
    near = parts.select(
        "key", F.explode(_buckets(F.col("start"), F.col("end"))).alias("bucket"), F.col("start").alias("s"),
        F.col("end").alias("e"), F.col("order").alias("o"), F.col("role").alias("near"),
    )
    base = F.col("o") < len(BASE)
    overlaps = (F.col("s") < F.col("end")) & (F.col("e") > F.col("start"))
    return (
        weak.join(near, ["key", "bucket"])
        .where((F.col("s") <= F.col("end") + SCOPE) & (F.col("e") >= F.col("start") - SCOPE))
        .groupBy("key", "start", "end", "order", "kind", "role")
        .agg(
            F.max(base & overlaps).alias("inside"),
            *(F.max(~overlaps & (F.col("near") == r)).alias(f"by_{r}") for r in ("id", "secret", "endpoint")),
        )
        .where(~F.col("inside"))
        .where(
            F.when(F.col("role") == "id", F.col("by_secret"))
            .when(F.col("role") == "secret", F.col("by_id") | F.col("by_endpoint"))
            .otherwise(F.col("by_id") & F.col("by_secret"))
        )
        .select("key", F.struct("start", "end", "order", "kind", "role").alias("span"))
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: counts of base spans, their digest, and all spans as text.

    A null text is empty. Positions are code points, ends exclusive. Equal rows get equal results.
    """
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), OPEN + CLOSE, OTHER + OTHER)
    found = Stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
        .select(
            "doc_id", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "t")).alias("key"),
            *(_spans(F.col("t"), kind, i, pattern, role).alias(kind) for i, (kind, pattern, role) in enumerate(BASE + WEAK)),
        )
    ).frame
    kinds = [kind for kind, *_ in BASE]
    weak = [kind for kind, *_ in WEAK]
    parts = (
        found.where(sum((F.size(k) for k in weak), F.lit(0)) > 0).dropDuplicates(["key"])
        .select("key", F.explode(F.concat(*kinds, *weak)).alias("p")).select("key", "p.*")
    )
    extra = Stored(linked_parts(parts).groupBy("key").agg(F.collect_set("span").alias("extra")))
    base = F.concat(*kinds)
    return beside(found, extra, ["key"], "left").select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.when(F.col("extra").isNull(), base).otherwise(F.concat(base, "extra"))).alias("spans"),
    )
