"""Documents with similar sets of word n-grams, by prefixes of token combinations.

The tokens of a set (hashes of its shingles) are ordered by how many sets have them, rarest first.
Two sets that are similar enough miss few tokens of each other, so of the first ones at least one
is common. Rare tokens are indexed as they are. Sets with too few rare tokens get a longer prefix,
of which pairs of neighbouring frequent tokens are indexed: among enough common tokens two must
be neighbours in both sets. Candidates whose sketches differ too much are left out, as no pair
differs less than its sketches do; the others are verified on the full sets.

With n tokens, `lost(n)` is how many of them no set that is similar enough can lack more of.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.llm.near_copies import _BASE, WordHashes, _mix
from tripstats.llm.shared import Stored, beside, components

WORDS = 4
PERCENT = 85
RARE = 32  # a token of at most so many sets is indexed alone
SKETCH = 8  # words of 64 bits in which a set's tokens are marked
HUBS = 4  # sets of a crowded bucket against which the others are tried in a round
ROUNDS = 3  # rounds at least in which crowded buckets are tried against some of their sets


def shingles(text: str | None, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    found = text.encode().lower().split() if text else []
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    size = min(n, WORDS)
    h = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        h = h * _BASE + ids[i : n - size + 1 + i]
    return np.unique(_mix(h))


def lost(n: int, percent: int) -> int:
    """Most tokens of a set of `n` that a similar set lacks."""
    return n - -(-percent * n // 100)


def shared_least(n: int, percent: int) -> int:
    """Tokens that a prefix of `lost(n) + shared_least(n)` has in common with a similar set's."""
    return max(1, n // 20)


def expected_shared(n: int, percent: int) -> int:
    """The least `shared_least` of all sets that can be similar to one of `n` tokens."""
    return shared_least(-(-percent * n // 100), percent)


def _first_look(percent: int):
    """Rows doc_id, key, n, prefix: the first tokens of each set in the order of their hashes."""

    def look(batches):
        words = WordHashes()
        for batch in batches:
            n, prefixes = [], []
            for text in batch.column(2):
                own = shingles(text.as_py(), words)
                n.append(len(own))
                prefixes.append(own[: lost(len(own), percent) + shared_least(len(own), percent)].view(np.int64) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "key", "n", "prefix"],
            )

    return look


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Bits of which each says whether an odd number of tokens fell on it."""
    odd = np.bincount(tokens & np.uint64(64 * SKETCH - 1), minlength=64 * SKETCH).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _tokens(batches):
    words = WordHashes()
    for batch in batches:
        found = [shingles(text.as_py(), words) for text in batch.column(1)]
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([t.view(np.int64) for t in found], lists), pa.array([sketch(t) for t in found], lists)],
            names=["node", "tokens", "sketch"],
        )


def signatures(n: int, tokens: np.ndarray, sets: np.ndarray, percent: int, rare: int) -> list[tuple[int, int, bool]]:
    """Buckets of a set of `n` tokens: (bucket, reach, frequent).

    `tokens` are those that other sets have too, `sets` how many have each. A pair that meets in
    a bucket has at most the smaller reach of its sets in common.
    """
    order = np.lexsort((tokens, sets))
    tokens, sets = tokens[order], sets[order]
    alone = n - len(tokens)
    spare = lost(n, percent)
    if n == 1:
        return [(int(x), 1, True) for x in tokens.tolist()]
    if alone > spare:
        return []
    single = int(np.searchsorted(sets, rare, side="right"))
    found = [(int(x), n - alone - i, False) for i, x in enumerate(tokens[: min(single, spare + 1 - alone)].tolist())]
    few = alone + single
    if few <= spare:
        # No common token is rare, or the pair met above: both sets lack each other's rare ones.
        larger = 100 * n // percent
        apart = (100 - percent) * (n + larger) // (100 + percent) - few
        prefix = tokens[single:][: apart + 2 + spare - few].view(np.uint64)
        pairs = _mix(prefix[:-1] * _BASE + prefix[1:])
        found += [(int(x), n - few, True) for x in pairs.view(np.int64).tolist()]
    return found


_SKETCH = [f"s{i}" for i in range(SKETCH)]
_MEMBERS = "bucket long, node long, n long, reach long, frequent boolean, " + ", ".join(f"{c} long" for c in _SKETCH)


def _sign(percent: int, rare: int):
    def sign(batches):
        for batch in batches:
            rows = []
            for node, n, bits, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # A row that is there twice has its tokens twice.
                tokens, at = np.unique(np.array([x["token"] for x in shared], np.int64), return_index=True)
                sets = np.array([x["sets"] for x in shared], np.int64)[at]
                rows += [(b, node, n, reach, frequent, *bits) for b, reach, frequent in signatures(n, tokens, sets, percent, rare)]
                if len(rows) > 50_000:
                    yield _member_batch(rows)
                    rows = []
            if rows:
                yield _member_batch(rows)

    return sign


def _member_batch(rows):
    columns = zip(zip(*rows, strict=True), _MEMBERS.split(", "), strict=True)
    kinds = {"long": pa.int64(), "boolean": pa.bool_()}
    named = {name: pa.array(c, kinds[kind]) for c, (name, kind) in ((c, x.split()) for c, x in columns)}
    return pa.RecordBatch.from_arrays(list(named.values()), names=list(named))


def _enough(common: Column, x: Column, y: Column, percent: int) -> Column:
    """Whether sets of `x` and `y` tokens are similar with `common` ones."""
    return F.lit(100 + percent) * common >= F.lit(percent) * (x + y)


def near(percent: int, x: str, y: str, words: int = SKETCH) -> Column:
    """Whether the sets of `x` and `y` (patterns of column names) can be similar by their sketches."""
    size = F.col(x % "n") + F.col(y % "n")
    differing = sum((F.bit_count(F.col(x % f"s{i}").bitwiseXOR(F.col(y % f"s{i}"))) for i in range(words)), F.lit(0))
    return F.lit(100 + percent) * (size - differing) >= F.lit(2 * percent) * size


def _may_be_similar(percent: int, x: str, y: str) -> Column:
    """Whether the sets of `x` and `y` (patterns of column names) can have enough in common."""
    return _enough(F.least(x % "reach", y % "reach"), F.col(x % "n"), F.col(y % "n"), percent) & near(percent, x, y)


def _common(left, right):
    return left.combine(
        right, lambda x, y: len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True))
    ).astype("int64")


class _Sets:
    """Full sets of the documents that may have a partner, for the verification of pairs."""

    def __init__(self, stored: DataFrame, percent: int):
        self.frame, self.percent = stored, percent

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Of stored pairs a, b with sizes na, nb, those that are links."""
        common = F.pandas_udf(_common, "long")
        side = self.frame.select("node", "tokens")
        both = pairs.join(side.toDF("a", "x"), "a").join(side.toDF("b", "y"), "b")
        return both.withColumn("common", common("x", "y")).where(
            _enough(F.col("common"), F.col("na"), F.col("nb"), self.percent)
        ).select("a", "b")


def _pairs(left: DataFrame, right: DataFrame, percent: int, apart: bool = False, once: bool = False) -> DataFrame:
    """Pairs of nodes that share a bucket and may be similar, by size and reach.

    With `apart`, only those of different components. The left node is the larger one or, with
    `once`, not of the bucket's `main` component; a pair is made in the smallest of the `buckets`
    that its nodes share then, and in no other.
    """
    columns = ["node", "n", "reach", *_SKETCH, *(["component"] if apart else []), *(["main", "buckets"] if once else [])]
    x, y = (side.select("bucket", *(F.col(c).alias(f"{c}_{of}") for c in columns)) for side, of in ((left, "x"), (right, "y")))
    # What is cheap to tell comes first.
    larger = F.col("node_x") > F.col("node_y")
    wanted = x["bucket"] == y["bucket"]
    if apart:
        wanted &= F.col("component_x") != F.col("component_y")
    wanted &= larger | (F.col("component_y") == F.col("main_y")) if once else larger
    wanted &= _may_be_similar(percent, "%s_x", "%s_y")
    if once:
        wanted &= F.array_min(F.array_intersect("buckets_x", "buckets_y")) == x["bucket"]
    first = F.col("node_x") > F.col("node_y")
    pairs = x.join(y, wanted).select(
        *(F.when(first, F.col(f"{c}_x")).otherwise(F.col(f"{c}_y")).alias(a) for c, a in (("node", "a"), ("n", "na"))),
        *(F.when(first, F.col(f"{c}_y")).otherwise(F.col(f"{c}_x")).alias(b) for c, b in (("node", "b"), ("n", "nb"))),
    )
    return pairs if once else pairs.distinct()


def _merged(of: Stored, links: DataFrame) -> Stored:
    """Components `of` nodes (node, component) after further links of nodes; `of` goes."""
    joined = (
        links.join(of.frame.toDF("a", "x"), "a").join(of.frame.toDF("b", "y"), "b").where("x <> y")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    moved = components(joined).toDF("component", "root")
    merged = Stored(of.frame.join(moved, "component", "left").select("node", F.coalesce("root", "component").alias("component")))
    of.drop()
    return merged


def similar_sets(members: DataFrame, sets, percent: int, rounds: int | None = None) -> DataFrame:
    """Component of each node of `members`, rows of _MEMBERS, all links kept.

    A bucket of a rare token has at most RARE nodes. They are tried against the smallest of them
    first, which joins near copies, then the pairs of different components at once. In a bucket
    of frequent tokens every node is tried against HUBS hubs a round, if both lie in different
    components; then the hubs leave. Where `members` have a `weight`, the heaviest nodes are hubs,
    otherwise any. `sets` verifies pairs. When a round from the last of `rounds`
    (ROUNDS) on links less than a tenth of what it
    tried or a twentieth of what all did, pairs that share a bucket and no component are tried.
    These grow faster than the nodes do: if `sets` can tell without verifying them that some are no
    links (`possible`), it is asked before.
    """
    nodes = members.select("node").distinct()
    few = members.where("NOT frequent")
    smallest = few.groupBy("bucket").agg(F.min(F.struct("node", "n", "reach", *_SKETCH)).alias("hub")).select("bucket", "hub.*")
    of = Stored(nodes.select("node", F.col("node").alias("component")))

    def joined(of: Stored, pairs: DataFrame) -> Stored:
        """Components after the links among `pairs`."""
        stored = Stored(pairs)
        merged = _merged(of, sets.verified(stored.frame))
        stored.drop()
        return merged

    of = joined(of, _pairs(few, smallest, percent))
    placed = few.join(of.frame, "node")
    open_ = (
        placed.groupBy("bucket").agg(F.count("*").alias("held"), F.min("component").alias("x"), F.max("component").alias("y"))
        .where("held > 2 AND x < y").select("bucket")
    )
    placed = Stored(placed.join(open_, "bucket", "left_semi"))
    of = joined(of, _pairs(placed.frame, placed.frame, percent, apart=True))
    placed.drop()
    shared = Stored(members.where("frequent"))
    rounds = ROUNDS if rounds is None else rounds
    turn = total = 0
    while True:
        turn += 1
        placed = shared.frame.join(of.frame, "node")
        hub = F.struct("node", "n", "reach", "component", *_SKETCH)
        if "weight" in members.columns:
            part, order = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(HUBS)), F.struct("weight", "node")
            some = F.array_compact(F.array(*(F.max_by(hub, F.when(part == i, order)) for i in range(HUBS))))
        else:
            some = F.array(*(F.min_by(hub, F.xxhash64("node", F.lit(turn * HUBS + i))) for i in range(HUBS)))
        hubs = (
            placed.groupBy("bucket").agg(
                F.array_distinct(some).alias("hubs"), F.min("component").alias("x"), F.max("component").alias("y"),
            ).where("x < y").select("bucket", "hubs")
        )
        met = Stored(placed.join(hubs, "bucket").where(~F.exists("hubs", lambda h: h["node"] == F.col("node"))))
        # Hubs of a bucket are tried among themselves as well.
        both = met.frame.drop("hubs").join(hubs, "bucket").unionByName(
            hubs.select("bucket", F.explode("hubs").alias("one"), "hubs").select("bucket", "one.*", F.lit(True).alias("frequent"), "hubs"),
            allowMissingColumns=True,
        )
        tried = Stored(
            both.select("*", F.explode("hubs").alias("hub")).where("component <> hub.component")
            .where(_may_be_similar(percent, "%s", "hub.%s"))
            .select(
                F.greatest(F.struct("node", "n"), F.struct("hub.node", "hub.n")).alias("x"),
                F.least(F.struct("node", "n"), F.struct("hub.node", "hub.n")).alias("y"),
            )
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).distinct()
        )
        found = Stored(sets.verified(tried.frame))
        n, gained = tried.frame.count(), found.frame.count()
        total += gained
        if gained:
            of = _merged(of, found.frame)
        following = Stored(met.frame.select(members.columns))
        for table in (shared, met, tried, found):
            table.drop()
        shared = following
        if following.frame.isEmpty() or (turn >= rounds and (10 * gained < n or 20 * gained < total)):
            break
    placed = Stored(shared.frame.join(of.frame, "node"))
    shared.drop()
    # Of two nodes of different components one at least is not in the component of any third.
    main = (
        placed.frame.groupBy("bucket").agg(
            F.min_by("component", F.xxhash64("node")).alias("main"), F.min("component").alias("x"), F.max("component").alias("y")
        ).where("x < y").select("bucket", "main")
    )
    met = Stored(placed.frame.join(main, "bucket"))
    placed.drop()
    buckets = met.frame.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))
    crowded = Stored(met.frame.join(buckets, "node"))
    met.drop()
    pairs = Stored(_pairs(crowded.frame.where("component <> main"), crowded.frame, percent, apart=True, once=True))
    crowded.drop()
    if hasattr(sets, "possible"):
        pairs = sets.possible(pairs)
    of = _merged(of, sets.verified(pairs.frame))
    pairs.drop()
    return of.frame


def similar_documents(docs: DataFrame, percent: int = PERCENT, rare: int = RARE) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their shingles; a
    component's id is the smallest doc_id reachable. Null or empty texts have no shingles and
    are linked with nothing. Rows that repeat a doc_id are texts of their own; equal texts are
    linked, short ones too. A row without doc_id can't be named by a component: it is linked
    with nothing and its component is null. An empty table gives an empty result; other columns
    are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.withColumn("key", F.when(F.col("doc_id").isNotNull(), F.unhex(F.md5("text"))))
    looked = Stored(
        docs.select("doc_id", "key", "text")
        .mapInArrow(_first_look(percent), "doc_id long, key binary, n long, prefix array<long>")
    )
    # Equal texts are one node. Numbers are given once and read from the files.
    texts = Stored(
        looked.frame.where("key IS NOT NULL AND n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    chosen = texts.frame.select("key", F.col("first").alias("doc_id"), "node")

    def of_one(frame: DataFrame, named: DataFrame) -> DataFrame:
        """Rows of the first document of each text."""
        small = texts.bytes() <= 16 * 1024 * 1024
        return frame.join(F.broadcast(named) if small else named, ["key", "doc_id"])

    # A set with a similar one shares enough of its first tokens; most sets don't and go here.
    marks = of_one(looked.frame, chosen).select("node", F.explode("prefix").alias("token"))
    seen = marks.groupBy("token").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y").select("token")
    counted = marks.join(seen, "token", "left_semi").groupBy("node").agg(F.count("*").alias("shared"))
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.lit(percent) * F.col("n") / 100) / 20))
    alive = Stored(
        counted.join(texts.frame, "node").where(F.col("shared") >= least).select("key", F.col("first").alias("doc_id"), "node", "n"),
        release=True,
    )
    sets = Stored(
        beside(docs, alive, ["key", "doc_id"], "inner").select("node", "text")
        .mapInArrow(_tokens, "node long, tokens array<long>, sketch array<long>").dropDuplicates(["node"]),
        release=True,
    )
    tokens = sets.frame.select("node", F.explode("tokens").alias("token"))
    held = tokens.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    grouped = tokens.join(held, "token").groupBy("node").agg(F.collect_list(F.struct("token", "sets")).alias("shared"))
    known = sets.frame.select("node", F.size("tokens").cast("long").alias("n"), "sketch")
    members = Stored(
        grouped.join(known, "node").select("node", "n", "sketch", "shared").mapInArrow(_sign(percent, rare), _MEMBERS),
        release=True,
    )
    binary = Stored(sets.frame.mapInArrow(_packed, "node long, tokens binary"))
    sets.drop()
    of = similar_sets(members.frame, _Sets(binary.frame, percent), percent)
    ids = texts.frame.join(of, "node", "left").select("key", "first", F.coalesce("component", "node").alias("component"))
    least_id = ids.groupBy("component").agg(F.min("first").alias("component_id"))
    named = Stored(ids.join(least_id, "component").select("key", "component_id"))
    rows = looked.frame.select("doc_id", F.col("n").alias("n_shingles"), "key")
    return beside(rows, named, ["key"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _packed(batches):
    for batch in batches:
        found = [np.sort(np.array(t, np.int64)).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "tokens"])


def report(docs: DataFrame) -> DataFrame:
    return similar_documents(docs)
