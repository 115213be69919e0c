"""Near-duplicate documents by MinHash.

Sets of five-word shingles, universal hash minima, banding, comparison of signatures, exact
comparison of the full sets, and connected components by large-star and small-star.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.shared import Stored, beside, components, linked_in_buckets

WORDS = 5
BANDS, ROWS = 28, 4  # a pair at 0.75 shares no band once in 40,000 times
HASHES = BANDS * ROWS
SIGNATURE_SHARE = 0.55  # at 0.75, five standard deviations below what signatures agree on
CACHED_WORDS = 300_000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    seeds = _mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * _BASE)
    return seeds[:HASHES] | np.uint64(1), seeds[HASHES:]


class WordHashes(dict):
    """Hash of each word, kept for words that come again; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


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


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        block = a[:, None] * hashes[None, at : at + 1024]
        block += b[:, None]
        np.minimum(low, block.min(axis=1), out=low)
    return low


_SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"


def _sign(batches):
    a, b = _coefficients()
    words = WordHashes()
    band = np.arange(1, BANDS + 1, dtype=np.uint64) * _BASE
    for batch in batches:
        n, digests, bands, signatures = [], [], [], []
        for text in batch.column(1):
            h = shingles(text.as_py(), words)
            n.append(len(h))
            if not len(h):
                digests.append(None)
                bands.append(None)
                signatures.append(None)
                continue
            low = minima(h, a, b)
            key = band.copy()
            for column in low.reshape(BANDS, ROWS).T:
                key = _mix(key * _BASE + column)
            digests.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
            bands.append(key.view(np.int64))
            signatures.append((_mix(low) >> np.uint64(56)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "digest", "bands", "signature"],
        )


def _sets(batches):
    words = WordHashes()
    for batch in batches:
        sets = [shingles(text.as_py(), words).tobytes() for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "set"])


def _arrays(batches):
    words = WordHashes()
    for batch in batches:
        tokens = [shingles(text.as_py(), words).view(np.int64) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.list_(pa.int64()))], names=["node", "tokens"])


def _agreement(left, right):
    if not len(left):
        return left.astype(float)
    x = np.frombuffer(b"".join(left), np.uint8).reshape(len(left), -1)
    y = np.frombuffer(b"".join(right), np.uint8).reshape(len(left), -1)
    return (x == y).mean(axis=1).astype(float) + 0 * left.index


def _common(left, right):
    return left.combine(
        right,
        lambda x, y: len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)),
    ).astype("int64")


def near_copies(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their shingles;
    a component's id is its smallest doc_id, and that document is kept. Null or empty texts have
    no shingles and are linked with nothing. Rows that repeat a doc_id share one verdict. A row
    without doc_id can't be named by a component: it is linked with nothing, its component is
    null and it is kept. An empty table gives an empty result; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = Stored(docs.mapInArrow(_sign, _SIGNED)).frame
    named = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = Stored(named.groupBy("digest").agg(F.min("doc_id").alias("node")))
    chosen = Stored(
        named.join(classes.frame.select(F.col("node").alias("doc_id"), "digest"), ["doc_id", "digest"])
        .select(F.col("doc_id").alias("node"), "n_shingles", "bands", "signature")
    )
    side = chosen.frame.select("node", "n_shingles", "signature")
    agreement, common = F.pandas_udf(_agreement, "double"), F.pandas_udf(_common, "long")

    def confirmed(pairs: DataFrame) -> DataFrame:
        x = side.toDF("a", "na", "sa")
        y = side.toDF("b", "nb", "sb")
        alike = Stored(
            pairs.join(x, "a").join(y, "b")
            .where(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb"))
            .where(agreement("sa", "sb") >= SIGNATURE_SHARE * percent / 75)
            .select("a", "b", "na", "nb").distinct()
        )
        needed = Stored(alike.frame.select("a").union(alike.frame.select("b")).distinct().toDF("doc_id"))
        sets = beside(docs, needed, ["doc_id"], "left_semi").mapInArrow(_sets, "doc_id long, set binary")
        sets = Stored(sets.dropDuplicates(["doc_id"]))
        links = (
            alike.frame.join(sets.frame.toDF("b", "y"), "b").join(sets.frame.toDF("a", "x"), "a")
            .withColumn("common", common("x", "y"))
            .where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("common")))
            .select("a", "b")
        )
        done = Stored(links)
        for table in (alike, needed, sets):
            table.drop()
        return done.frame

    def tokens_of(nodes: Stored) -> DataFrame:
        named = docs.withColumnRenamed("doc_id", "node")
        sets = beside(named, nodes, ["node"], "left_semi").mapInArrow(_arrays, "node long, tokens array<long>")
        return sets.select("node", F.explode("tokens").alias("token")).distinct()

    members = chosen.frame.select(F.explode("bands").alias("bucket"), "node").distinct()
    found = components(linked_in_buckets(members, confirmed, tokens_of, percent))
    of = Stored(
        classes.frame.join(found, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("component"))
    )
    rows = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    return beside(rows, of, ["digest"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
