"""Quality rules: counts per text, and a likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted, one over trusted documents, one over the
whole corpus. A text's score is the mean log ratio per n-gram. The threshold is the score that
all but a small share of trusted documents reach which the first multinomial has not seen.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.llm.shared import Stored, beside

BUCKETS = 1 << 17
GRAM = 4
SMOOTHING = 1.0
LOST = 0.001  # share of trusted documents that may lie below the threshold
STEP = 0.001  # scores are rounded to this for the threshold
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"


def grams(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the text's overlapping n-grams of bytes."""
    raw = np.frombuffer(text.encode() if text else b"", np.uint8).astype(np.uint32)
    if len(raw) < GRAM:
        return np.empty(0, np.uint32)
    n = len(raw) - GRAM + 1
    joined = raw[:n] | raw[1 : n + 1] << np.uint32(8) | raw[2 : n + 2] << np.uint32(16) | raw[3 : n + 3] << np.uint32(24)
    return (joined * np.uint32(0x9E3779B1)) >> np.uint32(33 - buckets.bit_length())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(" \t\v\f\r"):
            seen.add(line)
    repeated = 0
    if n >= 4:
        names: dict[bytes, int] = {}
        ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
        # Two steps of numbering keep the keys below n * n.
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1].astype(np.int64)
        _, at, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
        hit = np.zeros(n, bool)
        places = np.flatnonzero(times[at] > 1)
        for shift in range(3):
            hit[places + shift] = True
        repeated = int(hit.sum())
    return n, chars, symbols, again, repeated


def _tally(batches):
    raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, chosen in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            found = grams(text.as_py())
            if len(found) * 20 < BUCKETS:
                np.add.at(raw, found, 1)
                if chosen:
                    np.add.at(trusted, found, 1)
            else:
                some = np.bincount(found, minlength=BUCKETS)
                raw += some
                trusted += some * bool(chosen)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(trusted[some])], names=["bucket", "raw", "trusted"])


def _seen() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0


class Ratio:
    """Log ratios per bucket and the threshold, from `docs` and the ids of trusted documents."""

    def __init__(self, docs: DataFrame, trusted: DataFrame, lost: float = LOST):
        docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        ids = Stored(
            trusted.select(F.col("doc_id").cast("long")).where("doc_id IS NOT NULL").distinct()
            .withColumn("trusted", F.lit(True))
        )
        marked = beside(docs, ids, ["doc_id"], "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
        tally = (
            marked.select("text", F.col("trusted") & _seen()).mapInArrow(_tally, "bucket long, raw long, trusted long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toPandas()
        )  # at most BUCKETS rows
        raw, own = np.zeros(BUCKETS), np.zeros(BUCKETS)
        raw[tally["bucket"]], own[tally["bucket"]] = tally["raw"], tally["trusted"]
        both = [np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * BUCKETS)) for x in (own, raw)]
        self.table = ((both[0] - both[1]) if own.any() else np.zeros(BUCKETS)).astype(np.float32)
        rank = F.floor(self.score() / STEP).cast("long").alias("rank")
        bins = (
            marked.where(F.col("trusted") & ~_seen() & (F.size(F.split(F.trim("text"), r"[ \t-\r]+", MIN_WORDS)) >= MIN_WORDS))
            .select(rank).groupBy("rank").count().orderBy("rank").toPandas()
        )  # as many rows as rounded scores there are
        below = bins["count"].cumsum() > lost * bins["count"].sum()
        self.threshold = float(bins["rank"][below].iloc[0]) * STEP if len(bins) else float("-inf")

    def score(self, text: str = "text") -> Column:
        table = self.table

        def mean(texts: pd.Series) -> pd.Series:
            found = (grams(t) for t in texts)
            return pd.Series([float(table[g].mean(dtype=np.float64)) if len(g) else 0.0 for g in found], dtype="float64")

        return F.pandas_udf(mean, "double")(F.col(text).cast("string"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: its counts, base_failed, score and kept.

    Trusted are documents with a label of quality 1. A null text has no words and fails. Without
    trusted documents all ratios are 0 and only the base rules decide.
    """
    ratio = Ratio(docs, labels.where("quality = 1"))
    schema = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    count = F.pandas_udf(
        lambda texts: pd.DataFrame([counts(t) for t in texts], columns=[c.split()[0] for c in schema.split(", ")], dtype="int64"),
        schema,
    )
    return (
        docs.select(F.col("doc_id").cast("long"), count(F.col("text").cast("string")).alias("c"), ratio.score().alias("score"))
        .select("doc_id", "c.*", "score")
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= ratio.threshold))
    )
