"""Language identification by mixtures: which languages a text is made of, and how much of each."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
CELLS = 1 << 25  # most numbers in a model; with more languages, fewer buckets
GRAM = 4
SMOOTHING = 0.5
ITERATIONS = 20
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
# ASCII without letters becomes space.
_LETTERS = bytes(b if b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))


def grams(text: str, buckets: int) -> np.ndarray:
    """Buckets of overlapping byte n-grams of the lower-cased letters."""
    raw = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    n = len(x) - GRAM + 1
    if n < 1:
        x, n = np.pad(x, (0, GRAM), constant_values=32), 1
    joined = x[:n] | x[1 : n + 1] << np.uint32(8) | x[2 : n + 2] << np.uint32(16) | x[3 : n + 3] << np.uint32(24)
    return (joined * np.uint32(0x9E3779B1)) >> np.uint32(33 - buckets.bit_length())


def mixture(p: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of languages by expectation-maximisation, and the log likelihood.

    `p` has a row per distinct n-gram, `times` how often each occurs.
    """
    share = np.full(p.shape[1], 1 / p.shape[1], np.float32)
    total = times.sum()
    for _ in range(ITERATIONS):
        new = share * ((times / (p @ share)) @ p) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < 2e-3:
            break
    return share, float(times @ np.log(p @ share))


def languages(p: np.ndarray, times: np.ndarray) -> list[tuple[int, float]]:
    """The set of languages with the highest penalised likelihood, largest proportion first.

    `p` has the probability of each distinct n-gram in each language. Languages join the set in order of
    their proportions in the full mixture, as long as each pays for its parameter. N-grams
    overlap, so GRAM of them count as one observation.
    """
    order = np.argsort(-mixture(p, times)[0], kind="stable")
    size = int(times.sum())
    best, value = None, -np.inf
    for k in range(1, len(order) + 1):
        chosen = order[:k]
        share, likelihood = (
            mixture(np.ascontiguousarray(p[:, chosen]), times) if k > 1 else (np.ones(1), float(times @ np.log(p[:, chosen[0]])))
        )
        now = likelihood / GRAM - 0.5 * k * np.log(size + 1)
        if now <= value:
            break
        best, value = list(zip(chosen.tolist(), share.tolist(), strict=True)), now
    return sorted(best, key=lambda x: (-x[1], x[0]))


class Languages:
    """N-gram probabilities per language from the rows of `docs` (text, lang) with a language.

    Counts cover all these rows; the result has at most CELLS numbers.
    """

    def __init__(self, docs: DataFrame):
        docs = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("lang IS NOT NULL AND text IS NOT NULL")
        self.names = [r[0] for r in docs.select("lang").distinct().orderBy("lang").collect()]
        self.buckets = BUCKETS
        while self.buckets * len(self.names) > CELLS and self.buckets > 256:
            self.buckets //= 2
        if self.buckets * len(self.names) > CELLS:
            raise ValueError(f"{len(self.names)} languages are more than a model holds")
        number, buckets = {name: i for i, name in enumerate(self.names)}, self.buckets

        def tally(batches):
            found: dict[int, np.ndarray] = {}
            for batch in batches:
                for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    own = found.setdefault(number[lang], np.zeros(buckets, np.int64))
                    own += np.bincount(grams(text.as_py(), buckets), minlength=buckets)
            for lang, own in found.items():
                some = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), lang)), pa.array(some), pa.array(own[some])], names=["lang", "bucket", "n"]
                )

        rows = (
            docs.mapInArrow(tally, "lang long, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        )
        counts = np.full((self.buckets, len(self.names)), SMOOTHING)
        counts[rows["bucket"], rows["lang"]] += rows["n"]
        self.table = (counts / counts.sum(axis=0)).astype(np.float32)

    def mixtures(self, text: str = "text") -> Column:
        """Array of (lang, share), largest share first; null where there is nothing to tell by."""
        table, names, buckets = self.table, self.names, self.buckets

        def infer(texts: pd.Series) -> pd.Series:
            out = []
            for text in texts:
                if not names or not text or not _LETTER.search(text):
                    out.append(None)
                    continue
                # Distinct n-grams, of which there are no more than buckets however long the text.
                distinct, times = np.unique(grams(text, buckets), return_counts=True)
                p = table[distinct]
                p /= p.max(axis=1, keepdims=True)
                out.append([{"lang": names[i], "share": float(s)} for i, s in languages(p, times.astype(np.float32))])
            return pd.Series(out)

        return F.pandas_udf(infer, "array<struct<lang:string,share:double>>")(F.col(text).cast("string"))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score, n_langs.

    Learns from rows that are not held out. `und` with score 0 for texts that are null or have
    no letter, and for all if nothing was learned.
    """
    model = Languages(docs.where(~held_out()))
    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), model.mixtures().alias("m")).select(
        "doc_id", "held_out", F.coalesce(F.col("m")[0]["lang"], F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(F.least(F.col("m")[0]["share"], F.lit(1.0)), F.lit(0.0)).alias("score"),
        F.coalesce(F.size("m"), F.lit(0)).alias("n_langs"),
    )
