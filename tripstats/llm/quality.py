"""Quality classifier: an additive model of binned text features with pairwise interactions."""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows the model is fitted on: those labelled rows whose hashed ids are smallest.
SAMPLE = 20_000
BINS, COARSE = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 6
RATE, SMOOTHING = 0.2, 2.0

FEATURES = (
    "words", "bytes_per_word", "upper", "digits", "symbols", "exclamations", "bars", "stops_per_word",
    "lines_per_word", "beyond_ascii", "distinct_words", "word_as_before", "distinct_pairs",
    "repeated_lines", "longest_word", "commonest_word", "entropy", "lines_ending_in_stop",
)


def features(text: str | None) -> list[float]:
    """Numbers that describe a text; those of an empty one are zeros."""
    raw = text.encode() if text else b""
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    share = counts[counts > 0] / size
    lines = [line for line in raw.split(b"\n") if line.strip()]
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    return [
        np.log1p(n), (size - n) / n, upper / max(1, upper + lower), counts[48:58].sum() / size,
        counts[[35, 36, 37, 38, 42, 60, 62, 124]].sum() / size, counts[33] / n, counts[124] / n,
        counts[[44, 46, 58, 59, 63]].sum() / n, len(lines) / n, counts[128:].sum() / size,
        len(tally) / n, sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:], strict=False))) / max(1, n - 1),
        1 - len(set(lines)) / len(lines), np.log1p(max(map(len, words))), max(tally.values()) / n,
        -(share * np.log2(share)).sum(), sum(line.rstrip().endswith(b".") for line in lines) / len(lines),
    ]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTHING)


def _leaves(g: np.ndarray, h: np.ndarray, cuts: int = 3) -> np.ndarray:
    """Steps of a tree over ordered bins with at most `cuts` cuts, each the best one there is."""
    bounds = [0, len(g)]
    for _ in range(cuts):
        best = (1e-9, None)
        for x, y in zip(bounds, bounds[1:], strict=False):
            if y - x < 2:
                continue
            gl, hl = np.cumsum(g[x : y - 1]), np.cumsum(h[x : y - 1])
            gt, ht = g[x:y].sum(), h[x:y].sum()
            better = _gain(gl, hl) + _gain(gt - gl, ht - hl) - _gain(gt, ht)
            at = int(better.argmax())
            if better[at] > best[0]:
                best = (better[at], x + at + 1)
        if best[1] is None:
            break
        bounds = sorted([*bounds, best[1]])
    out = np.empty(len(g))
    for x, y in zip(bounds, bounds[1:], strict=False):
        out[x:y] = g[x:y].sum() / (h[x:y].sum() + SMOOTHING)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best cut of a table in both directions."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def four(c):
        a = c[:-1, :-1]
        b, d = c[:-1, -1:] - a, c[-1:, :-1] - a
        return a, b, d, c[-1, -1] - a - b - d

    parts = list(zip(four(cg), four(ch), strict=True))
    total = sum(_gain(x, y) for x, y in parts)
    i, j = np.unravel_index(int(total.argmax()), total.shape)
    step = np.empty(g.shape)
    for (x, y), rows, columns in zip(
        parts, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)),
        (slice(0, j + 1), slice(j + 1, None), slice(0, j + 1), slice(j + 1, None)), strict=True,
    ):
        step[rows, columns] = x[i, j] / (y[i, j] + SMOOTHING)
    return float(total[i, j]), step


@dataclass
class Model:
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        for a, b, table in self.pairs:
            i = np.searchsorted(self.coarse[a], x[:, a], side="right")
            j = np.searchsorted(self.coarse[b], x[:, b], side="right")
            total += table[i, j]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.empty(0)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: one shallow tree per feature in turn, then one per chosen pair in turn."""
    rate = (y.sum() + 1) / (len(y) + 2)
    edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    coarse = [_edges(x[:, f], COARSE) for f in range(x.shape[1])]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(float(np.log(rate / (1 - rate))), edges, tables, coarse, [])
    if y.min(initial=1) == y.max(initial=0):
        return model
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    logit = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for f, bin_of in enumerate(bins):
            p = _sigmoid(logit)
            n = len(tables[f])
            step = RATE * _leaves(np.bincount(bin_of, y - p, n), np.bincount(bin_of, p * (1 - p), n))
            tables[f] += step
            logit += step[bin_of]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]

    def grid(a: int, b: int):
        p = _sigmoid(logit)
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        at, n = bins[a] * shape[1] + bins[b], shape[0] * shape[1]
        return np.bincount(at, y - p, n).reshape(shape), np.bincount(at, p * (1 - p), n).reshape(shape)

    usable = [f for f in range(x.shape[1]) if len(coarse[f])]
    gains = [(_quadrants(*grid(a, b))[0], a, b) for i, a in enumerate(usable) for b in usable[i + 1 :]]
    chosen = [(a, b) for _, a, b in sorted(gains, key=lambda r: (-r[0], r[1:]))[:PAIRS]]
    model.pairs = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for a, b in chosen]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in model.pairs:
            step = RATE * _quadrants(*grid(a, b))[1]
            table += step
            logit += step[bins[a], bins[b]]
    return model


def held_out() -> Column:
    """Rows whose labels are never looked at."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model of `labels` (doc_id, quality 0 or 1) from the texts of `docs`.

    Labels of held-out rows, unknown labels and documents labelled both ways are left out. Without any labels every
    score is 0.5.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .where((~held_out()) & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other").select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    describe = F.pandas_udf(lambda texts: pd.Series([features(t) for t in texts]), "array<double>")
    rows = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .join(F.broadcast(chosen), "doc_id")  # `sample` rows of two numbers
        .dropDuplicates(["doc_id"])
        .select("doc_id", "quality", describe("text").alias("x")).toPandas().sort_values("doc_id")
    )
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["quality"].to_numpy(float))


def score(model: Model, text: str = "text") -> Column:
    """Probability that a text is of quality 1; a null text counts as an empty one."""

    def scores(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
        return pd.Series(model.scores(x))

    return F.pandas_udf(scores, "double")(F.col(text).cast("string"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted."""
    return docs.select(
        F.col("doc_id").cast("long"), held_out().alias("held_out"), score(train(docs, labels)).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not rejected; all columns stay."""
    marked = docs.withColumn("_quality_score", score(train(docs, labels)))
    return marked.where("_quality_score >= 0.5").drop("_quality_score")
