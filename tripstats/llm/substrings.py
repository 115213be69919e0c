"""Removal of word sequences that an earlier document has, by FM-indexes of bounded shards.

Every shard would have to see every document if it held documents. Here a shard holds the parts
of all documents that share an anchor: of each window of WINDOW words, the smallest hash of its
ANCHOR-word sequences. Equal windows have equal anchors, so they meet in one shard, and a part
whose anchor no other document has meets nobody and never leaves its task.

A text that an earlier document has as a whole needs no index: all its windows start there too.

An anchor with more different parts than a shard should hold is not indexed: its parts are cut
into windows, and a window's documents are found by an aggregate over all of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.near_copies import _BASE, _mix
from tripstats.llm.shared import Stored, beside

WINDOW = 13
ANCHOR = 6
SHARD_WORDS = 2_000_000  # words after which a shard is closed, at the next anchor
ANCHOR_WORDS = 100_000  # words in different parts up to which an anchor is indexed


_POWERS = 1 << 16  # bytes of a text up to which powers are kept


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE and of its inverse, modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    own = [np.full(n, x, np.uint64) for x in (_BASE, inverse)]
    return tuple(np.multiply.accumulate(x) for x in own)


_KEPT = _powers(_POWERS)


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of each word of the text, in order."""
    raw = np.frombuffer(text, np.uint8)
    blank = np.ones(len(raw) + 2, bool)
    np.logical_or(raw == 32, raw - np.uint8(9) < 5, out=blank[1:-1])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _KEPT if len(raw) <= _POWERS else _powers(len(raw))
    # Sums of bytes times powers; those of a word are the same at every place after the division.
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw * up[: len(raw)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def anchors(text: bytes) -> np.ndarray:
    """Anchor of each window of the text's words, in order."""
    ids = word_hashes(text)
    n = len(ids)
    if n < WINDOW:
        return np.empty(0, np.int64)
    grams = np.zeros(n - ANCHOR + 1, np.uint64)
    for i in range(ANCHOR):
        grams = grams * _BASE + ids[i : n - ANCHOR + 1 + i]
    grams = _mix(grams)
    low = grams[: n - WINDOW + 1].copy()
    for i in range(1, WINDOW - ANCHOR + 1):
        np.minimum(low, grams[i : n - WINDOW + 1 + i], out=low)
    return low.view(np.int64)


def _mark(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            ids, found = batch.column(0).slice(at, 500).to_pylist(), []
            for text in batch.column(1).slice(at, 500):
                found.append(np.unique(anchors((text.as_py() or "").encode())))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found)),
                    pa.array(np.repeat(np.array(ids, np.int64), [len(f) for f in found])),
                ],
                names=["anchor", "row"],
            )


def _runs(batches):
    """Runs of windows with the same, shared anchor: anchor, document, its text, first word, words."""
    for batch in batches:
        rows = []
        ids, of = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for doc, row, text, shared in zip(ids, of, batch.column(2), batch.column(3), strict=True):
            raw = (text.as_py() or "").encode()
            own = anchors(raw)
            if not len(own):
                continue
            words = raw.split()
            cuts = np.flatnonzero(np.diff(own)) + 1
            starts = np.concatenate([[0], cuts])
            ends = np.concatenate([cuts, [len(own)]])
            wanted = np.isin(own[starts], np.array(shared.as_py(), np.int64))
            for x, y in zip(starts[wanted].tolist(), ends[wanted].tolist(), strict=True):
                rows.append((int(own[x]), doc, row, x, b" ".join(words[x : y + WINDOW - 1])))
            if len(rows) > 50_000:
                yield _run_batch(rows)
                rows = []
        if rows:
            yield _run_batch(rows)


def _run_batch(rows):
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
        names=["anchor", "doc_id", "row", "start", "words"],
    )


class Wavelet:
    """Ranks of symbols in a sequence: a bit vector per bit of a symbol, with counts per 64 bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels, self.n = [], len(symbols)
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            packed = np.packbits(np.append(ones, np.zeros(-len(ones) % 64 + 64, bool)), bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)[:-1]]).astype(np.int32)
            self.levels.append((bit, packed, before, len(ones) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often `symbol` occurs before position `at`, for arrays of both."""
        start = np.zeros_like(at)
        for bit, packed, before, zeros in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            ends = []
            for x in (start, at):
                part = packed[x >> 6] & ((np.uint64(1) << (x & 63).astype(np.uint64)) - np.uint64(1))
                ones = before[x >> 6] + np.bitwise_count(part)
                ends.append(np.where(one, zeros + ones, x - ones))
            start, at = ends
        return at - start


class Index:
    """FM-index of texts (arrays of symbols from 1), with suffixes ordered by WINDOW symbols.

    That order is enough to search for up to WINDOW symbols. Symbol 0 ends every text.
    """

    def __init__(self, texts: list[np.ndarray], size: int):
        end = np.zeros(1, np.int64)
        self.text = np.concatenate([end, *(part for t in texts for part in (t, end))])
        n = len(self.text)
        rank, width = self.text, 1
        while width < WINDOW:
            step = min(width, WINDOW - width)
            ahead = np.zeros(n, np.int64)
            ahead[: n - step] = rank[step:]
            rank = np.unique(rank * (int(ahead.max(initial=0)) + 1) + ahead, return_inverse=True)[1]
            width += step
        self.order = np.argsort(rank, kind="stable")
        self.wavelet = Wavelet(self.text[self.order - 1], max(1, int(size).bit_length()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=size + 1))])

    def occurrences(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes that begin with the WINDOW symbols at `starts` of the text.

        Backward search, all patterns at once. A pattern leaves the search when one suffix is
        left: its matching statistic beyond itself is below the threshold.
        """
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.text), np.int64)
        live = np.arange(len(starts))
        for back in range(WINDOW - 1, -1, -1):
            symbol = self.text[starts[live] + back]
            low[live] = self.first[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.wavelet.rank(symbol, high[live])
            live = live[high[live] - low[live] > 1]
            if not len(live):
                break
        alone = np.ones(len(starts), bool)
        alone[live] = False
        low[alone] = high[alone] = 0
        return low, high


def first_documents(texts: list[bytes], firsts: np.ndarray) -> list[np.ndarray]:
    """Per text and window: the smallest of `firsts` among the texts of the shard that have it."""
    names: dict[bytes, int] = {}
    coded = [np.array([names.setdefault(w, len(names) + 1) for w in t.split(b" ")], np.int64) for t in texts]
    index = Index(coded, len(names))
    lengths = np.array([len(c) for c in coded])
    begins = 1 + np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    windows = lengths - WINDOW + 1
    own = np.repeat(np.arange(len(coded)), windows)
    ends = np.cumsum(windows)
    starts = begins[own] + np.arange(len(own)) - np.repeat(ends - windows, windows)
    low, high = index.occurrences(starts)
    # Document of each suffix in suffix order; the end marks between texts belong to none.
    of = np.full(len(index.text), np.iinfo(np.int64).max)
    of[starts] = firsts[own]
    of = of[index.order]
    best = firsts[own]
    met = np.flatnonzero(high > low)
    if len(met):
        distinct, back = np.unique(low[met], return_inverse=True)
        stops = np.zeros(len(distinct), np.int64)
        stops[back] = high[met]
        edges = np.stack([distinct, np.minimum(stops, len(of) - 1)], 1).ravel()
        lowest = np.minimum.reduceat(of, edges)[::2]
        last = stops == len(of)
        lowest[last] = np.minimum(lowest[last], of[-1])
        best = best.copy()
        best[met] = np.minimum(best[met], lowest[back])
    return np.split(best, ends[:-1])


def _search(batches):
    """First documents of the windows of every run that some document has after another one."""
    anchor, texts, firsts, lasts, keys, size = [], [], [], [], [], 0

    def close():
        found = first_documents(texts, np.array(firsts, np.int64))
        met = [i for i, (own, last) in enumerate(zip(found, lasts, strict=True)) if own.min() < last]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([anchor[i] for i in met], pa.int64()),
                pa.array([keys[i] for i in met], pa.int64()),
                pa.array([found[i] for i in met], pa.list_(pa.int64())),
            ],
            names=["anchor", "key", "firsts"],
        )

    for batch in batches:
        for a, key, words, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size > SHARD_WORDS and a != anchor[-1]:
                yield close()
                anchor, texts, firsts, lasts, keys, size = [], [], [], [], [], 0
            anchor.append(a)
            keys.append(key)
            texts.append(words)
            firsts.append(first)
            lasts.append(last)
            size += words.count(b" ") + 2
    if texts:
        yield close()


def _windows(batches):
    """Different windows of each run as digests: anchor, key of the run, digest, its places, first document.

    A run is as long as its anchor comes again within WINDOW words, so of a long one most
    windows are repeats.
    """
    for batch in batches:
        rows = []
        for a, key, raw, first, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = raw.split(b" ")
            places: dict[bytes, list[int]] = {}
            for x in range(len(words) - WINDOW + 1):
                places.setdefault(xxhash.xxh3_128_digest(b" ".join(words[x : x + WINDOW])), []).append(x)
            for window, at in places.items():
                rows.append((a, key, window, at, first))
                if len(rows) == 50_000:
                    yield _window_batch(rows)
                    rows = []
        if rows:
            yield _window_batch(rows)


def _window_batch(rows):
    types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
        names=["anchor", "key", "window", "places", "first"],
    )


def _crowded_answers(distinct: DataFrame) -> Stored:
    """The rows `_search` would give for runs anchor, key, words, first, last of any number."""
    windows = Stored(
        distinct.mapInArrow(_windows, "anchor long, key long, window binary, places array<int>, first long"), release=True
    )
    # Most windows are in one run only; these keep that run's first document.
    met = Stored(
        windows.frame.groupBy("window").agg(F.min("first").alias("low"), F.count("*").alias("n"))
        .where("n > 1").select("window", "low"),
        release=True,
    )
    placed = F.transform("found", lambda w: F.transform(w["places"], lambda at: F.struct(at.alias("at"), w["first"].alias("first"))))
    answers = Stored(
        beside(windows.frame, met, ["window"], "left").groupBy("anchor", "key")
        .agg(F.collect_list(F.struct("places", F.least("first", "low").alias("first"))).alias("found"))
        .select("anchor", "key", F.sort_array(F.flatten(placed)).getField("first").alias("firsts")),
        release=True,
    )
    windows.drop()
    met.drop()
    return answers


def _finish(texts: pd.Series, covered: pd.Series, copies: pd.Series) -> pd.DataFrame:
    rows = []
    for text, runs, copy in zip(texts, covered, copies, strict=True):
        words = text.encode().split() if text else []
        if copy:
            runs = range(max(0, len(words) - WINDOW + 1))
        gone = np.zeros(len(words) + 1, np.int64)
        for x in runs if runs is not None else ():
            gone[x] += 1
            gone[min(x + WINDOW, len(words))] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
        rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, kept.

    Every word goes that a window covers which also starts in a document with a smaller doc_id.
    A null text has no words. Rows without doc_id have no place in the order: they lose nothing
    and make nothing go. Rows that repeat a doc_id are one document with those texts.
    """
    # Rows of one id are told apart by their texts; `seal` makes a digest of 128 bits of it.
    docs = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .withColumn("row", F.xxhash64("text")).withColumn("seal", F.xxhash64(F.lit("seal"), "text"))
    )
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    ids = Stored(named.select("doc_id", "row", "seal"), release=True)
    firsts = Stored(
        ids.frame.groupBy("row", "seal").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), release=True
    )
    copies = Stored(
        ids.frame.join(firsts.frame.where("first < last").hint("merge"), ["row", "seal"])
        .where("doc_id > first").select("doc_id", "row").distinct(),
        release=True,
    )
    ids.drop()
    marked = Stored(named.select("row", "text").mapInArrow(_mark, "anchor long, row long"))
    marks = marked.frame
    # Sides that grow with the documents are merged at every size.
    shared = Stored(
        marks.groupBy("anchor").agg(F.min("row").alias("x"), F.max("row").alias("y")).where("x < y").select("anchor"),
        release=True,
    )
    wanted = Stored(
        marks.join(shared.frame.hint("merge"), "anchor", "left_semi")
        .groupBy("row").agg(F.collect_set("anchor").alias("anchors"))
        .join(firsts.frame.select("row", F.col("first").alias("doc_id")).hint("merge"), "row"),
        release=True,
    )
    shared.drop()
    marked.drop()
    firsts.drop()
    runs = Stored(
        named.select("doc_id", "row", "text").join(wanted.frame.hint("merge"), ["doc_id", "row"])
        .select("doc_id", "row", "text", "anchors")
        .mapInArrow(_runs, "anchor long, doc_id long, row long, start int, words binary"),
        release=True,
    )
    wanted.drop()
    key = F.xxhash64("words").alias("key")
    # A word and the blank after it have two bytes at least: no anchor has more words than this.
    crowded = Stored(
        runs.frame.groupBy("anchor", key).agg(F.floor(F.max(F.octet_length("words")) / 2 + 1).alias("most"))
        .groupBy("anchor").agg(F.sum("most").alias("most")).where(F.col("most") > ANCHOR_WORDS).select("anchor"),
        release=True,
    )

    def distinct(how: str) -> DataFrame:
        some = beside(runs.frame, crowded, ["anchor"], how)
        return (
            some.groupBy("anchor", "words").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
            .select("anchor", key, "words", "first", "last")
        )

    answers = Stored(
        distinct("left_anti").repartition("anchor").sortWithinPartitions("anchor", "key")
        .mapInArrow(_search, "anchor long, key long, firsts array<long>"),
        release=True,
    )
    answered = answers.frame
    others = None if crowded.frame.isEmpty() else _crowded_answers(distinct("left_semi"))
    if others:
        answered = answered.union(others.frame)
    crowded.drop()
    covered = Stored(
        runs.frame.select("anchor", "doc_id", "row", "start", key).join(answered.hint("merge"), ["anchor", "key"])
        .select(
            "doc_id", "row",
            F.filter(
                F.transform("firsts", lambda first, i: F.when(first < F.col("doc_id"), F.col("start") + i)), lambda x: x.isNotNull()
            ).alias("starts"),
        )
        .where(F.size("starts") > 0)
        .groupBy("doc_id", "row").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts")),
        release=True,
    )
    runs.drop()
    answers.drop()
    if others:
        others.drop()
    gone = covered.frame.withColumn("copy", F.lit(False)).unionByName(
        copies.frame.withColumn("starts", F.lit(None).cast("array<int>")).withColumn("copy", F.lit(True))
    )
    finish = F.pandas_udf(_finish, "n_words long, n_removed long, kept_sha256 string, kept string")
    return (
        docs.drop("seal").join(gone.hint("merge"), ["doc_id", "row"], "left")
        .select("doc_id", finish("text", "starts", F.coalesce("copy", F.lit(False))).alias("f")).select("doc_id", "f.*")
    )


def report(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).drop("kept")
