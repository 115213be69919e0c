"""Packing of tokenized documents into sequences of a fixed length by bin completion."""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstats.llm.shared import Stored

CAPACITY = 4096
END_ID = 1
NODES = 4000  # fillings looked at for one bin before the best one so far is taken
ROWS_PER_GROUP = 100_000
CACHED_WORDS = 400_000
BYTES_AT_ONCE = 6_000_000
TOKENIZER = "word_bpe_49k.json"


class Recent:
    """Map that forgets what was not used since it last filled up; holds at most two loads."""

    def __init__(self, load: int):
        self.load, self.new, self.old = load, {}, {}

    def get(self, keys: list, compute) -> list:
        """Values of distinct keys; `compute` maps those that are not known."""
        if len(self.new) + len(keys) > self.load:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        missing = []
        for key in keys:
            if key not in new:
                if key in old:
                    new[key] = old[key]
                else:
                    missing.append(key)
        new.update(zip(missing, compute(missing), strict=True))
        return [new[key] for key in keys]


class Ragged:
    """Arrays of ids of various lengths, end to end."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids, lengths
        self.ends = np.cumsum(lengths)

    @classmethod
    def of(cls, raws: list[bytes]) -> Ragged:
        lengths = np.fromiter(map(len, raws), np.int64, len(raws)) // 4
        return cls(np.frombuffer(b"".join(raws), "<u4"), lengths)

    def take(self, rows: np.ndarray) -> Ragged:
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        shift = np.repeat((self.ends[rows] - ends).astype(np.int64), lengths)
        return Ragged(self.ids[shift + np.arange(len(shift))], lengths)


class Words:
    """Token ids of texts by way of their distinct words.

    The tokenizer never joins tokens over white space, so the ids of a text are those of its
    words. Letters followed by ASCII symbols fall into those two parts likewise, and case is
    ignored. Only words without `<|`, which may start a special token, are split that way.
    """

    STEM = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
    SYMBOLS = ".,!*#$%&|;:?()"

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.ends = np.zeros(max(ends) + 10, bool)
        self.ends[ends] = True
        self.stems, self.others = Recent(CACHED_WORDS), Recent(CACHED_WORDS // 4)

    def _stems(self, stems: list[str]) -> list[bytes]:
        """A stem is one word to the tokenizer: its last token, and no other, ends a word."""
        found = []
        for at in range(0, len(stems), 4000):
            block = stems[at : at + 4000]
            ids = np.array(self.tokenizer.encode(" ".join(block), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            raw = ids.tobytes()
            found += [raw[4 * x : 4 * y] for x, y in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]
        return found

    def _others(self, words: list[str]) -> list[bytes]:
        return [
            np.array(e.ids, "<u4").tobytes()
            for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ]

    def _table(self, words: pa.Array) -> Ragged:
        """Ids of distinct words: of the stem, if there is one, then of the rest."""
        stems = pc.utf8_rtrim(words, self.SYMBOLS)
        regular = pc.match_substring_regex(stems, self.STEM)
        stems = pc.if_else(regular, stems, "")
        sizes = pc.binary_length(stems).to_numpy()
        rests = pa.array([w[n:] for w, n in zip(words.cast("binary").to_pylist(), sizes.tolist(), strict=True)], "binary")
        parts = [
            self._known(pc.utf8_lower(stems), self.stems, self._stems),
            self._known(rests.cast("string"), self.others, self._others),
        ]
        both = Ragged(np.concatenate([p.ids for p in parts]), np.concatenate([p.lengths for p in parts]))
        joined = both.take(np.arange(2 * len(words)).reshape(2, -1).T.ravel())
        return Ragged(joined.ids, parts[0].lengths + parts[1].lengths)

    @staticmethod
    def _known(values: pa.Array, cache: Recent, compute) -> Ragged:
        coded = pc.dictionary_encode(values)
        texts = coded.dictionary.to_pylist()
        some = [t for t in texts if t]
        found = dict(zip(some, cache.get(some, compute), strict=True))
        return Ragged.of([found.get(t, b"") for t in texts]).take(coded.indices.to_numpy())

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = pc.dictionary_encode(split.flatten())
        rows = coded.indices.to_numpy()
        found = self._table(coded.dictionary).take(rows)
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        at = np.concatenate([[0], found.ends])[bounds]
        return [found.ids[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


_LOADED: dict[str, Words] = {}


def _words(file: str) -> Words:
    if file not in _LOADED:
        _LOADED[file] = Words(file)
    return _LOADED[file]


def pieces(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most `capacity` tokens of every row of `docs` (doc_id, text).

    Columns doc_id, piece, start, length, ids_crc32, and the token ids if asked for. Every
    document ends with END_ID; a null text is an empty one. `tokenizer` names a file every
    executor has; None means the installed public one.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        file = tokenizer
        if file is None:
            import public_tokenizers

            file = public_tokenizers.path(TOKENIZER)
        words = _words(file)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
            cuts = np.flatnonzero(np.diff(size // BYTES_AT_ONCE)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                rows = []
                found = words.of(texts.slice(at, to - at))
                for doc, own in zip(ids[at:to], found, strict=True):
                    raw = own.tobytes() + end
                    for number, x in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[x : x + 4 * capacity]
                        rows.append((doc, number, x // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                del found
                pa.default_memory_pool().release_unused()
                if not rows:
                    continue
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32())]
                arrays += [pa.array(columns[i], pa.int64()) for i in (2, 3, 4)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(p, "<u4") for p in columns[5]], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, schema + (", ids array<long>" if with_ids else "")
    )


class _Search:
    """Bin completion over a histogram of lengths: branch and bound around the largest item."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {x: n for x, n in counts.items() if n}
        self.sizes = sorted(self.left)

    def _best_fit(self, room: int, used: dict[int, int]) -> list[int]:
        """The largest that fits, again and again."""
        chosen = []
        at = bisect_right(self.sizes, room) - 1
        while at >= 0:
            size = self.sizes[at]
            take = min(room // size, self.left[size] - used.get(size, 0))
            chosen += [size] * take
            room -= size * take
            at = min(at - 1, bisect_right(self.sizes, room) - 1)
        return chosen

    def filling(self, first: int) -> list[int]:
        """Companions of `first` that waste least, and among those the fewest and largest.

        Only maximal fillings are leaves: one to which an item could be added, or whose items
        could be exchanged for one larger item that fits, is dominated and never kept.
        """
        room = self.capacity - first
        best = self._best_fit(room, {first: 1})
        waste = room - sum(best)
        nodes = NODES
        used = {first: 1}
        path: list[int] = []

        def descend(room: int, limit: int) -> None:
            nonlocal best, waste, nodes
            nodes -= 1
            if self.left.get(room, 0) > used.get(room, 0) and room <= limit:
                best, waste = [*path, room], 0
                return
            at = bisect_right(self.sizes, min(room, limit)) - 1
            if room < waste:
                best, waste = list(path), room
            while at >= 0 and waste and nodes > 0:
                size = self.sizes[at]
                at -= 1
                have = self.left[size] - used.get(size, 0)
                if have <= 0:
                    continue
                if len(path) > 0 and room - size * min(have, room // size) >= waste and not self.sizes[0] < size:
                    return  # nothing smaller is left to fill what this size leaves open
                used[size] = used.get(size, 0) + 1
                path.append(size)
                descend(room - size, size)
                path.pop()
                used[size] -= 1

        if waste:
            descend(room, room)
        return best

    def take(self, items: list[int]) -> int:
        """Remove as many copies of a bin as the counts allow."""
        need: dict[int, int] = {}
        for size in items:
            need[size] = need.get(size, 0) + 1
        times = min(self.left[size] // n for size, n in need.items())
        for size, n in need.items():
            self.left[size] -= n * times
            if not self.left[size]:
                del self.left[size]
                self.sizes.remove(size)
        return times


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many alike) for a histogram of lengths.

    The work depends on the number of distinct lengths, at most `capacity`, not on the number
    of items: every step uses up a length, or all copies of a filling the counts allow.
    """
    search, bins = _Search(counts, capacity), []
    while search.sizes:
        first = search.sizes[-1]
        items = [first, *search.filling(first)]
        bins.append((items, search.take(items)))
    return bins


def _slots(bins: list[tuple[list[int], int]]):
    """Where items go: per length, runs of the item's number within its length."""
    rows, used, sequence = [], {}, 0
    for items, times in bins:
        offset = 0
        for size in sorted(set(items), reverse=True):
            n = items.count(size)
            start = used.get(size, 0)
            rows.append((size, start, n, sequence, offset))
            used[size] = start + n * times
            offset += size * n
        sequence += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`parts` (with doc_id, piece, start, length, ids_crc32) plus sequence_id and offset.

    A histogram of lengths, at most `capacity` numbers, goes to the driver, which plans bins;
    items get consecutive numbers within their length, in groups so that no task has all items
    of a common length, and look their place up by that number. Rows that are alike in all
    columns may change places. An empty table gives an empty result.
    """
    parts = Stored(parts).frame
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = _slots(plan(counts, capacity))
    # One sorted key per run: length and number of its first item.
    step = max(counts.values(), default=0) + 1
    keys = table[:, 0] * step + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, number):
        import pandas as pd

        row = table[np.searchsorted(keys, length.to_numpy() * step + number.to_numpy(), side="right") - 1]
        along = number.to_numpy() - row[:, 1]
        return pd.DataFrame(
            {"sequence_id": row[:, 3] + along // row[:, 2], "offset": row[:, 4] + along % row[:, 2] * row[:, 0]}
        )

    groups = 1 + sum(counts.values()) // ROWS_PER_GROUP
    parts = parts.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        parts.groupBy("length", "group").agg(F.count("*").alias("n"))
        .select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    )
    within = Window.partitionBy("length", "group").orderBy("doc_id", "piece", "ids_crc32")
    return (
        parts.withColumn("number", F.row_number().over(within).cast("long"))
        .join(ahead, ["length", "group"])
        .withColumn("at", place("length", F.col("number") - 1 + F.col("ahead")))
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            F.col("at.sequence_id").alias("sequence_id"), F.col("at.offset").alias("offset"),
        )
    )


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity), capacity)
