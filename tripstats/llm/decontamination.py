"""Benchmark passages in documents: one Aho-Corasick automaton, each text scanned once."""

from __future__ import annotations

import hashlib
import re
import uuid
from functools import reduce

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstats.llm.shared import Stored, beside

WINDOW = 13
# Benchmark characters of one automaton; a larger benchmark is searched block after block.
BLOCK_CHARS = 2_000_000

# Lower-cased words hold digits, a to z and everything outside ASCII.
_SPACED = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")


def words(text: str | None) -> list[bytes]:
    return text.encode().lower().translate(_SPACED).split() if text else []


class Automaton:
    """All windows of the items; one character stands for each word that occurs in an item.

    A text becomes as many characters as it has words, so a match's place is the place of its
    words.
    """

    def __init__(self, items: list[tuple[str, str]]):
        import ahocorasick

        self.codes: dict[bytes, str] = {}
        self.search = ahocorasick.Automaton()
        windows: dict[str, set[str]] = {}
        for item, text in items:
            found = words(text)
            coded = "".join([self._code(w) for w in found])
            size = min(WINDOW, len(found))
            if size:
                for at in range(len(found) - size + 1):
                    windows.setdefault(coded[at : at + size], set()).add(item)
        for window, names in windows.items():
            self.search.add_word(window, (len(window), frozenset(names)))
        if windows:
            self.search.make_automaton()
        self.empty = not windows

    def _code(self, word: bytes) -> str:
        code = self.codes.get(word)
        if code is None:
            n = len(self.codes) + 1
            code = self.codes[word] = chr(n if n < 0xD800 else n + 0x800)
        return code

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of words inside windows, merged, and the items they are from."""
        ranges: list[tuple[int, int]] = []
        names: set[str] = set()
        if self.empty:
            return ranges, names
        get = self.codes.get
        coded = "".join([get(w, "\0") for w in found])
        for end, (size, items) in self.search.iter(coded):
            start = end + 1 - size
            while ranges and start <= ranges[-1][1]:
                start = min(start, ranges.pop()[0])
            ranges.append((start, end + 1))
            names |= items
        return ranges, names


# The automaton of the block searched last, kept by a Python worker over its tasks.
_BUILT: dict[str, Automaton] = {}


def _automaton(name: str, items) -> Automaton:
    """The automaton of a block; names are never used twice."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton(items.value)
    return _BUILT[name]


def _places(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Offsets in the text, in code points, of ranges of words."""
    places, at, chars = [], 0, 0
    raw = text.encode()
    found = [m.span() for m in _WORD.finditer(raw)] if ranges else []
    for start, end in ranges:
        first, last = found[start][0], found[end - 1][1]
        chars += len(raw[at:first].decode())
        places.append((chars, chars + len(raw[first:last].decode())))
        at, chars = last, places[-1][1]
    return places


_RANGES = "array<struct<start:int,end:int>>"
_FOUND = f"n_words long, n_hit long, ranges {_RANGES}, spans {_RANGES}, items array<string>"
_COLUMNS = ["n_words", "n_hit", "ranges", "spans", "items"]


def _row(text: str | None, n: int, ranges: list[tuple[int, int]], names) -> tuple:
    structs = ([{"start": s, "end": e} for s, e in found] for found in (ranges, _places(text or "", ranges)))
    return n, sum(e - s for s, e in ranges), *structs, sorted(names)


def _finder(name: str, shared):
    @F.pandas_udf(_FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        automaton, rows = _automaton(name, shared), []
        for text in texts:
            found = words(text)
            rows.append(_row(text, len(found), *automaton.scan(found)))
        return pd.DataFrame(rows, columns=_COLUMNS)

    return find


def _merge(texts: pd.Series, ranges: pd.Series, items: pd.Series) -> pd.DataFrame:
    """What blocks found in a text, as one."""
    rows = []
    for text, found, names in zip(texts, ranges, items, strict=True):
        merged: list[tuple[int, int]] = []
        for start, end in sorted((r["start"], r["end"]) for r in ([] if found is None else found)):
            if merged and start <= merged[-1][1]:
                start, end = merged[-1][0], max(end, merged.pop()[1])
            merged.append((start, end))
        rows.append(_row(text, len(words(text)), merged, () if names is None else set(names)))
    return pd.DataFrame(rows, columns=_COLUMNS)


def _block(items: DataFrame, block: Column, number: int) -> tuple[str, Broadcast]:
    """A block as the workers get it: BLOCK_CHARS characters on average, whatever the benchmark."""
    rows = items.where(block == number).orderBy("item_id", "text").collect()
    return uuid.uuid4().hex, items.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in rows])


def with_windows(docs: DataFrame, benchmark: DataFrame, name: str = "found", text: str = "text") -> DataFrame:
    """`docs` and a column `name`: n_words, n_hit, ranges, spans, items.

    `ranges` are runs of hit words by number, `spans` the same by offset in the original text (code
    points, end exclusive), `items` those with occurring windows. `benchmark` has item_id, text.
    A window is 13 consecutive words of an item; an item with fewer, but some, is one window. Null
    texts have no words; items without id or text are left out; repeated items count once; a
    column of that name gives way. Long texts are scanned whole.

    A benchmark of up to BLOCK_CHARS characters is one automaton, and every text is scanned once. A
    larger one is cut into blocks, with one pass over the texts for each: only one block is in
    the driver or a worker at a time, and what each finds is written down and merged by text.
    """
    items = Stored(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
        .where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    ).frame
    own = F.col(text).cast("string")
    n = 1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    if n == 1:
        return docs.withColumn(name, _finder(*_block(items, block, 0))(own))
    parts = []
    texts = docs.select(F.md5(own).alias("_text"), own.alias("_own")).where("_text IS NOT NULL")
    for number in range(n):
        label, shared = _block(items, block, number)
        hits = texts.select("_text", _finder(label, shared)("_own").alias("_hit")).where("_hit.n_hit > 0")
        parts.append(Stored(hits.groupBy("_text").agg(F.first("_hit.ranges").alias("_ranges"), F.first("_hit.items").alias("_items"))))
        shared.destroy()
    found = Stored(
        reduce(DataFrame.union, (part.frame for part in parts)).groupBy("_text")
        .agg(F.flatten(F.collect_list("_ranges")).alias("_ranges"), F.flatten(F.collect_list("_items")).alias("_items"))
    )
    for part in parts:
        part.drop()
    marked = beside(docs.withColumn("_text", F.md5(own)), found, ["_text"], "left")
    return marked.withColumn(name, F.pandas_udf(_merge, _FOUND)(own, "_ranges", "_items")).drop("_text", "_ranges", "_items")


def _joined(items: pd.Series) -> pd.Series:
    return items.map(lambda names: hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())


def contaminated(found: Column) -> Column:
    return (found["n_hit"] > 0) & (F.lit(20) * found["n_hit"] >= found["n_words"])


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without contaminated rows; all columns stay."""
    marked = with_windows(docs, benchmark, "_found_windows")
    return marked.where(~contaminated(F.col("_found_windows"))).drop("_found_windows")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): counts of words and hits, items, and the verdict."""
    found = F.col("found")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_windows(texts, benchmark).select(
        "doc_id", found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.pandas_udf(_joined, "string")(found["items"]).alias("items_sha256"), contaminated(found).alias("contaminated"),
    )
