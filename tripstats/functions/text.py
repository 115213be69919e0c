"""Name normalization: compatibility decomposition, ASCII only, lower case."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(text: str) -> str:
    """`normalize_name` of a constant."""
    decomposed = unicodedata.normalize("NFKD", text)
    return decomposed.encode("ascii", "ignore").decode("ascii").lower()


def _ascii_of(code_point: int) -> str:
    decomposed = unicodedata.normalize("NFKD", chr(code_point))
    return decomposed.encode("ascii", "ignore").decode("ascii")


@cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Characters with one ASCII letter (from, to), and those with several.

    Derived from the Unicode tables by rule; other characters have no ASCII letter.
    """
    single_from, single_to, several = [], [], {}
    for code_point in range(0x80, 0x20000):  # none beyond decomposes to ASCII
        if 0xD800 <= code_point < 0xE000:
            continue
        ascii_text = _ascii_of(code_point)
        if len(ascii_text) == 1:
            single_from.append(chr(code_point))
            single_to.append(ascii_text)
        elif ascii_text:
            several[chr(code_point)] = ascii_text
    return "".join(single_from), "".join(single_to), several


def normalize_name(column: str | Column) -> Column:
    """'São Paulo', 'SAO PAULO' and 'Sa\u0303o Paulo' all become 'sao paulo'.

    Pure ASCII text, the common case, only pays the test and the lower-casing; characters that
    stand for several letters are looked up one by one, in the rare names that hold any.
    """
    name = F.col(column) if isinstance(column, str) else column
    single_from, single_to, several = _fold_tables()
    letters = F.str_to_map(
        F.lit("\x02".join(f"{c}\x01{ascii_text}" for c, ascii_text in several.items())),
        F.lit("\x02"),
        F.lit("\x01"),
    )
    spelled_out = F.array_join(
        F.transform(
            F.regexp_extract_all(name, F.lit("(?s)."), F.lit(0)),
            lambda c: F.coalesce(F.try_element_at(letters, c), c),
        ),
        "",
    )
    expanded = F.when(name.rlike(f"[{''.join(several)}]"), spelled_out).otherwise(name)
    folded = F.regexp_replace(
        F.translate(expanded, single_from, single_to), r"[^\x00-\x7F]", ""
    )
    return F.lower(F.when(name.rlike(r"[^\x00-\x7F]"), folded).otherwise(name))


def is_named(column: str | Column, name: str) -> Column:
    """Whether a column holds `name` in any spelling (accents and case aside)."""
    return normalize_name(column) == F.lit(normalized(name))
