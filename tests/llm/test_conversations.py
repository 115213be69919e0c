"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from functools import cache

from tripstats.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")


def cheapest(rows, faults):
    """(cost, audit, lines) by recursion over what is left, not by an agenda."""

    @cache
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in "ea":
            found.append((0, "", ()))

        def edit(cost, letter, role, text, at):
            to = conversations.NEXT.get((state, role[:1]))
            if to:
                rest = best(at, to, inserts + 1 if at == i else 0)
                if rest:
                    found.append((cost + rest[0], letter + rest[1], (f"{role}:{text}", *rest[2])))

        if inserts < 3:
            for role in ("user", "assistant"):
                edit(3, "I", role, "", i)
        if i < len(rows):
            role, text = rows[i]
            rest = best(i + 1, state, 0)
            if rest:
                found.append((4 + rest[0], "D" + rest[1], rest[2]))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                edit(more, "K", role, text, i + 1)
                for to in ("user", "assistant"):
                    edit(3 + more, "R", to, text, i + 1)
        return min(found, default=None)

    return best(0, "e", 0)


def expected(table):
    """Results of the contract in plain Python."""
    found = {}
    for conv, *_ in table:
        found.setdefault(conv, [])
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        found[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, rows in found.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append(
                "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            )
            seen.add((role, text))
        turns = [t for t, *_ in rows if t is not None]
        cost, audit, lines = cheapest(tuple(r[1:] for r in rows), tuple(faults))
        assert LEGAL.fullmatch("".join(line[0] for line in lines))
        pairs = [x[1][:1] + y[1][:1] for x, y in zip(rows, rows[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def results(frame):
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()
    }


def made(seed, conversations_, rows):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "ua"]
    texts = ["Yes.", "No!", "cut of", "", " \t", None, "Why?\n", "x", "Yes. "]
    return [
        (rng.choice([c, c, None]) if c == 0 else c, rng.choice([t, t, t, t + 1, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{t}.")
        for c in range(conversations_) for t in range(rng.randint(1, rows))
    ]


def test_odd_conversations(spark):
    table = made(1, 120, 9)
    assert results(conversations.report(spark.createDataFrame(table, SCHEMA))) == expected(table)


def test_segments_are_chained(spark, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", 3)
    monkeypatch.setattr(conversations, "SEGMENT_CHARS", 40)
    table = made(2, 40, 60)
    assert results(conversations.report(spark.createDataFrame(table, SCHEMA))) == expected(table)


def test_one_conversation_of_many_rows(spark):
    n = 5000
    table = [(7, t, "user" if t % 2 == 0 else "assistant", f"{t}." if t % 7 else f"{t}") for t in range(n)]
    (row,) = conversations.report(spark.createDataFrame(table, SCHEMA)).collect()
    # Every edit of a row but an insertion uses up that row.
    kept = [r for r in table if zlib.crc32(f"7:{r[1]}".encode()) % 20]
    again = sum(zlib.crc32(f"7:{r[1]}".encode()) % 20 == 3 for r in table)
    assert len(row.audit) - row.audit.count("I") == len(kept) + again
    assert row.cost >= 3 * row.truncated and row.duplicate == again


def test_extra_columns_and_nothing_left(spark):
    lost = next(t for t in range(200) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(1, lost, "user", "a.", 5, "z")], f"{SCHEMA}, key int, pos string")
    nothing = hashlib.sha256(b"").hexdigest()
    assert results(conversations.report(frame)) == {1: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert conversations.report(frame.limit(0)).count() == 0
