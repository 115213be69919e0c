"""Operators over whole tables against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

from tripstats.llm import (
    credentials,
    decontamination,
    html_text,
    language,
    lines,
    near_copies,
    packing,
    quality,
    rules,
    substrings,
)


def texts(frame):
    return {r.doc_id: r.text or "" for r in frame.select("doc_id", "text").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_secrets(tables):
    docs = tables("documents")
    kinds = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    )
    own = texts(docs)
    for row in credentials.report(docs).collect():
        found = [
            (m.start(), i, m.end(), kind)
            for i, (kind, pattern, fits) in enumerate(kinds)
            for m in pattern.finditer(own[row.doc_id]) if fits(m)
        ]
        assert row.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found)))


def test_weak_parts_need_company(spark):
    rows = [
        (1, "client_id=abcd1234 x AbCd1234EfGh5678IjKl9012 at https://db.example.com/x"),
        (2, "see https://db.example.com/x"),
        (3, "token=secret: abcdefghijklmnop"),
        (4, "client_id=abcd1234" + " x" * 300 + " AbCd1234EfGh5678IjKl9012"),
    ]
    found = {r.doc_id: r.spans for r in credentials.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: "weak_id:0:18,weak_key:21:45,endpoint:49:73", 2: "", 3: "", 4: ""}


def test_weak_keys_are_whole(spark):
    key = "z" * 250 + "B1" + "y" * 20
    rows = [(1, f"client_id=abcd1234 x {key}== x"), (2, f"client_id=abcd1234 x {'z' * 300} {'Z1' * 20} x")]
    found = {r.doc_id: r.spans for r in credentials.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: f"weak_id:0:18,weak_key:21:{21 + len(key) + 2}", 2: ""}


def test_rules(tables):
    docs = tables("documents")
    own = texts(docs)
    rows = rules.report(docs, tables("labels")).collect()
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", own[row.doc_id])
        times = Counter(zip(words, words[1:], words[2:]))
        hit = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in own[row.doc_id].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (row.n_words, row.word_chars, row.n_dup_lines, row.n_repeat_words) == (
            len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(hit)
        )
        assert row.base_failed == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
    labels = {r.doc_id: r.quality for r in tables("labels").collect()}
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_substrings(tables):
    docs = tables("documents")
    words = {d: t.encode().split() for d, t in texts(docs).items()}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 12):
            first.setdefault(tuple(words[d][i : i + 13]), d)
    for row in substrings.report(docs).collect():
        own = words[row.doc_id]
        gone = {i + k for i in range(len(own) - 12) if first[tuple(own[i : i + 13])] < row.doc_id for k in range(13)}
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        assert (row.n_words, row.n_removed, row.kept_sha256) == (len(own), len(gone), hashlib.sha256(kept).hexdigest())


def test_anchors_of_equal_windows():
    rng = np.random.default_rng(3)
    words = [rng.choice([b"a", b"\xc3\xa9t\xc3\xa9", b"b" * 70_000, b"w%d" % rng.integers(0, 9)]) for _ in range(60)]
    blanks = [b" ", b"\n", b"\t \x0b", b"\x0c\r"]
    text = b"".join(w + blanks[i % 4] for i, w in enumerate(words))
    hashes = substrings.word_hashes(text)
    assert len({(w, h) for w, h in zip(text.split(), hashes.tolist(), strict=True)}) == len(set(words)) == len(set(hashes.tolist()))
    for x in range(0, 48, 7):
        assert substrings.anchors(b"  " + b" ".join(words[x : x + 13])).tolist() == [substrings.anchors(text)[x]]
    assert not len(substrings.anchors(b" ".join(words[:12]))) and not len(substrings.word_hashes(b" \n"))


def test_crowded_anchors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    phrase, passage = [f"p{i}" for i in range(12)], [f"q{i}" for i in range(16)]
    rows = []
    for d in range(200):
        own = [f"w{x}" for x in rng.integers(0, 10**9, 40)]
        rows.append((d, " ".join(own[:15] + phrase + own[15:30] + passage * (d % 3 == 0) + own[30:] + ["a"] * (d % 50))))
    rows += [(1000 + d, rows[d][1]) for d in range(0, 200, 20)]
    search = substrings._search

    def bounded(batches):
        def watched():
            runs = Counter()
            for batch in batches:
                runs.update(batch.column(0).to_pylist())
                assert max(runs.values(), default=0) <= 40
                yield batch

        yield from search(watched())

    monkeypatch.setattr(substrings, "_search", bounded)
    monkeypatch.setattr(substrings, "ANCHOR_WORDS", 500, raising=False)
    first = {}
    for d, text in rows:
        words = text.split()
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i : i + 13]), d)
    expected = {}
    for d, text in rows:
        words = text.split()
        gone = {i + k for i in range(len(words) - 12) if first[tuple(words[i : i + 13])] < d for k in range(13)}
        expected[d] = (len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in substrings.report(docs).collect()} == expected
    assert sum(n for n, _ in expected.values()) > 1000


def test_repeated_windows_of_a_run_are_one_row(spark, monkeypatch):
    rows = [(d, f"s{d} " + "a b " * (40 + d) + f"e{d} " + "c " * 30) for d in range(12)]
    made, crowded = [], substrings._windows

    def watched(batches):
        for batch in crowded(batches):
            found = batch.num_rows, len(set(zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column("window").to_pylist(), strict=True)))
            assert found[0] == found[1]
            yield batch

    stored = substrings.Stored

    def counted(frame, *args, **options):
        table = stored(frame, *args, **options)
        made.extend([table.frame.count()] if "window" in frame.columns and "key" in frame.columns else [])
        return table

    monkeypatch.setattr(substrings, "_windows", watched)
    monkeypatch.setattr(substrings, "Stored", counted)
    monkeypatch.setattr(substrings, "ANCHOR_WORDS", 50)
    first, expected = {}, {}
    for d, text in rows:
        words = text.split()
        gone = set()
        for i in range(len(words) - 12):
            if first.setdefault(tuple(words[i : i + 13]), d) < d:
                gone.update(range(i, i + 13))
        expected[d] = (len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in substrings.report(docs).collect()} == expected
    # A document has 30 different windows at most, and 80 and more in all.
    assert len(made) == 1 and 0 < made[0] <= 30 * len(rows)


def test_packing(tables):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    docs = tables("documents")
    ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts(docs).items()}
    rows = packing.packed(docs).collect()
    places = {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert (len(part), zlib.crc32(part.tobytes()), r.start) == (r.length, r.ids_crc32, 4096 * r.piece)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 4096
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    assert len(places) == -(-sum(map(len, ids.values())) // 4096)


def test_bin_completion():
    for seed in range(20):
        sizes = np.random.default_rng(seed).integers(1, 60, 200).tolist()
        bins = packing.plan(Counter(sizes), 100)
        assert Counter(x for items, n in bins for x in items * n) == Counter(sizes)
        assert max(sum(items) for items, _ in bins) <= 100
        assert sum(n for _, n in bins) <= -(-sum(sizes) // 100) + 2


def test_decontamination(tables):
    docs, benchmark = tables("documents"), tables("benchmark")
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower())
    windows = {}
    for r in benchmark.collect():
        own = split(r.text)
        size = min(13, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(str(r.item_id))
    sizes = {len(w) for w in windows}
    own = texts(docs)
    for row in decontamination.report(docs, benchmark).collect():
        words, hit, items = split(own[row.doc_id]), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if found := windows.get(tuple(words[i : i + size])):
                    items |= found
                    hit.update(range(i, i + size))
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (
            len(words), len(hit), len(items), sha(",".join(sorted(items)))
        )
        assert row.contaminated == (bool(hit) and 20 * len(hit) >= len(words))


def test_benchmark_in_blocks(tables, monkeypatch):
    docs, benchmark = tables("documents"), tables("benchmark")
    one = decontamination.with_windows(docs, benchmark).select("doc_id", "found").collect()
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 3000)
    several = decontamination.with_windows(docs, benchmark).select("doc_id", "found").collect()
    assert sorted(several) == sorted(one)


def test_spans_are_offsets_of_the_text(tables):
    docs = tables("documents")
    own, seen = texts(docs), 0
    for row in decontamination.with_windows(docs, tables("benchmark")).select("doc_id", "found").collect():
        split = decontamination.words(own[row.doc_id])
        for words, place in zip(row.found.ranges, row.found.spans, strict=True):
            assert decontamination.words(own[row.doc_id][place.start : place.end]) == split[words.start : words.end]
            seen += 1
    assert seen


def test_blocks_beside_repeats_nulls_and_clashing_names(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(14))
    benchmark = spark.createDataFrame([("a", item), ("a", item), ("b", "Ünïcode two"), ("c", None), (None, "x")], "item_id string, text string")
    text = f"\u00e9\U0001f600 - {item.upper()}! \u00fc ünïcode; TWO"
    rows = [(1, text, 0), (1, text, 1), (2, None, 2), (3, "", 3), (4, "x", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found int")
    one = sorted(decontamination.with_windows(docs, benchmark).collect())
    spans = [(s.start, s.end) for s in one[0].found.spans]
    assert [text[s:e] for s, e in spans] == [item.upper()]
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 10)
    assert sorted(decontamination.with_windows(docs, benchmark).collect()) == one
    assert [r.doc_id for r in decontamination.decontaminated(docs, benchmark).orderBy("doc_id").collect()] == [2, 3, 4]


def test_near_copies(tables):
    docs = tables("documents")
    sets = {}
    for d, t in texts(docs).items():
        w = t.encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[:i]:
            a, b = sets[x], sets[y]
            if a and b and 100 * min(len(a), len(b)) >= 75 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((find(x), find(y)))
                root[high] = low
    for row in near_copies.near_copies(docs).collect():
        assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), find(row.doc_id))
        assert row.kept == (row.doc_id == row.component_id)


def test_pages(tables):
    import html

    pages = tables("pages")
    own = {r.page_id: r.html for r in pages.collect()}
    for row in html_text.report(pages).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", own[row.page_id], re.S)
        assert row.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", body[1])).split())
        assert row.n_chars == len(row.text)


def test_held_out_accuracy(tables):
    docs = tables("documents")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in language.report(docs).collect() if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.97
    label = {r.doc_id: r.quality for r in tables("labels").collect()}
    rows = [r for r in quality.report(docs, tables("labels")).collect() if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == label[r.doc_id] for r in rows]) > 0.9


def test_lines(tables):
    docs = tables("documents")
    own, first, sets = texts(docs), {}, {}
    for d in sorted(own):
        for i, raw in enumerate(own[d].split("\n")):
            if line := raw.strip(" "):
                first.setdefault(line, (d, i))
                sets[line] = {line[k : k + 5] for k in range(max(1, len(line) - 4))}
    root = {line: line for line in first}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(sets, key=lambda x: len(sets[x]))
    for i, x in enumerate(order):
        for y in order[i + 1 :]:
            a, b = sets[x], sets[y]
            if 100 * len(a) < 80 * len(b):
                break
            if 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((find(x), find(y)), key=first.__getitem__)
                root[high] = low
    for row in lines.report(docs).collect():
        kept = [
            raw for i, raw in enumerate(own[row.doc_id].split("\n"))
            if not raw.strip(" ") or first[find(raw.strip(" "))] == (row.doc_id, i)
        ]
        assert row.kept_sha256 == sha("\n".join(kept)), row.doc_id


def test_short_lines(spark):
    rows = [(1, "aaaaa"), (2, "aaaaaaaaa\nabcd"), (3, "abcd\nabce")]
    found = {r.doc_id: r.n_removed for r in lines.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 0, 2: 1, 3: 1}
