"""Similar sets of word n-grams against all pairs."""

import random

import numpy as np
import pytest

from tripstats.llm import ngram_join
from tripstats.llm.near_copies import WordHashes

SCHEMA = "doc_id long, text string"


def shingles(text, size=4):
    w = text.encode().lower().split() if text else []
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def expected(rows, percent=85):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs of texts."""
    named = sorted({(d, t) for d, t in rows if d is not None and shingles(t)})
    sets = [shingles(t) for _, t in named]
    root = list(range(len(named)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    place = {row: i for i, row in enumerate(named)}
    return sorted(
        ((d, len(shingles(t)), named[find(place[d, t])][0] if (d, t) in place else d) for d, t in rows), key=str
    )


def found(frame, **options):
    return sorted(map(tuple, ngram_join.similar_documents(frame, **options).collect()), key=str)


def made(groups, copies, words, seed):
    """Groups of copies of a text, each with words exchanged, some words from few choices."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(3, words))]
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(own) // 40)):
                own[rng.randrange(len(own))] = rng.choice([f"x{rng.randint(0, 2)}", f"y{rng.randint(0, 10**6)}"])
            rows.append((len(rows), " ".join(own[: len(own) - rng.randint(0, 2)]).upper() if rng.random() < 0.1 else " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rare", [1, 16])
def test_groups_of_copies(spark, rare):
    rows = made(25, 40, 160, rare)
    wanted = expected(rows)
    assert 10 < len({c for *_, c in wanted}) < len(rows)
    assert found(spark.createDataFrame(rows, SCHEMA), rare=rare) == wanted


def test_short_texts(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 11)))) for i in range(150)]
    rows += [(200 + i, " ".join(f"t{(i + k) % 40}" for k in range(9 + i % 3))) for i in range(60)]
    assert found(spark.createDataFrame(rows, SCHEMA), rare=1) == expected(rows)


def test_crowded_near_threshold(spark, monkeypatch):
    """Copies of one text that differ in words from few choices, so that no token is rare."""
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(120)] = f"x{rng.randint(0, 1)}"
        rows.append((d, " ".join(own)))
    assert found(spark.createDataFrame(rows, SCHEMA), rare=2) == expected(rows)


def test_every_similar_pair_shares_a_bucket():
    """Prefixes and pairs of neighbours over all kinds of frequencies, without Spark."""
    rng = np.random.default_rng(2)
    pairs = 0
    for trial in range(400):
        n = int(rng.integers(1, 80))
        tokens = rng.permutation(200)[:n]
        sets = [set(tokens.tolist())]
        for _ in range(5):
            kept = set(tokens[rng.random(n) > rng.choice([0.0, 0.05, 0.1])].tolist())
            sets.append(kept | set(rng.integers(0, 200, int(rng.integers(0, 1 + n // 8))).tolist()))
        sets = [s for s in sets if s]
        times = {t: max(sum(t in s for s in sets), int(rng.choice([2, 3, 50]))) for t in set().union(*sets)}
        for rare in (1, 2, 10):
            own = []
            for s in sets:
                held = np.array(sorted(t for t in s if sum(t in x for x in sets) > 1), np.int64)
                own.append({b: r for b, r, _ in ngram_join.signatures(len(s), held, np.array([times[int(t)] for t in held]), 85, rare)})
            for i, a in enumerate(sets):
                for j in range(i):
                    b = sets[j]
                    if 100 * len(a & b) >= 85 * len(a | b):
                        pairs += 1
                        both = own[i].keys() & own[j].keys()
                        assert any(185 * min(own[i][k], own[j][k]) >= 85 * (len(a) + len(b)) for k in both), (a, b, rare)
    assert pairs > 2000


def test_first_look_keeps_similar_sets():
    rng = np.random.default_rng(6)
    for n in (1, 2, 5, 7, 19, 20, 21, 40, 100, 400):
        for _ in range(50):
            a = rng.integers(0, 2**60, n).astype(np.uint64)
            b = np.unique(np.concatenate([a[rng.random(n) > 0.08], rng.integers(0, 2**60, n // 25).astype(np.uint64)]))
            a = np.unique(a)
            common = np.intersect1d(a, b)
            if not len(b) or 100 * len(common) < 85 * (len(a) + len(b) - len(common)):
                continue
            first = [x[: ngram_join.lost(len(x), 85) + ngram_join.shared_least(len(x), 85)] for x in (a, b)]
            shared = len(np.intersect1d(*first))
            assert all(shared >= ngram_join.expected_shared(len(x), 85) for x in (a, b))


def test_sketches_never_differ_more():
    rng = np.random.default_rng(8)
    for n in (1, 10, 100, 3000):
        for _ in range(30):
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            b = np.concatenate([a[rng.random(n) > 0.1], rng.integers(0, 2**63, n // 10).astype(np.uint64)])
            differing = len(np.setxor1d(a, b))
            assert sum(int(x).bit_count() for x in (ngram_join.sketch(a) ^ ngram_join.sketch(b)).view(np.uint64)) <= differing


def test_hashes_follow_words():
    words = WordHashes()
    assert len(ngram_join.shingles("A b c d e", words)) == 2
    assert ngram_join.shingles("a  B", words).tolist() == ngram_join.shingles("A\tb\n", words).tolist()
    assert len(ngram_join.shingles(None, words)) == len(ngram_join.shingles(" \n", words)) == 0


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()] + [(3, "one two three four five"), (3, "a"), (9, "A")]
    extra = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], f"{SCHEMA}, node int, token string")
    assert found(extra) == expected(rows)
    assert ngram_join.report(none).count() == 0


def test_documents(tables):
    docs = tables("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == expected(rows)


def test_near_copies_are_not_tried_in_pairs(spark, monkeypatch):
    """Copies of one text with words exchanged: links grow with the copies, not with their square."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(30):
        own = list(base)
        own[rng.randrange(200)] = f"x{d}"
        rows.append((d, " ".join(own)))
    tried = []
    verified = ngram_join._Sets.verified

    def counted(self, pairs):
        tried.append(pairs.count())
        return verified(self, pairs)

    monkeypatch.setattr(ngram_join._Sets, "verified", counted)
    found = ngram_join.similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component_id for r in found} == {0}
    assert 29 <= sum(tried) < 120  # 435 pairs


def test_pairs_of_many_buckets_are_made_once(spark):
    """Of sets of different components each pair that shares a bucket, without `distinct`."""
    rng = random.Random(8)
    component = [rng.randrange(6) for _ in range(40)]
    held = {b: sorted(rng.sample(range(40), 12)) for b in range(10)}
    of = {node: [b for b in held if node in held[b]] for node in range(40)}
    rows = [
        (b, node, 100, 100, True, *[0] * ngram_join.SKETCH, component[node], component[held[b][0]], of[node])
        for b in held for node in held[b]
    ]
    crowded = spark.createDataFrame(rows, ngram_join._MEMBERS + ", component long, main long, buckets array<long>")
    found = ngram_join._pairs(crowded.where("component <> main"), crowded, 80, apart=True, once=True)
    assert "Aggregate" not in found._jdf.queryExecution().toString()
    expected = {(x, y) for x in of for y in of if x > y and component[x] != component[y] and set(of[x]) & set(of[y])}
    assert sorted((r.a, r.b) for r in found.collect()) == sorted(expected)
