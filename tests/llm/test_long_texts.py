"""Texts with very many matches or n-grams, and mixtures of languages."""

import hashlib
import re
import time

import numpy as np
import pytest

from tripstats.llm import credentials, language

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("n", [511, 512, 513, 40_000])
def test_many_matches_in_one_text(spark, n):
    text = "é " + "\n".join(f"{i:032x}  file{i}.txt" for i in range(n)) + "\npassword = abcdefghijklmnop"
    began = time.time()
    (row,) = credentials.report(spark.createDataFrame([(1, text)], SCHEMA)).collect()
    assert time.time() - began < 60
    found = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{16,}", text)]
    expected = [f"hex:{a}:{z}" for a, z in found] + [f"assign:{text.index('password')}:{len(text)}"]
    assert (row.n_hex, row.n_assign) == (len(found), 1)
    assert row.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()


def test_mixture_raises_the_likelihood_and_counts_repeats():
    rng = np.random.default_rng(3)
    p = rng.random((300, 4)).astype(np.float32) + 0.01
    times = rng.integers(1, 5, 300).astype(np.float32)
    share, likelihood = language.mixture(p, times)
    assert share.sum() == pytest.approx(1, abs=1e-3)
    assert likelihood >= float(times @ np.log(p @ np.full(4, 0.25, np.float32)))
    whole = np.repeat(p, times.astype(int), axis=0)
    again = language.mixture(whole, np.ones(len(whole), np.float32))
    assert np.allclose(share, again[0], atol=1e-3) and likelihood == pytest.approx(again[1], rel=1e-4)


def test_two_languages_are_found_and_long_texts_are_bounded(spark, tables):
    docs = tables("documents")
    model = language.Languages(docs.where("lang IN ('en', 'fr', 'de')"))
    own = {
        lang: " ".join(r.text for r in docs.where(f"lang = '{lang}' AND text IS NOT NULL").orderBy("doc_id").limit(8).collect())[:6000]
        for lang in ("en", "fr")
    }
    rows = [(1, own["en"] + " " + own["fr"]), (2, own["en"]), (3, own["fr"] * 500)]
    found = {r.doc_id: r.m for r in spark.createDataFrame(rows, SCHEMA).select("doc_id", model.mixtures().alias("m")).collect()}
    assert {x.lang for x in found[1]} >= {"en", "fr"} and all(0.3 < x.share < 0.7 for x in found[1][:2])
    assert found[2][0].lang == "en" and found[2][0].share > 0.9 and found[3][0].lang == "fr"
