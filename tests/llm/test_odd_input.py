"""Nulls, empty and very long texts, ties, repeated rows and empty tables."""

import corpus_pipeline
from tripstats.llm import credentials, decontamination, html_text, language, lines, near_copies, packing, quality, rules, substrings


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_odd_rows(odd, tables):
    n = odd.count()
    found = by_id(near_copies.near_copies(odd))
    assert found[6].component_id == 5 and found[None].component_id is None and found[2].n_shingles == 0
    assert near_copies.near_copies(odd).count() == n
    found = by_id(substrings.report(odd))
    assert found[6].n_removed == 14 and found[5].n_removed == 0 and found[None].n_removed == 0
    found = by_id(lines.report(odd))
    assert (found[5].n_removed, found[6].n_removed, found[8].n_removed, found[1].n_lines) == (0, 1, 3, 0)
    assert by_id(credentials.report(odd))[7].spans == ""
    found = by_id(language.report(odd))
    assert {found[i].lang_pred for i in (1, 2, 3)} == {"und"}
    assert by_id(rules.report(odd, tables("labels")))[1].base_failed
    assert quality.report(odd, tables("labels")).count() == n
    assert by_id(decontamination.report(odd, tables("benchmark")))[1].n_words == 0
    assert sum(r.length == 1 for r in packing.packed(odd).collect()) == 4


def test_texts_of_one_id(spark):
    same = " ".join(f"w{i}" for i in range(20))
    long = " ".join(f"v{i}" for i in range(30))
    rows = [(1, same), (2, "x y z " * 10 + same), (2, "short text"), (2, long), (2, f"{long} {same}"), (3, f"a {long}"), (3, "b"), (3, None)]
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == [
        (1, 20, 0, same), (2, 2, 0, "short text"), (2, 30, 0, long), (2, 50, 20, long), (2, 50, 20, ("x y z " * 10).strip()),
        (3, 0, 0, ""), (3, 1, 0, "b"), (3, 31, 30, "a"),
    ]


def test_empty_tables(none, spark, tables):
    labels, benchmark = tables("labels").limit(0), tables("benchmark").limit(0)
    frames = (
        near_copies.near_copies(none), substrings.report(none), lines.report(none), credentials.report(none),
        language.report(none), rules.report(none, labels), quality.report(none, labels),
        decontamination.report(none, benchmark), packing.packed(none),
        html_text.report(spark.createDataFrame([], "page_id long, url string, html string")),
    )
    assert [f.count() for f in frames] == [0] * len(frames)


def test_null_page(spark):
    rows = [(1, None, None), (2, None, ""), (3, None, "<p>A &lt;b&gt; &#x41;&amp<br>c")]
    found = html_text.report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r.n_chars for r in found[:2]] == [0, 0]


def test_pipeline_keeps_columns(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, testdata)
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= docs.count()
        docs = kept


def test_lines_beside_columns_of_the_same_names(spark):
    rows = [(1, "a repeated line of text\nanother line", "p", 9), (2, "a repeated line of text\nsomething else", "q", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places string, removed long")
    found = lines.without_repeated_lines(docs)
    assert found.columns == docs.columns
    assert sorted(map(tuple, found.collect())) == [(1, rows[0][1], "p", 0), (2, "something else", "q", 1)]
