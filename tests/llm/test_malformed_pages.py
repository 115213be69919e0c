"""Pages with broken or missing mark-up."""

import time
from itertools import product

import numpy as np
import pytest

from tripstats.llm import html_text

BODY = "Body of the article, with words enough to be kept whatever comes around it."


@pytest.fixture(scope="module")
def tree():
    return html_text.trained()


@pytest.mark.parametrize("page", [
    f"<article><p>{BODY}</p><![foo[bar]]></article>",
    f"<html><head><title>T</title><body><article><p>{BODY}</article>",
    f"<article><p class=ad>Buy<p>{BODY}</article>",
    f"<article><p>{BODY}</p></article><![if x]><!><!-",
])
def test_body_is_found(tree, page):
    assert html_text.main_text(page, tree).startswith(BODY)


def test_missing_end_tags():
    texts, _ = html_text.blocks("<ul><li>a<li>b<ul><li>c</ul>d<li>e</ul><table><tr><td>1<td>2<tr><td>3</table><p>x<div>y</div>")
    assert texts == ["a", "b", "c", "d", "e", "1", "2", "3", "x", "y"]


def test_links_of_any_depth():
    _, x = html_text.blocks("<div><a><b><i><u><em><span><strong>one two</strong></span></em></u></i></b></a> three</div>")
    assert x[0, 1] == pytest.approx(2 / 3)


def test_time_grows_with_the_page(tree):
    began = time.time()
    html_text.main_text("<b>" * 20_000 + "</i>" * 20_000, tree)
    html_text.main_text("<p>" * 20_000 + "<a>" * 20_000 + BODY, tree)
    assert time.time() - began < 10


def used(tree):
    return set() if tree.feature < 0 else {html_text.FEATURES[tree.feature]} | used(tree.low) | used(tree.high)


def test_tree_rests_on_lengths_links_and_neighbours(tree):
    assert {"words", "link_density", "links_after"} <= used(tree)


def test_nothing_of_an_article_goes(tree):
    """Blocks of an article that no element or name sets apart are main text, whatever their words and links."""
    words, links = (0, 1, 2, 3, 5, 8, 13, 30, 80, 500), (0, 0.1, 0.2, 0.3, 0.6, 1)
    rows = [(max(w, 1), d, wb, db, wa, da, 1, 0, 0, 0) for w, wb, wa in product(words, repeat=3) for d, db, da in product(links, repeat=3)]
    assert tree.decide(np.array(rows)).all()


PROSE = " ".join(["Plain words of a paragraph that goes on for a while"] * 4)


@pytest.mark.parametrize(("page", "main"), [
    (f"<div class='post legal-history'><article><div class='legal-history'><p>{PROSE}</p></div></article></div>", PROSE),
    (f"<div><a>One link of {'many words ' * 9}</a></div><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p>", f"{PROSE} Short. {PROSE}"),
    (f"<ul><li><a>Home</a><li><a>News</a><li><a>Sport</a></ul><h1>A title</h1><p>{PROSE}</p><div><a>Next</a></div>", f"A title {PROSE}"),
    (f"<article><p>{PROSE}</p><ul><li><a>A</a><li>b<li><a>C d</a></ul><p>End.</p></article>", f"{PROSE} A b C d End."),
    (f"<article><p>{PROSE}</p><div class=share-links><a>Share</a> <a>Post</a></div><aside>{PROSE}</aside></article><div>{PROSE}</div>", PROSE),
    (f"<article><p>{PROSE}</p></article><section id=comments><article><p>{PROSE}</p></article></section>", PROSE),
])
def test_pages_without_telling_names(tree, page, main):
    assert html_text.main_text(page, tree) == main


def test_table_is_learned(tree):
    """Lengths that the table does not have: at most one block in fifty is taken wrongly."""
    wrong = n = 0
    for marked in html_text.LABELLED:
        for scale in (0.8, 1.3):
            page, marks = html_text._page(marked, scale)
            wrong += sum(a != b for a, b in zip(tree.decide(html_text.blocks(page)[1]), marks, strict=True))
            n += len(marks)
    assert n > 400 and 50 * wrong <= n
