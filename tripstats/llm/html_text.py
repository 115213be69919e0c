"""Main text of web pages: flat text blocks, classified by a decision tree."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the markup: elements that end a text block, that hold no text to read, and
# that hold what surrounds an article; words of class and id that name such parts.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("audio button canvas head iframe noscript object script select style svg template textarea title video".split())
AROUND = frozenset("aside dialog footer form menu nav".split())
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer gdpr header legal login masthead menu modal nav navbar navigation newsletter "
    "notice notification pager pagination popup promo promoted related replies reply respond responses search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Elements whose end tag may be missing: what opens next ends them, up to an element that holds them.
PARAGRAPH_ENDS = BLOCKS - frozenset("body caption html tbody td tfoot th thead tr".split())
IMPLIED = {
    **{tag: frozenset(["p"]) for tag in PARAGRAPH_ENDS},
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "option": frozenset(["option"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]), "tbody": frozenset(["thead", "tbody", "tr", "td", "th", "p"]),
    "tfoot": frozenset(["thead", "tbody", "tr", "td", "th", "p"]),
}
HOLDS = frozenset("article aside blockquote body button div dl fieldset figure footer form header html main nav ol section select table td th ul".split())
HEAD = frozenset("base basefont bgsound link meta noscript object script style template title".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FEATURES = (
    "words", "link_density", "words_before", "links_before", "words_after", "links_after", "in_article", "outside", "around",
    "named",
)


@dataclass
class Block:
    text: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    in_article: bool = False
    around: bool = False
    named: float = 0.0


def _named(value: str | None) -> float:
    """The share of the words of a class or id that name what surrounds an article."""
    words = re.findall("[a-z]+", (value or "").lower())
    return sum(word in NAMED for word in words) / len(words) if words else 0.0


class _Blocks(HTMLParser):
    """Blocks of a page. Unclosed elements end with the element that holds them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks = [Block()]
        self.open: list[tuple[str, bool, bool, bool, float]] = []  # name, silent, around, article, named
        self.counts: dict[str, int] = {}  # open elements of each name

    def _flags(self) -> tuple[bool, bool, bool, float]:
        return self.open[-1][1:] if self.open else (False, False, False, 0.0)

    def _turn(self) -> None:
        _, around, article, named = self._flags()
        if self.blocks[-1].text:
            self.blocks.append(Block())
        last = self.blocks[-1]
        last.in_article, last.around, last.named = article, around, named

    def handle_starttag(self, tag, attrs):
        if tag in EMPTY:
            if tag == "hr":
                self._turn()
            else:
                self.handle_data(" ")
            return
        if self.counts.get("head") and tag not in HEAD and tag != "head":
            self._close("head")
        self._imply(tag)
        silent, around, article, named = self._flags()
        own = dict(attrs)
        inside = article or tag in ("article", "main") or own.get("role") in ("main", "article")
        around = (
            around or tag in AROUND or (tag == "header" and not article) or own.get("role") in ROLES
            or ("hidden" in own and tag not in ("html", "body"))
        )
        if tag not in ("html", "body", "article", "main"):
            named = max(named, _named(own.get("class")), _named(own.get("id")))
        self.open.append((tag, silent or tag in SILENT, around, inside, named))
        self.counts[tag] = self.counts.get(tag, 0) + 1
        if tag in BLOCKS:
            self._turn()

    def handle_endtag(self, tag):
        self._close(tag)
        if tag in BLOCKS:
            self._turn()

    def _close(self, tag):
        """Close the innermost element of that name and all inside it, if one is open."""
        while self.counts.get(tag):
            name = self.open.pop()[0]
            self.counts[name] -= 1
            if name == tag:
                break

    def _imply(self, tag):
        """Close what a start tag ends, from the innermost element that holds such elements."""
        ends = IMPLIED.get(tag)
        if not ends or not any(self.counts.get(name) for name in ends):
            return
        for name, *_ in reversed(self.open):
            if name in ends:
                self._close(name)
                self._imply(tag)
                return
            if name in HOLDS:
                return

    def parse_marked_section(self, i, report=1):
        """Broken declarations are comments, whatever they name."""
        return self.parse_bogus_comment(i)

    def parse_html_declaration(self, i):
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if self._flags()[0]:
            return
        block = self.blocks[-1]
        block.text.append(data)
        if self.counts.get("a"):
            block.linked.append(data)


def blocks(html: str | None) -> tuple[list[str], np.ndarray]:
    """Texts of the non-empty blocks of a page, and their features."""
    parser = _Blocks()
    parser.feed((html or "").replace("\0", ""))
    parser.close()
    texts, rows = [], []
    for block in parser.blocks:
        text = " ".join("".join(block.text).split())
        if text:
            words = len(text.split(" "))
            texts.append(text)
            rows.append((words, len("".join(block.linked).split()) / words, block.in_article, block.around, block.named))
    own = np.array(rows, float).reshape(-1, 5)
    edge = np.zeros((1, 2))
    before, after = np.vstack([edge, own[:-1, :2]])[: len(own)], np.vstack([own[1:, :2], edge])[: len(own)]
    outside = own[:, 2:3].any() & (own[:, 2:3] == 0)  # of the article that the page has
    return texts, np.hstack([own[:, :2], before, after, own[:, 2:3], outside, own[:, 3:]])


# The labelled table: pages whose blocks begin with + for the main text and - for the rest; {n} stands
# for n words. Class names of the main text also hold words that name other parts, and what
# surrounds it often has none, so that lengths, links and neighbours have to decide.
LABELLED = (
    "<nav><ul><li>- <a>Home</a><li>- <a>World news</a><li>- <a>Sport</a></ul></nav><article><h1>+ {7}</h1><p>+ {60}<p>+ {3}<p>+ {45}<ul><li>+ {4}<li>+ <a>{5}</a><li>+ {12}</ul><p>+ {30}</article><footer><p>- {4}<p>- {14}</footer>",
    "<header>- <a>{2}</a> {4}</header><main><h2>+ {5}</h2><p>+ {33}</p><p>+ {1}</p><blockquote>+ {18}</blockquote><p>+ {9} <a>{3}</a> {20}</p></main><aside><p>- {40}</p><p>- <a>{6}</a></p></aside><footer>- {8}</footer>",
    "<div class=ad>- {25}</div><article><h1>+ {4}</h1><p>+ {50}</p><div class='ad'>- {16}</div><p>+ {8}</p><p>+ <a>{11}</a></p><p>+ {70}</p></article><div class=comments><p>- {22}</p><p>- {3}</p><p>- {48}</p></div>",
    "<div id=cookie-notice>- {30}</div><div><h1>+ {6}</h1><p>+ {52}</p><p>+ {47}</p><p>+ {6}</p><p>+ {38}</p></div><div>- <a>{1}</a> <a>{1}</a> <a>{1}</a></div>",
    "<form><p>- {2}</p><p>- {26}</p></form><article><div>+ {35}</div><ul><li>+ {1}</li><li>+ {2}</li><li>+ {1}</li></ul><p>+ {2}</p></article><div>- {24}</div><div>- {2}</div>",
    "<div>- <a>{1}</a> | <a>{1}</a> | <a>{2}</a></div><div>- <a>{2}</a></div><div>+ {8}</div><div>+ {44}</div><div>+ {41}</div><div>+ {13}</div><div>- <a>{1}</a></div><div>- <a>{2}</a> <a>{2}</a></div>",
    "<article><p>+ {29}</p><aside><p>- {31}</p></aside><p>+ <a>{9}</a></p><p>+ {1}</p><nav>- <a>{3}</a> <a>{3}</a></nav><p>+ {16}</p></article>",
    "<div>+ {5}</div><div>+ {58}</div><div>+ {2}</div><div>+ {36}</div><div>- <a>{4}</a></div><div>- <a>{8}</a></div><div class=sidebar><p>- {20}</p><p>- {5}</p></div>",
    "<article><div class='post legal-history'><h2>+ {4}</h2><p>+ {62}</p><p>+ {5}</p><p>+ {39}</p></div><div class='related-posts'><p>- <a>{6}</a></p><p>- <a>{9}</a></p><p>- <a>{7}</a></p></div></article>",
    "<article><section class='market-share'><p>+ {48}</p><p>+ {21} <a>{2}</a></p><p>+ {7}</p></section><div class='share-links'>- <a>{1}</a> <a>{1}</a></div><div class='newsletter'><p>- {12}</p></div><p>+ {27}</p></article>",
    "<article><p>+ {40}</p><div class='search-history'><p>+ {31}</p><p>+ {3}</p></div><div class='nav-links'>- <a>{2}</a> <a>{4}</a></div></article><div id=sidebar-left><h3>- {2}</h3><p>- {34}</p></div><div class='page-footer'>- {19}</div>",
    "<ul><li>- <a>{1}</a><li>- <a>{1}</a><li>- <a>{2}</a><li>- <a>{1}</a></ul><h1>+ {9}</h1><p>+ {75}</p><p>+ {4}</p><p>+ {66}</p><p>+ {12} <a>{2}</a> {25}</p><h3>- {2}</h3><ul><li>- <a>{7}</a><li>- <a>{10}</a><li>- <a>{19}</a></ul><p>- {5} <a>{2}</a></p>",
    "<table><tr><td>- <a>{2}</a><td>- <a>{1}</a><td>- <a>{2}</a></table><h2>+ {3}</h2><p>+ {28}</p><p>+ {19}</p><p>+ {42}</p><p>- <a>{3}</a></p>",
    "<p>- <a>{1}</a> <a>{1}</a></p><p>+ {90}</p><ul><li>+ {11}<li>+ {14}<li>+ {12}</ul><p>+ {80}</p><p>- <a>{3}</a> <a>{2}</a> {2}</p>",
    "<div class=top-menu>- <a>{1}</a> <a>{1}</a></div><div class=content><h1>+ {6}</h1><p>+ {55}</p><p>+ {1}</p><p>+ {46}</p></div><div class=promo>- {28}</div><div class=site-footer>- {10} <a>{2}</a></div>",
    "<div id=menu><ul><li>- <a>{2}</a><li>- <a>{14}</a></ul></div><article><h1>+ {11}</h1><p>+ {5}<p>+ {2}<p>+ {4}</article><div>- {51}</div><div>- {9} <a>{4}</a></div>",
    "<div>- <a>{19}</a></div><div>- <a>{16}</a></div><div>- <a>{3}</a></div><div>+ {24}</div><div>+ {37}</div><div>+ {8}</div><div>+ {49}</div>",
    "<article><h1>+ {1}</h1></article><footer>- {21}</footer>",
    "<div class=banner>- {7}</div><article>+ {130}<p>+ {1}</p></article><section id=comments><h3>- {1}</h3><div class=comment-body>- {37}</div><div class=comment-body>- {64}</div></section>",
    "<div class='post-comments'><p>- {33}</p><p>- {41}</p></div><div role=dialog><p>- {17}</p></div><main><p>+ {20}</p><ol><li>+ <a>{3}</a><li>+ <a>{4}</a><li>+ <a>{2}</a></ol><p>+ {11}</p></main>",
    "<article><p>+ {10} <a>{3}</a></p><p>+ {20}</p><p>+ <a>{5}</a></p><p>+ {2}</p><ul><li>+ <a>{6}</a><li>+ {1}<li>+ <a>{2}</a></ul></article>",
    "<div>- <a>{3}</a></div><p>+ {60}</p><div>- <a>{4}</a></div><p>+ {25} <a>{8}</a> {6}</p><p>+ {31}</p><p>+ {16} <a>{7}</a> {3}</p><p>- <a>{2}</a></p><p>- {3}</p><p>- <a>{5}</a></p><p>- {2}</p><p>- <a>{8}</a></p>",
    "<ul><li>- <a>{3}</a></ul><p>+ {40}</p><ul><li>- <a>{6}</a></ul><p>- {4}</p><ul><li>- <a>{4}</a></ul><p>+ {45} <a>{9}</a></p><p>- {2} <a>{2}</a></p><p>- <a>{1}</a></p>",
    "<article><p>+ {21}</p><p>+ <a>{7}</a></p><p>+ {8}</p><p>+ <a>{9}</a></p><p>+ {3}</p><p>+ <a>{12}</a></p><p>+ {15}</p><p>+ <a>{3}</a></p><p>+ {40}</p><p>+ <a>{1}</a></p><p>+ {1}</p></article>",
    "<article><p>+ {16} <a>{4}</a></p><p>+ <a>{3}</a></p><p>+ {24} <a>{6}</a></p><p>+ <a>{2}</a></p><p>+ {9} <a>{2}</a></p><p>+ <a>{5}</a></p><p>+ {40} <a>{9}</a></p><p>+ <a>{4}</a></p></article>",
    "<article><p>+ {20}</p><p>+ {12} <a>{3}</a></p></article>", "<article>+ {8} <a>{2}</a></article>",
    "<article><p>+ {8} <a>{2}</a></p><p>+ {1}</p><p>+ {30} <a>{8}</a></p><p>+ {2}</p><p>+ {40}</p><p>+ {17} <a>{4}</a></p></article>",
    "<article><h2>+ {4}</h2><aside><h4>- {2}</h4><p>- {23}</p></aside><p>+ {36}</p><form><label>- {2}</label><p>- {11}</p></form><p>+ {5}</p><footer>- {9}</footer></article><footer><p>- {6}</p><p>- {30}</p></footer>",
    "<nav><p>- {2}</p><p>- <a>{3}</a></p></nav><h1>+ {6}</h1><p>+ {43}</p><p>+ {9}</p><form><p>- {4}</p><p>- {19}</p></form><p>+ {51}</p><aside>- {27}</aside><p>+ {2}</p><footer><p>- {3}</p><p>- {22}</p></footer>",
    "<header><h2>- {3}</h2><p>- {10}</p></header><div>+ {32}</div><div>+ {3}</div><div role=complementary><p>- {38}</p><p>- {4}</p></div><div>+ {27}</div><footer>- {12} <a>{1}</a></footer>",
    "<dialog><p>- {24}</p><p>- {2}</p></dialog><main><h1>+ {5}</h1><p>+ {64}</p><aside><p>- {45}</p></aside><p>+ {2}</p><form>- {6}</form></main><footer>- {33}</footer>",
    "<p>+ {34}</p>", "<h1>+ {3}</h1><p>+ {18}</p><p>+ {22}</p>", "<div>- <a>{2}</a></div>", "+ {6}", "<article>+ {2}</article>",
)


# Each page also counts with lengths so many times as large, so that cuts don't rest on one length.
SCALES = (0.6, 1.0, 1.8)


def _page(marked: str, scale: float) -> tuple[str, list[bool]]:
    """A page of the table without marks and with words, and its marks."""
    marks = [sign == "+" for sign in re.findall(r"(?:^|>)([+-]) ", marked)]
    plain = re.sub(r"(^|>)[+-] ", r"\1", marked)
    return re.sub(r"\{(\d+)\}", lambda n: " ".join(["word"] * max(1, round(scale * int(n[1])))), plain), marks


@dataclass
class Tree:
    """A decision: on a feature at a cut, or, as a leaf, the share of main text."""

    share: float
    feature: int = -1
    cut: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def decide(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.share >= 0.5)
        high = x[:, self.feature] > self.cut
        return np.where(high, self.high.decide(x), self.low.decide(x))


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 5) -> Tree:
    """A tree by the largest fall of the Gini impurity; ties go to the last feature and first cut.

    A side of a cut has at least `least` blocks.
    """
    share = float(y.mean()) if len(y) else 0.0
    best = (1e-9, None, None)
    if depth and 0 < share < 1:
        for feature in range(x.shape[1] - 1, -1, -1):
            values = np.unique(x[:, feature])
            for cut in (values[:-1] + values[1:]) / 2:
                high = x[:, feature] > cut
                sides = [y[high], y[~high]]
                if min(map(len, sides)) < least:
                    continue
                fall = share * (1 - share) - sum(len(s) / len(y) * s.mean() * (1 - s.mean()) for s in sides)
                if fall > best[0] + 1e-12:
                    best = (fall, feature, cut)
    if best[1] is None:
        return Tree(share)
    high = x[:, best[1]] > best[2]
    return Tree(share, best[1], float(best[2]), grow(x[~high], y[~high], depth - 1), grow(x[high], y[high], depth - 1))


def trained(labelled=LABELLED) -> Tree:
    rows, marks = [], []
    for marked, scale in product(labelled, SCALES):
        page, signs = _page(marked, scale)
        _, x = blocks(page)
        if len(x) != len(signs):
            raise ValueError(f"{len(x)} blocks, {len(signs)} labels: {marked}")
        rows.append(x)
        marks += signs
    return grow(np.vstack(rows), np.array(marks, float))


def main_text(html: str | None, tree: Tree) -> str:
    texts, x = blocks(html)
    return " ".join(t for t, main in zip(texts, tree.decide(x), strict=True) if main) if texts else ""


def extracted(html: str = "html") -> Column:
    """Main text of a page; empty for null, empty or textless pages."""
    tree = trained()
    return F.pandas_udf(lambda pages: pd.Series([main_text(p, tree) for p in pages], dtype=object), "string")(
        F.col(html).cast("string")
    )


def report(pages: DataFrame) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, url, text, n_chars.

    Null, empty and textless pages have an empty text; repeated rows stay; no row gives no row; broken
    mark-up is read as far as it goes; long pages are read whole, in time in proportion; other
    columns are not read.
    """
    return pages.select("page_id", "url", extracted().alias("text")).withColumn("n_chars", F.length("text").cast("long"))
