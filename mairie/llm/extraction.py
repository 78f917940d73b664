"""Main text of HTML pages: flat text blocks, judged by a decision tree.

A page is cut at block-level tags into flat blocks of text.  A block is described by its word count
and link density, those of the blocks before and after it, and the kind of element it stands in.  A
decision tree says which blocks are the article; it is trained here, on the labelled blocks of the
few small pages at the end of this module.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# A comment, a declaration, or a tag; quoted attribute values may hold ">".
_TAG = re.compile(
    r"<(?:!--(?:.*?--!?>|.*+)|[!?][^>]*+(?:>|$)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?P<end>>|$))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Elements whose content is no text of the page, elements that end a block, and the
# words of class, id and role that name the parts of a page.
_SKIPPED = frozenset("script style noscript template textarea select button svg iframe object title option".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot"
    " th thead tr ul caption".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("nav header footer aside form menu dialog fieldset head".split())
_ARTICLE = frozenset("article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright disclaimer"
    " footer header links login menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted related"
    " reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_ARTICLE_WORDS = frozenset("article content entry main post story text".split())

FEATURES = (
    "words", "link density", "words before", "link density before", "words after", "link density after",
    "furniture", "article", "heading", "list item", "place from the end",
)


@dataclass
class Block:
    text: str
    linked: int  # words inside links
    words: int
    furniture: bool
    article: bool
    heading: bool
    item: bool


def _kind(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is named as page furniture, and whether as (part of) the article."""
    words: set[str] = set()
    for found in _ATTRIBUTE.finditer(attributes):
        value = found[2] or found[3] or found[4] or ""
        words.update(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()))
    return name in _FURNITURE or bool(words & _FURNITURE_WORDS), name in _ARTICLE or bool(words & _ARTICLE_WORDS)


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in page order.

    Character references are decoded, white space inside a block (line breaks and no-break spaces
    too) becomes one space; blocks without text are left out.  Content of scripts, styles and form controls is no text.
    A tag or comment that the page's end cuts off belongs to the markup.
    """
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements: name, furniture, article
    parts: list[str] = []
    linked, link, heading, item = 0, False, False, False
    begun = (False, False, False, False)  # what the block's first text stands in

    def add(raw: str) -> None:
        nonlocal linked, begun
        text = html.unescape(raw) if "&" in raw else raw
        if not text.strip():
            if text:
                parts.append(" ")
            return
        if not any(p != " " for p in parts):
            begun = (any(e[1] for e in stack), any(e[2] for e in stack), heading, item)
        parts.append(text)
        if link:
            linked += len(text.split())

    def end() -> None:
        nonlocal linked
        words = "".join(parts).split()
        if words:
            out.append(Block(" ".join(words), min(linked, len(words)), len(words), *begun))
        parts.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None or not found["end"]:  # comment, declaration, or a tag that never ends
            continue
        name, closing = name.lower(), bool(found["close"])
        if name in _BLOCKS:
            end()
        if name in _HEADINGS:
            heading = not closing
        elif name == "li":
            item = not closing
        elif name == "br":
            parts.append(" ")
        elif name == "a":
            link = not closing
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name in _SKIPPED:
            shut = re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|$)", re.I).search(page, at)
            at = shut.end() if shut else size
        elif name in _BLOCKS and name not in _VOID and name != "p" and not found["attributes"].endswith("/"):
            stack.append((name, *_kind(name, found["attributes"])))
    end()
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block; beyond the page's ends there are empty blocks."""
    words = np.array([0, *(b.words for b in found), 0], float)
    density = np.array([0, *(b.linked / b.words for b in found), 0], float)
    marks = np.array([(b.furniture, b.article, b.heading, b.item) for b in found], float).reshape(len(found), 4)
    last = np.arange(len(found), 0, -1).astype(float)[:, None]
    flat = np.stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]], axis=1)
    return np.hstack([flat, marks, np.minimum(last, 3)])


class DecisionTree:
    """Binary classification tree by Gini impurity; ties go to the earlier feature and smaller limit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1):
        self.feature, self.limit, self.low, self.high, self.share = [], [], [], [], []
        self._grow(x, y.astype(float), depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        node = len(self.feature)
        for column, value in zip((self.feature, self.limit, self.low, self.high, self.share), (-1, 0.0, -1, -1, y.mean()), strict=True):
            column.append(value)
        best = None
        if depth and 0 < y.mean() < 1:
            for f in range(x.shape[1]):
                order = np.argsort(x[:, f], kind="stable")
                v, above = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(y))
                left, right = above[:-1], above[-1] - above[:-1]
                impurity = left * (1 - left / n) + right * (1 - right / (len(y) - n))
                usable = (v[1:] > v[:-1]) & (n >= least) & (len(y) - n >= least)
                if usable.any():
                    k = int(np.argmin(np.where(usable, impurity, np.inf)))
                    if best is None or impurity[k] < best[0] - 1e-12:
                        best = (impurity[k], f, (v[k] + v[k + 1]) / 2)
        if best:
            self.feature[node], self.limit[node] = best[1], best[2]
            under = x[:, best[1]] <= best[2]
            self.low[node] = self._grow(x[under], y[under], depth - 1, least)
            self.high[node] = self._grow(x[~under], y[~under], depth - 1, least)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Whether each row is of the second class."""
        feature, limit = np.array(self.feature), np.array(self.limit)
        low, high, share = np.array(self.low), np.array(self.high), np.array(self.share)
        node = np.zeros(len(x), np.int64)
        while len(x) and (feature[node] >= 0).any():
            inner = feature[node] >= 0
            under = x[np.arange(len(x)), np.maximum(feature[node], 0)] <= limit[node]
            node = np.where(inner, np.where(under, low[node], high[node]), node)
        return share[node] > 0.5


def fit(pages: list[str] | None = None) -> DecisionTree:
    """The tree for labelled pages, where each block's text begins with + (article) or - (anything else)."""
    x, y = [], []
    for page in LABELLED if pages is None else pages:
        found = blocks(page)
        y += [b.text.startswith("+") for b in found]
        x.append(features(found))
    return DecisionTree(np.concatenate(x), np.array(y))


@cache
def _tree() -> DecisionTree:
    return fit()


def article_text(page: str | None, tree: DecisionTree | None = None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = (tree or _tree()).predict(features(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of each row of ``pages`` (columns page_id, url, html); others are not read.

    Rows are independent and nothing is shuffled.  Null and empty pages, and pages without an
    article, give empty text; null page_ids and urls and repeated rows stay as they are; an empty
    table gives an empty one.  Pages of any length are read whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [article_text(page.as_py()) for page in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    rows = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


# The labelled table: small pages of common layouts whose blocks begin with + (article) or - (else).
LABELLED = [
    """<head><title>x</title></head><body><nav><ul><li><a href=/>-Home</a><li><a href=/n>-News</a><li><a href=/s>-Sport today</a></ul></nav>
    <div class="ad">-Buy two lamps and get the third one free this week only.</div><article><h1>+River festival draws record crowd</h1>
    <p>+The festival along the river drew more visitors on its second day than in any year before, the town said.<p>+Rain held off.
    <p>+Organisers expect the last evening, with its lanterns and boats, to be the fullest of all, and ask people to come by train.<p>+So be it.</article>
    <footer>-© 2024 The River Post &middot; All rights reserved by the owner.</footer></body>""",
    """<div class=ad>-New shoes.</div><article><h1>+A short note</h1><p>+Yes.</p><p>+Closed on Monday.</p></article><footer>-© me</footer>""",
    """<header><a href=/>-The Daily</a><p>-News since the year 1890 for all of the valley and its towns</p></header><main><h2>+Council votes on bridge</h2>
    <p>+After four hours of talk the council voted by nine to six to close the old bridge to cars from next spring on.</p>
    <p>+Read <a href=/r>the report</a> for the figures that were given to the council by its engineers last month.</p>
    <blockquote>+We had hoped for more time.</blockquote><ul><li>+Cars must use the ring road.<li>+Buses may cross.</ul>
    <aside>-Related: <a href=/1>-Bridge closed for a week</a></aside><p>+The next sitting is in May.</p>
    <section class="comments"><h3>-Comments</h3><p>-I think this is a very bad idea and everyone in our street who drives to work agrees with me.</p><p>-Agreed.</p></section></main>
    <div id="sidebar"><h3>-Most read</h3><a href=/a>-Ten walks near town</a><p>-Our newsletter brings the best stories of the week to you each Friday morning.</p></div>
    <form><label>-Your mail address</label><p>-We will never share it with anybody else.</p></form><footer><p>-Imprint and contact</p></footer>""",
    """<div class="cookie-notice"><p>-We use cookies to make this site work and to learn how it is used; please agree or choose.</p></div>
    <div id="menu"><a href=/>-Start</a> <a href=/b>-Blog</a></div><div id="content"><h1>+Baking bread at home</h1>
    <p>+Flour, water, salt and time are all you need; the rest is patience and a hot oven, as every baker will tell you.</p><h2>+First</h2>
    <p>+Mix.</p><p>+Let the dough stand over night in a cool place, covered by a cloth, until it has doubled in size.</p><h2>+Then</h2><p>+Bake.</p></div>
    <div class="share-buttons">-Share this with friends</div><div class="related-posts"><p>-You may also like this story about cakes and what to do with old bread.</p></div>
    <div class="footer">-Made by hand</div>""",
    """<table><tr><td><a href=/>-Index</a><td><a href=/c>-Contact us</a></table><div><p>+Long ago, in a small house by the sea, there lived a man who wanted to count the waves.</p>
    <p>+He began.</p><p>+Each morning he went down to the shore with a stick and a stone, and for each wave he cut a mark into the stick.</p>
    <p>+He never got to the end, because there is none, but the sticks he left behind fill a whole room of the museum.</p></div>
    <div><a href=/p>-Previous page</a> | <a href=/q>-Next page</a></div><div>-Copyright by the author</div>""",
    """<div><a href=/1>-Weather</a></div><div><a href=/2>-Traffic news</a></div><div><a href=/3>-Jobs in town</a></div>
    <div>+The harbour will stay closed until the storm has passed, the office said on Sunday in a short statement.</div>
    <div>+Nobody was hurt.</div><div>+Ships that are on their way have been told to wait off the coast or to make for the next port in the north.</div>
    <div>+The ferry runs again from Tuesday, though with fewer trips than usual, and tickets that were bought stay valid.</div>
    <div><a href=/4>-All about the harbour</a></div><div><a href=/5>-Imprint</a></div><div>-Printed on Sunday</div>""",
    """<article><h1>+Notes from the garden</h1><p>+Beans are up.</p><p>+The frost of last week took the first flowers of the plum, but the apple had not opened yet and looks fine.</p>
    <div class="advertisement"><p>-Seeds for every garden, sent to your door within two days of your order, at half the price.</p></div><p>+More soon.</p>
    <div class=comments><p>-Lovely!</p><p>-My plum lost its flowers as well, and so did that of my neighbour across the road.</p></div></article>
    <nav><a href=/o>-Older</a> <a href=/w>-Newer</a></nav>""",
    """<main><p>+Only one line.</p></main>""",
    """<article><p>+Gone fishing.</p></article>""",
    """<article><h1>+Ice</h1><p>+Cold.</p></article>""",
    """<main><h1>+Thaw</h1><p>+The ice on the canal has gone, and with it the stands that had sold tea and chestnuts to skaters.</p></main>""",
    """<nav><a href=/>-Home</a></nav><article><h1>+On the ice</h1><p>+The lake froze over in the night for the first time in six years, and by noon half the town was on it.</p><p>+Skates sold out.</p></article>""",
    """<div class="post"><h2>+Lost and found</h2><p>+A grey glove was left on the bench by the lake on Saturday.</p><p>+Ask at the desk.</p></div>""",
    """<ul class="nav"><li>-Home<li>-About</ul><div class="story"><p>+He came, he saw, and then he went home again because it was late and the last train was about to leave.</p><p>+End.</p></div>""",
    """<div class="entry"><h1>+Three links</h1><ul><li>+<a href=/x>The first of them</a> shows how to fold a paper boat in nine steps<li>+<a href=/y>Another</a> how to sail it on a pond</ul></div><div><a href=/>-Back</a></div><div>-Contact</div>""",
    """<p>-Menu</p><p><a href=/h>-Home</a></p><h1>+How tall is the tower</h1><p>+The tower is ninety metres tall, if one counts the mast that was added in the sixties for the radio station.</p>
    <p>+Not counting it:</p><p>+Without it, the tower would be no taller than the church, which was built at the same time and by the same hands.</p><p><a href=/t>-Top of page</a></p>""",
]
