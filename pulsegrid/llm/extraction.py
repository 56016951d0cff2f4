"""HTML extraction: flat text blocks, with word counts and link densities of their neighbours, and a decision tree."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Comments (also unclosed ones), declarations, tags with quoted attributes; what is between these is text.
MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
SPACE = re.compile(r"\s+")
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

#: Elements whose content is no page text; it ends at their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math canvas object select option datalist".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small
span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that set page furniture apart; those that may also wrap a whole page or head an article; words of class, id and
#: role that name furniture, and those of them that name what readers have added.
FURNITURE = frozenset("nav footer aside dialog menu head".split())
WRAPPERS = frozenset("header form button fieldset".split())
READERS = frozenset("comment comments disqus reply replies respond".split())
FURNITURE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs consent
cookie cookies footer gdpr header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo
promoted promotion promos related search share sharing sidebar signup skip skyscraper social sponsor sponsored
subscribe subscription tags toolbar topbar widget widgets alert disclaimer copyright contentinfo complementary""".split())
MAIN = frozenset("article main".split())
MAIN_NAMES = frozenset("article articlebody content entry main post story body".split())
OPENS_IN_ARTICLE = frozenset("header".split())
#: Shares of a page's words without links from which on an element is no furniture, whatever its class or, if it is one of
#: WRAPPERS, its tag says: then it wraps the page.
NAMED_WRAPS, TAG_WRAPS = 0.5, 0.9
#: How notices, invitations and the lines around an article begin.
NOTICE = re.compile(r"""(?:copyright\b|©|\(c\) ?\d{4}|all rights reserved|subscribe\b|sign (?:up|in)\b|log ?in\b|register (?:now|here|to)\b|newsletter\b|
we use cookies|this (?:site|website) uses|cookies?\b|privacy policy|terms (?:of|and)\b|follow us|share (?:this|on)\b|advertisement\b|sponsored\b|
read more\b|related (?:articles|posts|stories)|leave a (?:comment|reply)|skip to\b|back to top)""".replace("\n", ""), re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: bool
    furniture: bool
    named: bool
    notice: bool


class Element(NamedTuple):
    """What an open element hands down to the blocks in it: the numbers of the wrappers and of the named elements around them."""

    name: str
    furniture: bool
    main: bool
    wrappers: tuple[int, ...]
    named: tuple[int, ...]


PAGE = Element("", False, False, (), ())


@cache
def _names(attributes: str) -> tuple[bool, bool, bool]:
    """(furniture, main, hidden) by the class, id and role of a tag; what readers have added counts as hidden."""
    found: set[str] = set()
    hidden = False
    for m in NAMES.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role"):
            found.update(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", m[2] or m[3] or m[4] or "").lower()))
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif key == "hidden" or value == "true":
            hidden = True
    return bool(found & FURNITURE_NAMES), bool(found & MAIN_NAMES), hidden or bool(found & READERS)


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order: text between the tags of block elements, white space as one space."""
    out: list[Block] = []
    around: list[Element] = []  # for each block, what it is in
    open_tags: list[Element] = [PAGE]
    parts: list[str] = []
    links = linked = elements = 0

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", "".join(parts)).strip()
        if text:
            words, inside = len(text.split()), open_tags[-1]
            out.append(Block(text, words, min(linked, words), inside.main, inside.furniture, False, bool(NOTICE.match(text))))
            around.append(inside)
        parts.clear()
        linked = 0

    at, end = 0, len(html)
    while at < end:
        start = html.find("<", at)
        if start < 0:
            start = end
        if start > at:
            text = unescape(html[at:start])
            parts.append(text)
            if links:
                linked += len(text.split())
        if start == end:
            break
        m = MARKUP.match(html, start)
        if not m:  # a "<" that opens nothing is text
            parts.append("<")
            at = start + 1
            continue
        at = m.end()
        if m[1] is not None:
            parts.append(m[1])
        if not m[3]:
            continue
        name, closing = m[3].lower(), bool(m[2])
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name in RAW:
            if not closing and not m[4].rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = close.end() if close else end
            continue
        if name in INLINE:
            if not closing and name not in VOID and m[4]:
                named, _, hidden = _names(m[4])
                if named or hidden:
                    flush()
                    elements += 1
                    inside = open_tags[-1]
                    open_tags.append(inside._replace(
                        name=name, furniture=inside.furniture or hidden, named=inside.named + (elements,) if named else inside.named))
            elif closing and open_tags[-1].name == name:
                flush()
                open_tags.pop()
            continue
        flush()
        if name in VOID:
            continue
        if closing:
            for i in range(len(open_tags) - 1, 0, -1):
                if open_tags[i].name == name:
                    del open_tags[i:]
                    break
            continue
        if name in ("p", "li") and open_tags[-1].name == name:
            open_tags.pop()
        inside = open_tags[-1]
        named, named_main, hidden = _names(m[4]) if m[4] else (False, False, False)
        furniture, wrappers, names = inside.furniture or hidden or name in FURNITURE, inside.wrappers, inside.named
        if name in MAIN:  # what is around an article says nothing about it, but for furniture's own elements
            wrappers, names = (), ()
        elif name not in ("html", "body"):
            elements += 1
            if name in WRAPPERS and not (name in OPENS_IN_ARTICLE and inside.main):
                wrappers += (elements,)
            if named:
                names += (elements,)
        open_tags.append(Element(name, furniture, inside.main or name in MAIN or (named_main and name != "body" and not named), wrappers, names))
    flush()
    return _judged(out, around)


def _judged(page: list[Block], around: list[Element]) -> list[Block]:
    """The blocks of a page, those in wrappers as furniture and those in named elements as named, but for such elements that
    hold most of the page's words."""
    total, held = 0, Counter()
    for block, inside in zip(page, around):
        if not block.furniture:
            free = block.words - block.linked
            total += free
            for element in {*inside.wrappers, *inside.named}:
                held[element] += free
    for block, inside in zip(page, around):
        block.furniture |= any(held[e] <= TAG_WRAPS * total for e in inside.wrappers)
        block.named = any(held[e] <= NAMED_WRAPS * total for e in inside.named)
    return page


FEATURES = ("words", "link density", "words before", "link density before", "words after", "link density after", "main", "outside",
            "furniture", "named", "notice")


def features(page: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block; beyond either end of the page a block of no words is assumed.

    ``main``: inside a marked main part; ``outside``: outside of it on a page that has one; ``furniture``: in an element that
    is page furniture; ``named``: in one whose class, id or role says so; ``notice``: begins as notices do.
    """
    n = np.array([0, *(b.words for b in page), 0], float)
    d = np.array([0, *(b.linked / max(1, b.words) for b in page), 0], float)
    flags = np.array([(b.main, b.furniture, b.named, b.notice) for b in page], bool).reshape(-1, 4)
    main = flags[:, 0]
    return np.column_stack([n[1:-1], d[1:-1], n[:-2], d[:-2], n[2:], d[2:], main, main.any() & ~main, flags[:, 1:]]).astype(float)


#: The labelled table: blocks of invented pages, a page a line. A block is its number of words, after "/" those in links, then
#: "m" in a marked main part, "f" in furniture, "c" named so by class, "n" if it begins as a notice, and "+" if it is main text.
LABELLED_PAGES = """
1/1- 1/1- 1/1- 9+ 55+ 48/2+ 6+ 70+ 5n- 3n-
3- 2/2- 2/2- 7+ 40+ 22/2+ 35+ 12+ 5/5- 5/5- 5/5- 8n-
10+ 60+ 2+ 80+ 15+
12+
4+
1+
9+ 30+ 14/12- 10/10- 30/25- 6/6-
7+ 25+ 3+ 28+ 4+ 22+ 9n- 25/1n-
1/1c- 1/1c- 3+ 17+ 2+ 1c-
2/2- 3+ 16+ 3+ 14+
20c- 8+ 60+ 45+ 6c- 30c-
2/2- 2/2- 8+ 60+ 15c- 50+ 3+ 70+ 2/2c- 3/3c- 20n-
1/1- 8c+ 60c+ 50c+ 3c+ 70c+ 2/2c- 3/3c- 4n-
6+ 50+ 2/2- 2/2- 2/2- 2/2- 40+ 3/3-
4- 1/1- 1/1- 6+ 90/18+ 60+ 3/2- 2/2-
5- 3/3- 11+ 120+ 25n- 7n- 40n-
4- 2/2- 9- 3/3- 2/2-
3/3- 3/3- 20/18- 12/12-
2c- 5c- 40f- 3f- 7+ 45+ 38+ 12f- 8cn-
1/1f- 1/1f- 1/1f- 10c- 8m+ 60m+ 45/4m+ 3m+ 1m+ 120m+ 14m+ 2/2m+ 30f-
1/1f- 2/2f- 40c- 7m+ 1m+ 2m+ 1m+ 12f-
1/1f- 25c- 12m+ 12f-
3- 1/1- 8- 5m+ 6/6m+ 12m+ 4/4m+ 4/4m+ 12/12m+ 30/30m+ 4/4m+ 200m+ 9/3m+ 70- 20/18- 6-
7- 12- 40- 9m+ 45m+ 30fm- 50m+ 25cm- 70m+ 5fm- 12cm- 3m+ 60m+ 8/8cm- 80- 5n-
60- 90- 10m+ 100m+ 55cm+ 80cm+ 100m+ 5nm+ 40f- 60f- 9f-
2/2- 60c- 6m+ 1m+ 20m+ 80c- 5c- 6-
"""
BLOCK = re.compile(r"(\d+)(?:/(\d+))?([mfcn]*)([+-])")


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of LABELLED_PAGES."""
    x, y = [], []
    for line in LABELLED_PAGES.strip().splitlines():
        found = [BLOCK.fullmatch(b) for b in line.split()]
        x.append(features([Block("", int(m[1]), int(m[2] or 0), *(flag in m[3] for flag in "mfcn")) for m in found]))
        y += [m[4] == "+" for m in found]
    return np.concatenate(x), np.array(y)


@dataclass(frozen=True)
class Tree:
    """A node: a leaf's label, or a feature, a threshold and the trees for values up to it and above."""

    label: bool = False
    feature: int = -1
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(x), self.label)
        below = x[:, self.feature] <= self.threshold
        out = np.empty(len(x), bool)
        out[below], out[~below] = self.low.predict(x[below]), self.high.predict(x[~below])
        return out


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Tree:
    """CART: the split of least Gini impurity, first feature and least threshold on ties, until pure or ``depth``."""
    if depth == 0 or y.all() or not y.any():
        return Tree(label=bool(2 * y.sum() >= len(y)))
    gini = lambda v: 2 * v.mean() * (1 - v.mean()) * len(v)
    best = (gini(y) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for threshold in (values[1:] + values[:-1]) / 2:
            below = x[:, f] <= threshold
            impurity = gini(y[below]) + gini(y[~below])
            if impurity < best[0] - 1e-9:
                best = (impurity, f, float(threshold))
    if best[1] < 0:
        return Tree(label=bool(2 * y.sum() >= len(y)))
    below = x[:, best[1]] <= best[2]
    return Tree(feature=best[1], threshold=best[2], low=fit_tree(x[below], y[below], depth - 1), high=fit_tree(x[~below], y[~below], depth - 1))


def default_tree() -> Tree:
    return fit_tree(*labelled())


def main_text(html: str | None, tree: Tree) -> str:
    page = blocks(html or "")
    if not page:
        return ""
    return "\n".join(b.text for b, keep in zip(page, tree.predict(features(page))) if keep)


def extract(pages: DataFrame, html_col: str = "html", tree: Tree | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text, in place of the html column.

    Null, empty and textless pages have an empty text; unclosed markup ends with the page; repeated rows repeat; other
    columns stay, but one named text is replaced. Each page is read whole, on its own, so nothing is shuffled.
    """
    chosen = tree or default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h, chosen) for h in batch.column(batch.num_columns - 1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], schema=pa.schema([*list(batch.schema)[:-1], pa.field("text", pa.string())]))

    rest = [c for c in pages.columns if c not in (html_col, "text")]
    narrow = pages.select(*rest, F.col(html_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, narrow.schema)
