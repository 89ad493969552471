"""The main text of web pages from text-to-tag ratios of their lines.

The standard library's parser streams a page's events. A line is the text of one block element, with
the number of tags met in it; its ratio is characters per tag. Ratios are smoothed with a Gaussian
along the page, a threshold splits them into content and the rest, and the content lines choose the
region of the page: the smallest block that holds them all. All lines of that region are the text,
short ones too, but for blocks that are never part of an article (menus, adverts, forms, comments and
the like). An <article> or <main> around the region widens it; one inside it breaks the tie between
the region's blocks if it holds most of the content.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fareflow.llm.common import map_rows

# Fixed values of HTML: elements without an end tag, and elements that flow inside a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var img wbr".split()
)
#: Elements that are never part of an article.
ASIDE = set(
    "head title nav header footer aside form script style noscript template iframe object svg canvas button "
    "select textarea dialog menu audio video map math".split()
)
#: Elements that a page's main text stands in.
MAIN = {"article", "main"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that end where the next block begins.
CLOSED_BY_BLOCK = {"p"}
#: Elements that end where another of their kind begins, and the elements that such an end stays inside.
CLOSED_BY_SAME = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"},
}
#: Words of a class or id that mark such blocks on any element, and roles that do.
MARKS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside footer masthead header notice notices alert cookie cookies "
    "consent gdpr disclaimer legal copyright popup modal newsletter subscribe subscription signup login comment comments commentlist respond "
    "reply replies disqus share sharing social related recommended pagination pager toolbar widget skip".split()
)
#: Words that go with a mark in the name of such a block: "ad-slot", "comments-list".
FRAMES = set("box wrap wrapper container content slot block section list item area bar left right top bottom main form unit".split())
#: Marks that count on a paragraph too; "legal" or "alert" on a paragraph is as likely its subject.
PARAGRAPH_MARKS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_MARK = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _is_mark(name: str, marks: set[str]) -> bool:
    """Whether all of a name marks a block: "related" and "ad-slot" do, "related-work" is about a subject."""
    words = _MARK.findall(_CAMEL.sub(" ", name).lower())
    return any(w in marks for w in words) and all(w in MARKS or w in FRAMES for w in words)


def marked(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether an element is never part of an article."""
    if tag in ASIDE:
        return True
    for name, value in attrs:
        if name == "hidden":
            return True
        if value and tag not in ("html", "body"):
            if name in ("class", "id"):
                if any(map(_is_mark, value.split(), repeat(PARAGRAPH_MARKS if tag == "p" else MARKS))):
                    return True
            elif name == "role" and value.strip().lower() in ROLES:
                return True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                return True
            elif name == "aria-hidden" and value.strip().lower() == "true":
                return True
    return False


class Block:
    """A block element: what it stands in, and which lines stand in it; lines of a block are neighbours."""

    __slots__ = ("tag", "parent", "depth", "main", "start", "end")

    def __init__(self, tag: str, parent: Block | None, is_main: bool, start: int):
        self.tag, self.parent, self.start, self.end = tag, parent, start, start
        self.depth: int = parent.depth + 1 if parent else 0
        #: The outermost <article> or <main> that it is or stands in.
        self.main: Block | None = (parent.main if parent else None) or (self if is_main else None)


@dataclass
class Line:
    """The text of a block, the tags met in it, and the innermost block it stands in."""

    text: str
    tags: int
    block: Block


class Element:
    """An open element; ``block`` is None for one that flows inside a line."""

    __slots__ = ("tag", "aside", "block", "alive")

    def __init__(self, tag: str, aside: bool, block: Block | None):
        self.tag, self.aside, self.block, self.alive = tag, aside, block, True


class Lines(HTMLParser):
    """Collects the lines of a page outside the blocks that are never part of an article.

    Places of open elements are kept by tag, so that no event looks through all that is open: the time
    of a page is in proportion to its length, however deep it is nested.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Block("", None, False, 0)
        self.open: list[Element] = []
        #: Places in ``open`` of each tag's elements, and of all blocks; an inline element that has ended among
        #: others stays in ``open``, no longer alive.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.lines: list[Line] = []
        self.pieces: list[str] = []
        self.tags = 0

    @property
    def block(self) -> Block:
        return self.open[self.blocks[-1]].block if self.blocks else self.page

    def end_line(self) -> None:
        if text := " ".join("".join(self.pieces).split()):
            self.lines.append(Line(text, self.tags, self.block))
        self.pieces, self.tags = [], 0

    @property
    def aside(self) -> bool:
        return bool(self.open) and self.open[-1].aside

    def push(self, tag: str, attrs, is_block: bool) -> None:
        aside = self.aside or marked(tag, attrs)
        block = Block(tag, self.block, tag in MAIN and not aside, len(self.lines)) if is_block else None
        if is_block:
            self.blocks.append(len(self.open))
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(Element(tag, aside, block))

    def close_from(self, place: int) -> None:
        """Ends the elements from a place on, and the ended ones before it."""
        while len(self.open) > place or self.open and not self.open[-1].alive:
            element = self.open.pop()
            if element.alive:
                self.places[element.tag].pop()
            if element.block is not None:
                self.blocks.pop()
                element.block.end = len(self.lines)

    def last(self, tags) -> int:
        """The place of the innermost open element of some tags; -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in INLINE or tag in VOID:
            if tag == "hr":
                self.end_line()
            elif tag == "br":
                self.pieces.append(" ")
            if tag not in VOID:
                self.push(tag, attrs, False)
            return
        self.end_line()
        if tag == "body" and self.places.get("head"):
            self.close_from(self.places["head"][0])
        elif tag in CLOSED_BY_SAME:
            same = {"td", "th"} if tag in ("td", "th") else {"dt", "dd"} if tag in ("dt", "dd") else {tag}
            place = self.last(same)
            if place > self.last(CLOSED_BY_SAME[tag]):
                self.close_from(place)
        elif self.block.tag in CLOSED_BY_BLOCK:
            # A paragraph ends where the next block begins, with what is open inside it.
            self.close_from(self.blocks[-1])
        self.push(tag, attrs, True)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        place = self.last((tag,))
        if tag in INLINE:
            # A stray end tag of a line does not end the block around it.
            if place >= 0 and place > (self.blocks[-1] if self.blocks else -1):
                self.places[tag].pop()
                self.open[place].alive = False
                self.close_from(len(self.open))
        elif place >= 0:
            self.end_line()
            self.close_from(place)
        else:
            self.end_line()
            if tag == "br":
                self.pieces.append(" ")

    def handle_data(self, data):
        if not self.aside:
            self.pieces.append(data)

    def finish(self) -> list[Line]:
        self.close()
        self.end_line()
        self.close_from(0)
        self.page.end = len(self.lines)
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing along the page; weights beyond its ends are left out."""
    reach = int(np.ceil(2 * sigma))
    weights = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    total = np.convolve(ratios, weights)[reach : reach + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), weights)[reach : reach + len(ratios)]


def threshold(values: np.ndarray, rounds: int = 20) -> float:
    """The point between the means of a low and a high cluster of the values."""
    low, high = float(values.min()), float(values.max())
    for _ in range(rounds):
        middle = (low + high) / 2
        upper = values > middle
        if not upper.any() or upper.all():
            break
        low, high = float(values[~upper].mean()), float(values[upper].mean())
    return (low + high) / 2


def content(lines: list[Line]) -> np.ndarray:
    """Which lines are content by their ratios: smoothed, and not by their neighbours' alone."""
    ratios = np.array([len(line.text) / max(line.tags, 1) for line in lines], float)
    values = smoothed(ratios)
    least = min(threshold(values), float(values.max()))
    own = (values >= least) & (ratios >= least)
    return own if own.any() else values >= least


def common_block(a: Block, b: Block) -> Block:
    """The innermost block around two."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a


def region(lines: list[Line]) -> list[Line]:
    """The lines of the smallest block that holds all content lines, and the headings it stands under.

    An article around that block is taken whole. Of content inside and outside of articles, those with
    most of it are taken; of content all over the page and in no article, so that no block is singled
    out, any articles.
    """
    chosen = [line for line, is_content in zip(lines, content(lines)) if is_content]
    # Lines stand in the order of the page, so a block around the first and the last is around all.
    block = common_block(chosen[0].block, chosen[-1].block)
    if block.main:
        return lines[block.main.start : block.main.end]
    # Up to a block with other lines beside it: a line is no region, and a block around a block no other one.
    while block.parent and block.end - block.start == 1 < len(lines):
        block = block.parent
    held = [x for x in chosen if x.block.main]
    tops = {id(x.block.main) for x in held}
    if tops and 2 * sum(len(x.text) for x in held) >= sum(len(x.text) for x in chosen):
        return [line for line in lines if id(line.block.main) in tops]
    if block.end - block.start == len(lines):
        return [line for line in lines if line.block.main and not tops] or lines
    while (block.parent.start, block.parent.end) == (block.start, block.end):
        block = block.parent
    before, start = block.start, block.start
    while before > block.parent.start and (
        lines[before - 1].block.depth <= block.depth or lines[before - 1].block.tag in HEADING
    ):
        before -= 1
    while before < start and lines[before].block.tag not in HEADING | {"p"}:
        before += 1
    return lines[before : block.end]


def main_text(html: str | None) -> str:
    """The main text of a page; empty if it has none."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.finish()
    return " ".join(line.text for line in region(lines)) if lines else ""


def extract(pages: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows with text (empty if a page has none, or is null) and n_chars, its code points.

    Every row is a page of its own, also a repeated one. A page is one row of a task however long it is; its time grows
    with its length, not with its nesting. Columns of those names are replaced, others stay; an empty table gives none.
    """

    def make():
        def compute(batch: pa.RecordBatch):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            return {"text": texts, "n_chars": [len(t) for t in texts]}

        return compute

    return map_rows(pages, make, "text string, n_chars long", drop, "html")
