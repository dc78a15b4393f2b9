"""Main text of HTML pages: parser events, text-to-tag ratios, smoothing, clustering, content region.

The events of the standard library's parser are read once per page. They give lines, one per block of text, each with its
text-to-tag ratio: the characters of the block over its tags. The ratios are smoothed with a Gaussian along the page and
split by two-means clustering; lines of the upper cluster are content. If the smallest container with nearly all characters
of the upper cluster lies in an article or main element, all lines of that element are the text. Else the cluster decides:
besides its lines, the text has the lines that stand directly in a container around one of them, and those between the
first and the last of them; lines of nothing but links must meet both. Other containers are left out, marked or not.

Elements that are no article text by their name (scripts, forms, menus, headers, footers, asides) or by their role or by
all words of one of their classes or their id (sidebars, notices, adverts, reader comments) are left out wherever they are,
with two exceptions. An article or main element inside a menu or the like that is never closed counts as outside of it. And
roles, classes and ids only rule out small blocks: if no line of an article or main element is left, an element with one,
or with most of the text, is not left out.

Character references are decoded, white space in a block becomes one space, blocks are joined by line breaks. Null, empty
or textless pages give an empty text. Tags may be unclosed and pages may end anywhere. Rows are handled one by one.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexiloom.llm.common import append_columns

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements whose contents are no text of the page.
NO_TEXT = frozenset(
    "head title script style noscript template iframe object svg canvas audio video map button select option textarea fieldset input".split()
)
#: Elements whose contents are no article text.
LEFT_OUT = frozenset("nav menu header footer aside form dialog".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Words of classes and ids that mark such elements, and words that may stand beside them.
MARKS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar side aside ad ads advert adverts "
    "advertisement sponsor sponsored promo cookie cookies consent gdpr notice notices banner popup modal overlay newsletter "
    "subscribe signup login search form social share sharing comment comments commentlist replies reply disqus related "
    "recommended widget toolbar pagination pager skip".split()
)
BESIDE = frozenset(
    "site page top bottom left right main global primary secondary wrapper wrap container inner outer box block list item items "
    "section area bar links link buttons button post reader user js the".split()
)


def marks(value: str) -> bool:
    """Whether one of the classes (or the id) says that an element is no article text: with all of its words."""
    for name in value.lower().split():
        words = [word for word in re.split(r"[_-]+", name) if word and not word.isdigit()]
        if any(word in MARKS for word in words) and all(word in MARKS or word in BESIDE for word in words):
            return True
    return False


CONTAINERS = frozenset("article main section div body html td center blockquote".split())
_KEPT_NAMES = frozenset(("html", "body", "article", "main"))
CLOSED_BY_BLOCK = frozenset(("p",))
SIGMA, RADIUS = 1.5, 4
REGION_SHARE = 0.8


class _Line(NamedTuple):
    text: str
    tags: int
    #: Numbers of the containers around it.
    path: tuple[int, ...]
    #: Whether there is text outside links.
    plain: bool
    #: Numbers of the elements that may leave it out.
    vetoes: tuple[int, ...]


class _Lines(HTMLParser):
    """Lines of a page, with what is around them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # name, number, whether its text is dropped
        self.names: list[str] = []
        #: Elements that may leave out what is in them: whether by a role, class or id only; and those with an end tag.
        self.vetoes: dict[int, bool] = {}
        self.closed: set[int] = set()
        self.lines: list[_Line] = []
        self.text: list[str] = []
        self.tags = 0
        self.plain = False

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            path = tuple(number for name, number, _ in self.stack if name in CONTAINERS)
            vetoes = tuple(number for _, number, _ in self.stack if number in self.vetoes)
            self.lines.append(_Line(text, max(self.tags, 1), path, self.plain, vetoes))
        self.text, self.tags, self.plain = [], 0, False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
        else:
            self.flush()
            while self.stack and self.stack[-1][0] in CLOSED_BY_BLOCK | INLINE:
                self.stack.pop()
        self.tags += 1
        if tag in VOID:
            return
        marked = tag not in _KEPT_NAMES and any(
            name in ("class", "id") and value is not None and marks(value)
            or name == "role" and value is not None and value.lower() in LEFT_OUT_ROLES
            or name == "hidden"
            for name, value in attrs
        )
        number = len(self.names)
        self.names.append(tag)
        if tag not in INLINE and (marked or tag in LEFT_OUT):
            self.vetoes[number] = tag not in LEFT_OUT
        dropped = tag in NO_TEXT or marked and tag in INLINE
        self.stack.append((tag, number, dropped or bool(self.stack and self.stack[-1][2])))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        self.tags += 1
        for at in range(len(self.stack) - 1, -1, -1):
            name, number, _ = self.stack[at]
            if name == tag:
                self.closed.add(number)
                del self.stack[at:]
                return
            # An inline end tag never closes a block around it, nor any end tag an article or a cell around it.
            if (tag in INLINE and name not in INLINE) or name in ("article", "body", "td"):
                if tag not in ("html", "body", "article", "main", "table"):
                    return

    def handle_data(self, data: str) -> None:
        if not (self.stack and self.stack[-1][2]):
            self.text.append(data)
            if not self.plain and not any(name == "a" for name, _, _ in self.stack):
                self.plain = any(c.isalnum() for c in data)

    def in_article(self, line: _Line, after: int = -1) -> bool:
        """Whether an article or main element with a number above ``after`` is around a line."""
        return any(number > after and self.names[number] in ("article", "main") for number in line.path)

    def kept(self) -> list[_Line]:
        """The lines that no element leaves out."""

        def rules_out(veto: int, line: _Line) -> bool:
            return veto in self.closed or not self.in_article(line, veto)

        left = [line for line in self.lines if not any(rules_out(veto, line) for veto in line.vetoes)]
        if any(self.in_article(line) for line in left):
            return left
        by_name = [veto for veto, soft in self.vetoes.items() if not soft]
        rest = [line for line in self.lines if not any(veto in by_name and rules_out(veto, line) for veto in line.vetoes)]
        total = sum(len(line.text) for line in rest)
        inside: dict[int, int] = {}
        holds: set[int] = set()
        for line in rest:
            for veto in line.vetoes:
                inside[veto] = inside.get(veto, 0) + len(line.text)
                if self.in_article(line, veto):
                    holds.add(veto)
        large = {veto for veto, size in inside.items() if veto in holds or 2 * size > total}
        return [line for line in rest if not any(veto not in large and rules_out(veto, line) for veto in line.vetoes)]


def _content(ratios: np.ndarray) -> np.ndarray:
    """Marks the lines of the upper of two clusters of smoothed ratios."""
    reach = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratios)), kernel)[RADIUS : RADIUS + len(ratios)]
    smooth = np.convolve(ratios, kernel)[RADIUS : RADIUS + len(ratios)] / weight
    low, high = float(smooth.min()), float(smooth.max())
    for _ in range(50):
        middle = (low + high) / 2
        upper = smooth > middle
        if not upper.any() or upper.all():
            break
        new = float(smooth[~upper].mean()), float(smooth[upper].mean())
        if new == (low, high):
            break
        low, high = new
    upper = smooth > (low + high) / 2
    return upper if upper.any() else np.ones(len(ratios), dtype=bool)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.kept()
    if not lines:
        return ""
    upper = _content(np.array([len(line.text) / line.tags for line in lines], dtype=float))
    region = _marked_region(parser, lines, upper)
    if region is not None:
        return "\n".join(line.text for line in lines if region in line.path)
    places = np.flatnonzero(upper)
    around = {number for at in places.tolist() for number in lines[at].path}
    chosen = []
    for at, line in enumerate(lines):
        between = places[0] <= at <= places[-1]
        beside = not line.path or line.path[-1] in around
        if upper[at] or between and beside or line.plain and (between or beside):
            chosen.append(line.text)
    return "\n".join(chosen)


def _marked_region(parser: _Lines, lines: list[_Line], upper: np.ndarray) -> int | None:
    """The article or main element around the container with nearly all characters of the upper cluster."""
    weights: dict[int, int] = {}
    total = 0
    for line, is_upper in zip(lines, upper, strict=True):
        if is_upper:
            total += len(line.text)
            for number in line.path:
                weights[number] = weights.get(number, 0) + len(line.text)
    inner = max((n for n, w in weights.items() if w >= REGION_SHARE * total), default=None)
    if inner is None:
        return None
    path = next(line.path for line in lines if inner in line.path)
    above = path[: path.index(inner) + 1]
    return next((n for name in ("article", "main") for n in above if parser.names[n] == name), None)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    outputs = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(lists: list[list]) -> list[list]:
        texts = [main_text(html) for html in lists[0]]
        return [texts, [len(text) for text in texts]]

    return append_columns(pages.select("page_id", "url", "html"), ["html"], outputs, run).drop("html")
