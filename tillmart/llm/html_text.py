"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams events. Block tags cut the page into lines; a line knows its
text, how many tags were opened in it, and the element it stands in. A line's ratio is its number of
characters by its number of tags. The ratios are smoothed by a Gaussian, so that a short paragraph
among long ones is carried by its neighbours, and those above a threshold (a share of their standard
deviation) form clusters. The elements whose lines are in the clusters are the content regions; a
region is taken whole, as a one-word paragraph in it is part of the text.

Lines inside navigation, headers, footers, sidebars, forms, scripts and styles are never content. Nor
are those in elements whose class, id or role names them as adverts, notices, comments or the like, by a
whole name or a known compound. But names are only hints: a name does not count where the element is or
holds the main element, all articles or most of the dense lines (`_believed`).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

# Elements by what the HTML standard says about them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p"
    " pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe label menu nav noscript"
    " object optgroup option script select style svg template textarea title video".split()
)
REGIONS = ("article", "main")
#: Elements whose end tag may be left out: what opening one of the second closes.
CLOSED_BY = {
    "p": BLOCKS - {"html", "body"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "tr": frozenset({"tr"}),
}
#: Names in class, id or role of what is not the article.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs"
    " comment comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr"
    " header masthead menu menus modal nav navbar navigation newsletter notice notices notification"
    " pager pagination popup promo promoted promotion recommendations related replies reply respond"
    " search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe"
    " subscription toolbar widget widgets".split()
)
#: What readers write below an article is often longer than it.
THREADS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: What else a compound of those names may hold: where it is, or in what form.
AROUND = frozenset(
    "area article articles aside blog body bottom box button buttons center container content div"
    " dfp entry footer form global google gpt group header icons inline inner item items layer left"
    " links list main meta news outer overlay page panel post posts primary right row secondary"
    " section site slot story text thread top unit wrap wrapper".split()
)
WORD = re.compile(r"[a-z]+")
TAG = re.compile(r"<[A-Za-z/!?]")
#: The white space of HTML and of str.split alike.
SPACE = re.compile(r"\s+")


class Line(NamedTuple):
    text: str
    tags: int
    region: int  # the element it stands in
    content: bool  # not inside an element that is boilerplate by its tag
    named: bool  # inside an article or main element
    hint: int  # the innermost element that is boilerplate by its name, or 0


class _Open(NamedTuple):
    tag: str
    region: int
    content: bool
    named: bool
    hint: int


class Hint(NamedTuple):
    """An element that its class, id or role names as boilerplate."""

    outer: int  # the next such element around it, or 0
    thread: bool  # of comments


class LineParser(HTMLParser):
    """Collects lines; call `feed`, then `finish`."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[_Open] = [_Open("", 0, True, False, 0)]
        # Where each tag's open elements stand there; and all blocks, and all that cut lines.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.cutting: list[int] = []
        self.hints: list[Hint] = [Hint(0, False)]
        self.mains: set[int] = set()  # the innermost hints around a main element
        self.parts: list[str] = []
        self.tags = 0
        self.regions = 1

    def _cut(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            top = self.open[-1]
            self.lines.append(
                Line(text, max(1, self.tags), top.region, top.content, top.named, top.hint)
            )
            self.tags = 0
        self.parts.clear()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in SKIPPED:
            self._cut()
            self._close_implied(tag)
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        top = self.open[-1]
        content = top.content and tag not in SKIPPED
        region, named, hint = top.region, top.named, top.hint
        found = _boilerplate_names(attrs) if content and tag not in ("html", "body", "main") else None
        comment = False
        if found:
            # An article named so among comments is one of them.
            comment = tag == "article" and found <= THREADS and self.hints[hint].thread
            self.hints.append(Hint(hint, found <= THREADS))
            hint = len(self.hints) - 1
        if tag == "main" and content:
            self.mains.add(hint)
        if tag in REGIONS and content and not comment or not named and tag in ("div", "section", "td", "body"):
            self.regions += 1
            region, named = self.regions, named or tag in REGIONS
        place = len(self.open)
        self.open.append(_Open(tag, region, content, named, hint))
        self.places.setdefault(tag, []).append(place)
        for listed in self._lists(tag):
            listed.append(place)

    def _lists(self, tag: str) -> Iterator[list[int]]:
        """Those of the lists of places that have elements of this tag."""
        if tag in BLOCKS:
            yield self.blocks
        if tag in BLOCKS or tag in SKIPPED:
            yield self.cutting

    def _close(self, place: int) -> None:
        """Close the open element at this place and all in it."""
        while len(self.open) > place:
            tag = self.open.pop().tag
            self.places[tag].pop()
            for listed in self._lists(tag):
                listed.pop()

    def _close_implied(self, tag: str) -> None:
        """Close a paragraph or item that a new block ends, with what is inline in it."""
        if self.cutting and tag in CLOSED_BY.get(self.open[self.cutting[-1]].tag, ()):
            self._close(self.cutting[-1])

    def handle_endtag(self, tag: str) -> None:
        places = self.places.get(tag)
        if not places:
            return
        place = places[-1]
        # A stray end tag of an inline element ends no block.
        inline = tag not in BLOCKS and tag not in SKIPPED
        if inline and self.blocks and self.blocks[-1] > place:
            return
        if self.cutting and self.cutting[-1] >= place:
            self._cut()
        self._close(place)

    def handle_data(self, data: str) -> None:
        if self.open[-1].content:
            self.parts.append(data)

    def finish(self) -> list[Line]:
        if TAG.match(self.rawdata):
            self.rawdata = ""  # a tag that the page's end cuts off is no text
        self.close()
        self._cut()
        return self.lines


def _boilerplate_names(attrs: list[tuple[str, str | None]]) -> set[str]:
    """The words of BOILERPLATE that a class, id or role consists of, alone or in a known compound.

    Of "block__element--modifier" the element counts.
    """
    found: set[str] = set()
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            for name in value.lower().split():
                words = set(WORD.findall(name.split("--")[0].split("__")[-1]))
                own = words & BOILERPLATE
                if own and words - own <= AROUND:
                    found |= own
    return found


def _believed(hints: list[Hint], mains: set[int], lines: list[Line], dense: np.ndarray) -> list[bool]:
    """Which elements are the boilerplate that their name says.

    Not those that hold the main element, or without which no line of the articles would be left if there
    are any; nor those with more than half of the dense text, by characters. Comments are often more
    than that, so they have to hold all of it. If nothing dense is left then, no name counts.
    """
    inside = np.zeros((len(hints), 2))  # characters of articles, of dense lines
    for line, is_dense in zip(lines, dense):
        inside[line.hint] += len(line.text) * np.array([line.named, is_dense])
    holds_main = [i in mains for i in range(len(hints))]
    for i in range(len(hints) - 1, 0, -1):  # inner ones come after outer ones
        inside[hints[i].outer] += inside[i]
        holds_main[hints[i].outer] |= holds_main[i]
    article, total = inside[0]
    gone = [False] * len(hints)
    for i, hint in enumerate(hints[1:], 1):
        most = inside[i, 1] == total if hint.thread else 2 * inside[i, 1] > total
        believed = not (holds_main[i] or article and inside[i, 0] == article or most)
        gone[i] = gone[hint.outer] or believed
    if not any(is_dense and not gone[line.hint] for line, is_dense in zip(lines, dense)):
        return [False] * len(hints)
    return gone


def _dense(lines: list[Line], radius: int, share: float) -> np.ndarray:
    """Which lines' smoothed ratios reach the threshold."""
    ratios = smoothed(np.array([len(line.text) / line.tags for line in lines]), radius)
    return ratios >= min(share * ratios.std(), ratios.max())


def smoothed(ratios: np.ndarray, radius: int) -> np.ndarray:
    """Gaussian average over `radius` lines to either side; at the ends over those there are."""
    offsets = np.arange(-radius, radius + 1)
    kernel = np.exp(-(offsets**2) / (2 * max(radius / 2, 0.5) ** 2))
    full = np.convolve(ratios, kernel)[radius : radius + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]


def main_text(html: str | None, radius: int = 2, share: float = 0.5) -> str:
    """The blocks of the content regions, joined by line ends; empty for null or no text.

    `share` times the standard deviation of the smoothed ratios is the threshold, at most the
    largest of them. Articles and main elements are regions as a whole if there are any;
    otherwise the innermost div, section, cell or body of each line is.
    """
    if not html:
        return ""
    parser = LineParser()
    parser.feed(html)
    lines = [line for line in parser.finish() if line.content]
    if lines and len(parser.hints) > 1:
        # Most of the dense text is asked of the articles, if there are any.
        asked = [line for line in lines if line.named] or lines
        gone = _believed(parser.hints, parser.mains, asked, _dense(asked, radius, share))
        lines = [line for line in lines if not gone[line.hint]]
    if any(line.named for line in lines):
        lines = [line for line in lines if line.named]
    if not lines:
        return ""
    dense = _dense(lines, radius, share)
    regions = {line.region for line, is_dense in zip(lines, dense) if is_dense}
    return "\n".join(line.text for line in lines if line.region in regions)


def with_main_text(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """Add the column `into`: the main text of each page, empty where there is none.

    All rows and other columns stay; a column named `into` is replaced.
    """
    from pyspark.sql import types as T

    if into == html:
        raise ValueError("the text cannot replace the page it is read from")
    kept = pages.drop(into)
    schema = T.StructType([*kept.schema.fields, T.StructField(into, T.StringType())])
    at, names = kept.columns.index(html), schema.names

    def extract(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return kept.mapInArrow(extract, schema)
