"""Main text of web pages by text-to-tag ratio.

A streaming parser cuts a page into lines, one for each block of text, and counts the tags in each. The ratio of text
to tags is smoothed by a Gaussian over neighbouring lines and split into two clusters; the lines of the upper cluster
show which elements are content regions. All lines of these regions, all lines of the upper cluster, and headings and
paragraphs beside the regions are the text, but for those inside menus, asides, notices and the like.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import own_columns

SIGMA = 1.5
# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_REGION = frozenset("article body center div html main section table tbody td tr".split())
_PROSE = frozenset("blockquote h1 h2 h3 h4 h5 h6 p pre".split())
_PARAGRAPH_LIKE = frozenset("p h1 h2 h3 h4 h5 h6 dt dd li".split())
_NO_TEXT = frozenset("script style noscript template iframe object svg canvas head title nav aside form button select textarea input menu dialog footer audio video map".split())
_NAMES = re.compile(
    r"^(?:ads?|advert\w*|adsbygoogle|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|aside|widgets?|"
    r"footer\w*|masthead|comments?|commentlist|replies|reply|respond|disqus\w*|related\w*|recommend\w*|share|sharing|social\w*|subscribe|newsletter|signup|login|search\w*|pagination|pager|toolbar|topbar|skip|hidden)$", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())


class _Open(NamedTuple):
    """An open element: left out, the innermost region, the place of the innermost block, whether in an article."""

    tag: str
    out: bool
    region: int
    block: int
    article: bool


class _Line(NamedTuple):
    text: str
    tags: int
    region: int
    out: bool
    prose: bool


class _Lines(HTMLParser):
    """Lines in page order, and the regions around them: each one's element and the region it stands in, -1 if none.

    Nothing here looks through all open elements, so deep pages cost no more than flat ones.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.stack: list[_Open] = [_Open("", False, -1, 0, False)]
        self.places: dict[str, list[int]] = {}
        self.names: list[str] = []
        self.above: list[int] = []
        self.parts: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tags:
            top = self.stack[-1]
            self.lines.append(_Line(text, self.tags, top.region, top.out, self.stack[top.block].tag in _PROSE))
        self.parts, self.tags = [], 0

    def close_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def left_out(self, tag: str, attrs: list) -> bool:
        article = self.stack[-1].article
        if tag in _NO_TEXT or tag == "header" and not article:
            return True
        for key, value in attrs:
            if key in ("hidden",) or key == "aria-hidden" and value == "true" or key == "role" and (value or "").lower() in _ROLES:
                return True
            if key == "style" and re.search(r"display\s*:\s*none", value or "", re.I):
                return True
            if key in ("class", "id") and tag not in ("html", "body", "article", "main"):
                for name in (value or "").split():
                    # in an article only a whole name says so: social-history or related-work may be its subject
                    parts = [name] if article else [name, *re.split(r"[-_]+", name)[:1], *re.split(r"[-_]+", name)[-1:]]
                    if any(_NAMES.match(w) for w in parts):
                        return True
        return False

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self.flush()
            if tag in _PARAGRAPH_LIKE or tag in _REGION or tag in ("ul", "ol", "table"):
                # an open paragraph ends here, with whatever was left open inside
                place = self.stack[-1].block
                if place and (self.stack[place].tag == "p" or self.stack[place].tag == tag and tag in _PARAGRAPH_LIKE):
                    self.close_to(place)
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in _VOID:
            return
        top, region = self.stack[-1], self.stack[-1].region
        if tag in _REGION:
            region = len(self.names)
            self.names.append(tag)
            self.above.append(top.region)
        out = top.out or self.left_out(tag, attrs)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Open(tag, out, region, len(self.stack) if tag in _BLOCK else top.block, top.article or tag in ("article", "main")))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self.flush()
        self.tags += 1
        places = self.places.get(tag)
        # an inline element does not end outside its block
        if places and (tag in _BLOCK or places[-1] > self.stack[-1].block):
            self.close_to(places[-1])

    def handle_data(self, data):
        if not self.stack[-1].out:
            self.parts.append(data)


def _smoothed(ratio: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(3 * sigma) + 1
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[reach : reach + len(ratio)]
    return np.convolve(ratio, kernel)[reach : reach + len(ratio)] / weight


def _threshold(values: np.ndarray) -> float:
    """Between the centres of two clusters."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        cut = (low + high) / 2
        below, above = values[values < cut], values[values >= cut]
        if not len(below) or not len(above) or (below.mean(), above.mean()) == (low, high):
            break
        low, high = float(below.mean()), float(above.mean())
    return (low + high) / 2


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The text of a page's content regions, a line for each block; empty if there is none."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = [x for x in parser.lines if x.text and not x.out]
    if not lines:
        return ""
    names, parent = parser.names, parser.above
    ratio = _smoothed(np.array([len(x.text) / max(x.tags, 1) for x in lines]), sigma)
    cut = _threshold(ratio)
    upper = [x for x, value in zip(lines, ratio) if value >= cut]
    # regions are numbered in page order, so a region comes after the one it stands in
    weight = [0] * len(names)
    for x in upper:
        if x.region >= 0:
            weight[x.region] += len(x.text)
    for r in range(len(names) - 1, -1, -1):
        if parent[r] >= 0:
            weight[parent[r]] += weight[r]
    if not any(weight):
        return "\n".join(x.text for x in lines)

    def inside(kept: set[int]) -> list[bool]:
        """Of each region, whether it is in `kept` or in a region that is; the last entry is for lines in no region."""
        found = [False] * len(names) + [False]
        for r in range(len(names)):
            found[r] = r in kept or found[parent[r]]
        return found

    def around(kept: set[int]) -> list[bool]:
        """Of each region, whether one of `kept` stands in it; lines in no region count as around all."""
        found = [False] * len(names) + [True]
        for r in range(len(names) - 1, -1, -1):
            if (r in kept or found[r]) and parent[r] >= 0:
                found[parent[r]] = True
        return found

    # every marked article; where these hold less than half of the content lines, the innermost element with nearly all
    kept = {r for r in range(len(names)) if names[r] in ("article", "main")}
    held = inside(kept)
    marked = 2 * sum(len(x.text) for x in upper if held[x.region]) >= sum(len(x.text) for x in upper)
    if not marked:
        enough = 0.95 * max(weight)
        kept.add(max(r for r in range(len(names)) if weight[r] >= enough))
        held = inside(kept)
    # other content lines bring the element they stand in
    above = around(kept)
    kept |= {x.region for x in upper if x.region >= 0 and not held[x.region] and not above[x.region]}
    held, above = inside(kept), around(kept)

    def beside(region: int) -> bool:
        """In an element around a content region, or without marked articles in one next to it."""
        return above[region if marked or region < 0 else parent[region]]

    return "\n".join(x.text for x, value in zip(lines, ratio) if value >= cut or held[x.region] or x.prose and beside(x.region))


def extract(df: DataFrame) -> DataFrame:
    """For each row of `df` (page_id, url, html; others ignored): page_id, url, text, n_chars.

    A null, empty or text-free page gives an empty text. Nulls and repeats in the other columns are kept; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = own_columns(df, "page_id", "url", "html").select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
