"""HTML extraction by text-to-tag ratios over streaming parser events.

The standard-library parser's events are read once per page. Block elements end a line; a line
has its text, the number of tags since the line before it, and the element that contains it. Elements that are page furniture
by their tag, role or being hidden (menus, headers, footers, scripts, styles) give no lines. A class or id that names furniture
(sidebars, notices, adverts, reader comments), and a form, are evidence only: such elements give no lines unless they hold
most of the page's text, and either are built like an article where no other one is, or leave only short lines to the rest. The lines' ratios of characters to tags are smoothed with a Gaussian, and
split in two clusters by the threshold that separates them best; the regions (the enclosing article or main element, else
the nearest container, widened to containers that mostly are content) that hold lines of the upper cluster are the content, with all their lines in page order.

Time and memory are linear in the page, however many elements are marked, nested or never closed.

Defined cases: a null or empty page, or one without content, gives the empty text; markup that is never closed ends with
its parent; repeated rows are extracted one by one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SIGMA = 1.0

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img".split()
)
_FURNITURE = frozenset(
    "nav footer aside script style noscript template iframe object svg math canvas button select textarea dialog menu head title audio video map".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist".split())
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu submenu breadcrumb breadcrumbs "
    "sidebar side footer masthead header topbar toolbar cookie cookies consent gdpr notice notices notification popup modal overlay alert comment comments "
    "commentlist disqus respond reply replies share sharing social related recommended recommendations newsletter subscribe subscription signup login search "
    "pagination pager widget widgets skip hidden copyright disclaimer paywall trackback trackbacks pingback discussion feedback adsbygoogle adsense adslot "
    "adbox adunit taboola outbrain".split()
)
SHARE, REST = 0.5, 0.25  # of the text that marked elements must hold; of their text and ratio that the rest may have
_BODY_WORDS = frozenset("article post entry content story main body text page".split())
_REGIONS = ("article", "main")
_HOLDERS = frozenset("aside footer form section template noscript dialog ol ul".split())  # furniture that an article may stand in
_CONTAINERS = frozenset("article main section div td body html blockquote center".split())
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_SECTION = re.compile(r"<!\[\s*([a-zA-Z]*)")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _is_furniture(tag: str, attrs: list[tuple[str, str | None]], in_region: bool, by_name: bool) -> bool:
    if tag in _FURNITURE or tag == "header" and not in_region:
        return True
    if not by_name or not attrs or tag in ("html", "body"):
        return False
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if not value:
            continue
        if name == "role" and value.lower() in _ROLES - {"form"} or name == "style" and _HIDDEN.search(value):
            return True
    return False


def _mark(tag: str, attrs: list[tuple[str, str | None]], by_name: bool) -> tuple[str, bool] | None:
    """What marks an element as furniture by its class, id or being a form (None: nothing), and whether it is built like an article all the same."""
    hits: list[str] = []
    bare = body = False
    for name, value in attrs if by_name and tag not in ("html", "body", "main") else ():
        if name == "role" and (value or "").lower() == "form":
            hits.append("form")
        if name in ("class", "id"):
            for one in (value or "").split():
                marks = {w.lower() for w in _SPLIT.split(one) if w}
                hit = marks & _MARKS
                if hit and not (marks & _BODY_WORDS and hit <= {"header", "banner", "page", "text"}):
                    hits.append(" ".join(sorted(hit)))
                    bare |= marks == hit
                elif marks & _BODY_WORDS:
                    body = True
    if tag == "form":
        hits.append("form")
    return (" ".join(hits), body or tag == "article" and not bare) if hits else None


class _Lines(HTMLParser):
    """Collects (text, tags, region) per line, and for each the innermost marked element and whether it is inside an article."""

    def __init__(self, by_name: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.by_name = by_name
        self.parent: dict[int, int] = {}  # of each region but the page itself
        self.lines: list[tuple[str, int, int]] = []
        self.of: list[tuple[int, bool]] = []  # per line: the marked element around it (0: none), inside an article or main element
        self.stack: list[tuple[str, int, bool]] = []  # tag, region, furniture
        self.places: dict[str, list[int]] = {}  # of the open elements by tag, and of those that are blocks: their places in the stack
        self.blocks: list[int] = []
        self.articles = self.holders = 0  # open article and main elements; open furniture and marked elements that are holders
        self.marks: list[tuple[str, bool]] = [("", False)]  # by number of the marked element
        self.marked: list[tuple[int, int, int, bool]] = []  # the open ones: place in the stack, number, and the tags and whole outside
        self.parts: list[str] = []
        self.tags = self.regions = 0
        self.off = 0  # open furniture elements
        self.region, self.whole = 0, False  # whole: inside an article or main element
        self.endless: set[str] = set()  # kinds of markup that were found not to end: no later one does either

    def _end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.lines.append((text, self.tags, self.region))
                self.of.append((self.marked[-1][1] if self.marked else 0, self.whole))
                self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("body", "article", "main") and (self.off or self.marked) and self._leave_loose(tag, attrs):
            self._end_line()
        if self.off:
            if tag not in _VOID:
                self._push(tag, False)
            return
        self.tags += 1
        if tag not in _INLINE:
            self._end_line()
        if tag in _VOID:
            return
        furniture = _is_furniture(tag, attrs, self.whole, self.by_name)
        mark = None if furniture else _mark(tag, attrs, self.by_name)
        self._push(tag, furniture)
        self.holders += tag in _HOLDERS and bool(furniture or mark)
        if furniture:
            self._end_line()
            self.off += 1
            return
        if mark:
            self._end_line()
            self.marked.append((len(self.stack) - 1, len(self.marks), self.tags, self.whole))
            self.marks.append(mark)
            self.tags = 0
        if tag in _REGIONS and not self.whole:
            self.regions += 1
            self.region, self.whole = self.regions, True
        elif tag in _CONTAINERS and not self.whole:
            self.regions += 1
            if tag not in ("html", "body"):
                self.parent[self.regions] = self.region
            self.region = self.regions

    def _leave_loose(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        """Ends furniture that was never closed when the page's body or article begins."""
        if tag != "body" and self.holders or _is_furniture(tag, attrs, False, self.by_name) or _mark(tag, attrs, self.by_name):
            return False
        while self.stack and (self.off or self.marked):
            self._pop()
        return True

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do, "/>" closes only void elements

    def _push(self, tag: str, furniture: bool) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in _INLINE:
            self.blocks.append(len(self.stack))
        self.articles += tag in _REGIONS and not furniture
        self.stack.append((tag, self.region, furniture))

    def _pop(self) -> None:
        marked = bool(self.marked) and self.marked[-1][0] == len(self.stack) - 1
        if marked:
            self._end_line()  # also where its tag is an inline one
        tag, self.region, furniture = self.stack.pop()
        self.places[tag].pop()
        if tag not in _INLINE:
            self.blocks.pop()
        self.articles -= tag in _REGIONS and not furniture
        self.off -= furniture
        self.holders -= tag in _HOLDERS and (furniture or marked)
        if marked:
            _, _, self.tags, self.whole = self.marked.pop()
        elif tag in _REGIONS:
            self.whole = self.articles > 0

    def handle_endtag(self, tag: str) -> None:
        if not self.off:
            self.tags += 1
            if tag not in _INLINE:
                self._end_line()
        if tag in _VOID:
            return
        places = self.places.get(tag)
        if not places:
            return
        at = places[-1]
        if tag in _INLINE and self.blocks and self.blocks[-1] > at:
            return  # an inline end tag does not close blocks
        while len(self.stack) > at:
            self._pop()

    def _once(self, kind: str, parse: Callable[[int], int], i: int) -> int:
        """``parse(i)``, but the rest of the page is not searched again for the end of a kind that has none."""
        k = -1 if kind in self.endless else parse(i)
        if k < 0:
            self.endless.add(kind)
        return k

    def parse_starttag(self, i: int) -> int:
        if "tag" not in self.endless and self.rawdata.find(">", i) < 0:
            self.endless.add("tag")
        return -1 if "tag" in self.endless else super().parse_starttag(i)

    def parse_comment(self, i: int, report: int = 1) -> int:
        return self._once("comment", lambda i: super(_Lines, self).parse_comment(i, report), i)

    def parse_pi(self, i: int) -> int:
        return self._once("instruction", super().parse_pi, i)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        name = _SECTION.match(self.rawdata, i)
        return self._once(name.group(1).lower() if name else "section", lambda i: super(_Lines, self).parse_marked_section(i, report), i)

    def handle_data(self, data: str) -> None:
        if not self.off:
            self.parts.append(data)

    def finish(self) -> list[tuple[str, int, int]]:
        self.close()
        self._end_line()
        kept = self._kept()
        return [line for line, (n, _) in zip(self.lines, self.of) if n in kept]

    def _kept(self) -> set[int]:
        """The marked elements that are content after all, and 0: their lines count like any other."""
        own: dict[int, int] = {}
        for (text, _, _), (n, _) in zip(self.lines, self.of):
            own[n] = own.get(n, 0) + len(text)
        rest = own.pop(0, 0)
        if not own:
            return {0}
        total = rest + sum(own.values())
        around = {n for n, whole in self.of if whole}  # with lines inside an article
        like = {n for n in own if self.marks[n][1] or n in around}  # built like, or around, an article
        if sum(own[n] for n in like) >= SHARE * total and 0 not in around:
            return {0} | like

        def top(of: set[int]) -> float:
            """The highest smoothed ratio of their lines."""
            found = [len(t) / max(1, tags) for (t, tags, _), (n, _) in zip(self.lines, self.of) if n in of]
            return float(smoothed(np.array(found)).max()) if found else 0.0

        named: dict[str, set[int]] = {}
        for n in own:
            named.setdefault(self.marks[n][0], set()).add(n)
        for same in named.values():  # two of them at most hold the share
            held = sum(own[n] for n in same)
            if held >= SHARE * total and rest <= REST * held and top({0}) <= REST * top(same):
                return {0} | same
        return {0}


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios convolved with a Gaussian; at the ends the kernel is cut and rescaled."""
    r = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[r : r + len(ratios)]
    return np.convolve(ratios, kernel)[r : r + len(ratios)] / weight


def threshold(values: np.ndarray) -> float:
    """The cut into two clusters with the least squared error within them."""
    v = np.sort(values)
    n = len(v)
    if n < 2 or v[0] == v[-1]:
        return float(v[0])
    total = np.cumsum(v)
    k = np.arange(1, n)
    between = k * (n - k) * (total[:-1] / k - (total[-1] - total[:-1]) / (n - k)) ** 2
    return float(v[int(np.argmax(between)) + 1])


def extract(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    lines = parser.finish()
    if not lines:  # a wrapper of everything that is named like furniture
        parser = _Lines(by_name=False)
        parser.feed(html)
        lines = parser.finish()
    if not lines:
        return ""
    ratios = smoothed(np.array([len(t) / max(1, tags) for t, tags, _ in lines], float))
    cut = threshold(ratios)
    content = {region for (_, _, region), r in zip(lines, ratios) if r >= cut}
    content = _widened(content, lines, parser.parent)
    return " ".join(t for t, _, region in lines if region in content)


def _widened(content: set[int], lines: list[tuple[str, int, int]], parent: dict[int, int]) -> set[int]:
    """``content`` with the other regions of each container that consists of content for the most part."""
    if not parent:
        return content
    size: dict[int, list[int]] = {}  # of each region with those in it: all characters, and those of content
    for text, _, region in lines:
        both = size.setdefault(region, [0, 0])
        both[0] += len(text)
        both[1] += len(text) * (region in content)
    for region in sorted(parent, reverse=True):  # a region's number is above its parent's
        if region in size:
            both = size.setdefault(parent[region], [0, 0])
            both[0] += size[region][0]
            both[1] += size[region][1]
    wide = set()
    for region in sorted(parent):
        all_chars, chosen = size.get(region, (0, 0))
        if chosen and 2 * chosen >= all_chars or parent[region] in wide:
            wide.add(region)
    return content | {region for _, _, region in lines if region in wide}


@F.pandas_udf(StringType())
def _extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield pd.Series([extract(h) for h in batch], dtype=object)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every page; one narrow pass."""
    return pages.select("page_id", "url", _extracted(F.col("html")).alias("text"))


def report(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    return extract_pages(pages).withColumn("n_chars", F.char_length("text").cast("long"))
