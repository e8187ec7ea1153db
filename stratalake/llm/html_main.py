"""Main text of HTML pages from parser events, text-to-tag ratios, smoothing and threshold clustering.

The standard library's parser reports events as it reads; blocks of text become lines with their ratio of
characters outside links to tags. Ratios are smoothed with a Gaussian and split at the threshold that separates them
best. The main element is the smallest one that covers all lines above it; article and main elements that hold most of
their text go first. All blocks of the main element are its text, short ones and links too, but for parts marked as
something else: menus, headers, footers, sidebars, notices, adverts, forms, comments. Marks by class or id names only
count for elements that hold neither an article or main element nor most of the text above the threshold.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import whole_text

SIGMA = 1.0
MAJORITY = 0.7
_WIDTH = 1000.0  # ratios above count alike, so one long line does not hide the others

# fixed values: element names of the HTML standard
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style noscript template svg math canvas object iframe head title select option button textarea".split())
_OTHER = frozenset("nav footer aside form dialog menu".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_ENDS_PARAGRAPH = _BLOCK - {"caption", "dd", "dt", "legend", "li", "summary", "tbody", "td", "tfoot", "th", "thead", "tr", "html", "body"}
_HOLDERS = frozenset("article body center div main section td".split())
_SAME_KIND = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
# names that pages give to parts that are not the article
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc footer masthead topbar "
    "sidebar aside widget widgets related recommended teaser share sharing social "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login "
    "comment comments commentlist reply replies respond discussion disqus".split()
)
_PAGE_HEADER = frozenset(("header",))
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")


@dataclass
class _Element:
    tag: str
    number: int
    skipped: bool
    silent: bool
    named: bool


@dataclass
class _Line:
    text: str
    tags: int
    linked: int
    path: tuple[int, ...]
    named: tuple[int, ...]


@dataclass
class _Page:
    lines: list[_Line] = field(default_factory=list)
    articles: dict[int, tuple[int, ...]] = field(default_factory=dict)  # with the elements around it that names mark


class _Reader(HTMLParser):
    """Turns parser events into lines of text outside skipped elements, with the elements around them that names mark."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.page = _Page()
        self.open: list[_Element] = []
        self.count = 0
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0
        self.path: tuple[int, ...] = ()
        self.named: tuple[int, ...] = ()
        self.in_link = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.page.lines.append(_Line(text, self.tags, min(self.linked, len(text)), self.path, self.named))
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in _BLOCK:
            self._end_line()
        if tag == "br":
            self.parts.append(" ")
        if tag in _VOID:
            return
        if tag in _ENDS_PARAGRAPH:
            self._close("p", stop=("article", "section", "div", "td", "li", "blockquote", "main"))
        if tag in _SAME_KIND:
            self._close(tag, stop=_SAME_KIND[tag])
        outer = self.open[-1] if self.open else None
        inside = any(e.number in self.page.articles for e in self.open)
        self.count += 1
        silent = bool(outer and outer.silent) or tag in _SILENT
        skipped = bool(outer and outer.skipped) or silent or self._is_other(tag, dict(attrs), inside)
        named = not skipped and self._has_other_name(tag, dict(attrs), inside)
        if not skipped and (tag in ("article", "main") or ("role", "main") in attrs):
            self.page.articles[self.count] = tuple(e.number for e in self.open if e.named) + ((self.count,) if named else ())
        if tag == "a":
            self.in_link += 1
        self.open.append(_Element(tag, self.count, skipped, silent, named))

    handle_startendtag = handle_starttag

    @staticmethod
    def _is_other(tag: str, attrs: dict[str, str | None], inside: bool) -> bool:
        if tag in _OTHER or (tag == "header" and not inside):
            return True
        if tag in ("html", "body"):
            return False
        return (attrs.get("role") or "").lower() in _ROLES or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true"

    @staticmethod
    def _has_other_name(tag: str, attrs: dict[str, str | None], inside: bool) -> bool:
        if tag in ("html", "body"):
            return False
        if tag in ("article", "main"):
            names = (attrs.get("class") or "").lower().split()
            return any(n in _NAMES for n in names)
        named = f"{attrs.get('id') or ''} {attrs.get('class') or ''}".lower()
        tokens = set(_SPLIT.split(named))
        return not tokens.isdisjoint(_NAMES) or (not inside and not tokens.isdisjoint(_PAGE_HEADER))

    def _close(self, tag: str, stop: tuple[str, ...] = ()) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].tag == tag:
                self.in_link -= sum(e.tag == "a" for e in self.open[at:])
                del self.open[at:]
                return
            if self.open[at].tag in stop:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in _BLOCK:
            self._end_line()
        if tag == "br":
            self.parts.append(" ")
        elif tag not in _VOID:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].skipped:
            return
        if not self.parts:
            self.path = (0, *(e.number for e in self.open if e.tag in _HOLDERS))
            self.named = tuple(e.number for e in self.open if e.named)
        self.parts.append(data)
        if self.in_link:
            self.linked += len(data.strip())

    def finish(self) -> _Page:
        self._end_line()
        return self.page


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian average of each value and its neighbours; weights beyond the ends are left out."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The border between two clusters of values with the least squared distance to their means."""
    ordered = np.sort(values)
    if ordered[0] == ordered[-1]:
        return float(ordered[0])
    n = np.arange(1, len(ordered))
    left = np.cumsum(ordered)[:-1]
    right = ordered.sum() - left
    between = left**2 / n + right**2 / (len(ordered) - n)
    return float(ordered[int(np.argmax(between)) + 1])


def _content(lines: list[_Line]) -> np.ndarray:
    """Which lines the ratio clustering puts above the threshold."""
    ratios = np.array([min(_WIDTH, max(0, len(x.text) - x.linked) / max(1, x.tags)) for x in lines])
    values = smoothed(ratios)
    return values >= threshold(values)


def _without_named(page: _Page) -> tuple[list[_Line], set[int]]:
    """Lines and articles outside elements whose names mark them as something else.

    A name is no mark on an element that holds an article or main element without such a name of its own, or most
    of the text above the threshold.
    """
    votes: dict[int, int] = {}
    total = 0
    for line, chosen in zip(page.lines, _content(page.lines)):
        if chosen:
            total += len(line.text)
            for number in line.named:
                votes[number] = votes.get(number, 0) + len(line.text)
    held = {n for number, around in page.articles.items() if number not in around for n in around}
    held |= {n for n, v in votes.items() if v >= MAJORITY * total}
    lines = [x for x in page.lines if held.issuperset(x.named)]
    return lines, {n for n, around in page.articles.items() if held.issuperset(around)}


def main_text(html: str) -> str:
    """The blocks of the page's main element, joined by newlines; empty if there is no text."""
    reader = _Reader()
    reader.feed(_CUT_TAG.sub("", html))
    reader.close()
    page = reader.finish()
    if not page.lines:
        return ""
    lines, articles = _without_named(page)
    if not lines:
        return ""
    votes: dict[int, int] = {}
    total = 0
    for line, chosen in zip(lines, _content(lines)):
        if chosen:
            total += len(line.text)
            for number in line.path:
                votes[number] = votes.get(number, 0) + len(line.text)
    # numbers rise inwards, so the last element with most votes is the deepest; 0 is the page
    named = [n for n in articles if votes.get(n, 0) >= MAJORITY * total]
    shared = {n for n in articles if votes.get(n)}
    if named:
        kept = [x for x in lines if max(named) in x.path]
    elif shared:  # several articles hold the content
        kept = [x for x in lines if shared.intersection(x.path)]
    else:  # the smallest element that covers all content
        region = max(n for n, v in votes.items() if v == total)
        kept = [x for x in lines if region in x.path]
    return "\n".join(x.text for x in kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``).

    Null html is an empty page. Pages without text, or that are markup only, give an empty text. Broken markup is
    read as far as it goes; an unfinished tag at the end is no text. Rows may repeat; extra columns are ignored;
    an empty table gives no rows.
    """

    @F.pandas_udf("string")
    def of(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in html], dtype=object)

    found = pages.select("page_id", "url", of(whole_text("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
