"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element. Parts that are not the article by their
element, role or class (menus, adverts, forms, reader comments and so on) leave empty lines, and so do the edges of
an article. Over the lines slides a window; the text in it rises at a surge point and falls back at a
dive point. What lies between the two is kept if the fullest window there holds enough text, and enough beside the
fullest of the page. Text in an article element weighs more and stands or falls as a whole, whatever its gaps; blocks
that share their container with a kept one are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

WINDOW = 3  # lines
SURGE = 30  # characters in a window, for text outside of an article element
MARKED = 4  # what a character in an article element weighs
SHARE = 0.2  # of the page's fullest window that the fullest of a block must hold

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Never part of an article.
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea iframe object svg canvas dialog menu audio video map".split()
)
# Of those, what does not even end a line.
SILENT = frozenset("script style noscript template".split())
ARTICLE = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
# Words in class or id that name what is no article.
BOILERPLATE = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification
    alert popup modal overlay newsletter subscribe subscription signup login sidebar sidebars widget related recommended recommendations popular trending
    share sharing social breadcrumb breadcrumbs menu menus nav navbar navigation pagination pager toolbar masthead header footer copyright
    comment comments commentlist disqus reply replies respond discussion search skip""".split()
)
# Elements that hold text within a container.
FLOW = INLINE | SILENT | frozenset("p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd blockquote pre figure figcaption address center table thead tbody tfoot tr td th html body".split())
READERS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
PRESENCE = frozenset("has no with without not".split())  # "has-sidebar" says something about another element


def _names(value: str | None) -> set[str]:
    out: set[str] = set()
    for word in (value or "").split():
        tokens = {t.lower() for t in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", word)}
        if not tokens & PRESENCE:
            out |= tokens
    return out


class _Lines(HTMLParser):
    """Lines of a page: text, number of the outermost article it stands in, number of its container; 0 for none."""

    def __init__(self, by_name: bool = True) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int]] = []
        self.open: list[tuple[str, bool]] = []  # element, whether it is dropped
        self.containers: list[int] = [0]
        self.counts: Counter[str] = Counter()  # open elements by name, so that end tags without a start cost nothing
        self.by_name = by_name
        self.dropped = self.articles = self.article = self.made = 0
        self.text: list[str] = []

    def _end_line(self, gap: bool = False) -> None:
        line = " ".join("".join(self.text).split())
        self.text = []
        if line:
            self.lines.append((line, self.article if self.articles else 0, self.containers[-1]))
        if gap:
            self.lines += [("", 0, 0)] * WINDOW

    def _is_dropped(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in DROPPED or tag == "header" and not self.articles:
            return True
        if tag in ("html", "body", "main"):
            return False
        named = dict(attrs)
        if (named.get("role") or "").strip().lower() in ROLES and not tag == "article":
            return True
        if not self.by_name:
            return False
        names = _names(named.get("class")) | _names(named.get("id"))
        if tag == "article":
            return bool(names & READERS)
        return bool(names & (BOILERPLATE - {"header"} if self.articles else BOILERPLATE))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._end_line()
            return
        block = tag not in INLINE and tag not in SILENT
        if block and not self.dropped:
            self._end_line()
        # What a start tag ends by itself.
        if tag in ("li", "p", "tr", "td", "th", "dt", "dd", "option") or block and self.open and self.open[-1][0] == "p":
            last = "p" if tag not in ("li", "tr", "td", "th", "dt", "dd", "option") else tag
            if self.open and self.open[-1][0] == last:
                self._close(len(self.open) - 1)
        drop = self._is_dropped(tag, attrs)
        if (drop and tag not in SILENT or tag in ARTICLE) and not self.dropped:
            self._end_line(gap=True)
        self.open.append((tag, drop))
        self.counts[tag] += 1
        self.made += 1
        if tag not in FLOW:
            self.containers.append(self.made)
        if tag in ARTICLE and not self.articles:
            self.article = self.made
        self.dropped += drop
        self.articles += tag in ARTICLE

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            tag, drop = self.open.pop()
            self.counts[tag] -= 1
            if tag not in INLINE and not self.dropped:
                self._end_line(gap=tag in ARTICLE)
            if tag not in FLOW:
                self.containers.pop()
            self.dropped -= drop
            self.articles -= tag in ARTICLE

    def handle_endtag(self, tag: str) -> None:
        if not self.counts[tag]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self._close(depth)
                return
            if self.open[depth][0] in ("article", "main", "body", "td", "table") and tag in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.text.append(data)

    def close(self) -> None:
        super().close()
        self._close(0)
        self._end_line()


def page_lines(html: str, by_name: bool = True) -> list[tuple[str, int, int]]:
    """Lines of a page, with empty ones where something was dropped; without ``by_name`` no class or id drops anything."""
    parser = _Lines(by_name)
    parser.feed(html)
    parser.close()
    return parser.lines


def page_blocks(html: str) -> list[str]:
    """The blocks of a page's article.

    A class or id only says what an element is called. Where parts that are dropped for it hold the article, and no
    window of what is left is full enough, the lines are looked at again without regard to names.
    """
    kept = main_blocks(page_lines(html))
    return kept or main_blocks(page_lines(html, by_name=False))


def main_blocks(lines: list[tuple[str, int, int]]) -> list[str]:
    """The lines between surge and dive points that are kept."""
    filled = np.flatnonzero([len(t) for t, _, _ in lines])
    if not len(filled):
        return []
    article, container = (np.array([x[k] for x in lines]) for k in (1, 2))
    length = np.array([len(t) for t, _, _ in lines]) * np.where(article > 0, MARKED, 1)
    # Blocks: what stands in one article, or outside of any between two gaps.
    changes = (np.diff(filled) > WINDOW) | (np.diff(article[filled]) != 0)
    parts = np.split(filled, np.flatnonzero(changes) + 1)
    windows = []
    for part in parts:
        sums = np.concatenate([[0], np.cumsum(length[part])])
        windows.append(sums[np.minimum(np.arange(len(part)) + WINDOW, len(part))] - sums[:-1])
    fullest: dict[int, int] = {}
    for part, window in zip(parts, windows, strict=True):
        fullest[article[part[0]]] = max(fullest.get(article[part[0]], 0), int(window.max()))
    least = SHARE * max(fullest.values())
    kept: set[int] = set()
    for part, window in zip(parts, windows, strict=True):
        mark = article[part[0]]
        if mark and fullest[mark] >= least:
            kept.update(part.tolist())
        elif not mark and window.max() >= max(SURGE, least):
            risen = np.flatnonzero(window >= SURGE)
            kept.update(part[risen[0] : risen[-1] + WINDOW].tolist())
    mine = {container[i] for i in kept} - {0}
    return [lines[i][0] for i in filled if i in kept or container[i] in mine]


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``, ``html``): ``page_id``, ``url``, ``text``, ``n_chars``, ``blocks``.

    Blocks are joined by an empty line. Null and empty html give the empty text; so do pages on which nothing is
    an article. Repeated rows give repeated results; other columns are ignored; no rows give no rows.
    """

    def run(texts: list[str]) -> tuple[dict, None]:
        blocks = [page_blocks(html) for html in texts]
        text = ["\n\n".join(b) for b in blocks]
        kinds = {"text": pa.string(), "n_chars": pa.int64(), "blocks": pa.list_(pa.string())}
        return {k: pa.array(v, kinds[k]) for k, v in {"text": text, "n_chars": [len(t) for t in text], "blocks": blocks}.items()}, None

    return map_texts(pages, "html", [F.col("page_id").cast("bigint").alias("page_id"), F.col("url")], "text string, n_chars bigint, blocks array<string>", run)
