"""Main text of web pages by tree scoring.

Paragraphs pass points for length and commas to the elements around them, discounted by the share of
their text that is links. The best container, and siblings that score like it, are the article;
parts that are never article text (menus, scripts …) are left out of it. So are forms and elements named
like adverts, side bars or comments, unless they hold most of the page's text or its only article.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from daygrain.session import ship

# How elements behave, and the names that mark what is not article text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPHS = set("p pre blockquote li dd dt td th h1 h2 h3 h4 h5 h6 figcaption caption summary".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
NEVER = set("head script style textarea title xmp iframe noembed noframes noscript template nav footer aside button select option input dialog menu svg canvas object audio video".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert nav "
    "navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer header masthead topbar comment comments reply replies respond disqus discussion share sharing "
    "social related recommended recommendations newsletter subscribe subscription signup login popup modal overlay pagination pager widget toolbar skip search".split()
)
#: Names of parts that may well be longer than the article they stand below.
ANSWERS = set("comment comments reply replies respond disqus discussion".split())
#: Words that make a name one of the layout: has-sidebar, no-ads, share-enabled.
BEFORE, AFTER = set("has no not non with without hide show is".split()), set("enabled disabled free less".split())
#: Opening one of these ends an open element of the set named, unless one of the scopes is met first.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option"}, {"select"})}
ENDS |= {x: ({"td", "th"}, {"table", "tr"}) for x in ("td", "th")} | {"tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"})}
P_SCOPE = {"button", "table", "td", "th", "caption", "html", "body", "article", "section", "main", "div", "li"}

TAG = re.compile(r"<(?:!--(?P<comment>)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[!?/][^>]*+>|/?[a-zA-Z][^>]*+>)")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Page:
    """Elements in the order they open, and the text of each block with the element it is in."""

    def __init__(self, html: str):
        self.tags, self.parents, self.dropped, self.heading_only = ["html"], [-1], [False], [False]
        #: What an element is named for, where that may leave it out: "form", "named" or "answers".
        self.doubts: dict[int, str] = {}
        self.ends: list[int] = [0]
        self.blocks: list[list[tuple[int, str, bool]]] = []  # pieces: element, text, whether in a link
        self.articles = 0
        self.pieces: list[tuple[int, str, bool]] = []
        self.open = [0]
        #: Where in ``open`` the elements of each name are; whether an element lies in a heading; the block it lies in.
        self.where: dict[str, list[int]] = {self.tags[0]: [0]}
        self.in_heading, self.block_of = [False], [0]
        self.links = 0
        self._read(html)
        while self.open:
            self._close()
        self._flush()
        self._settle()

    def _flush(self) -> None:
        if self.pieces:
            self.blocks.append(self.pieces)
            self.pieces = []

    def _settle(self) -> None:
        """Leave out the doubtful elements, but those that hold most of the page's text or its only article, main or h1.

        Where an article or main with text stands free of doubt, an element beside it is left out at any length.
        """
        if not self.doubts:
            return
        n = len(self.tags)
        chars, heads, free, inside = [0] * n, [0] * n, [True] * n, [False] * n
        for pieces in self.blocks:
            for element, text, in_link in pieces:
                chars[element] += 0 if in_link else len(" ".join(text.split()))
        for k in range(1, n):
            free[k] = free[self.parents[k]] and k not in self.doubts
            inside[k] = inside[self.parents[k]] or self.tags[k] in ("article", "main")
            heads[k] = int(self.tags[k] in ("article", "main", "h1") and not self.dropped[k])
        free_head = any(h and f for h, f in zip(heads, free))
        for k in range(n - 1, 0, -1):
            chars[self.parents[k]] += chars[k]
            heads[self.parents[k]] += heads[k]
        free_article = any(free[k] and chars[k] and not self.dropped[k] and self.tags[k] in ("article", "main") for k in range(n))
        for k in range(1, n):
            doubt = self.doubts.get(k)
            most = doubt and (inside[k] or not free_article) and chars[k] * 100 > chars[0] * (90 if doubt == "answers" else 50)
            left_out = bool(doubt) and not most and (free_head or not heads[k])
            self.dropped[k] = self.dropped[k] or self.dropped[self.parents[k]] or left_out

    def _kept(self) -> Iterator[tuple[int, str, int]]:
        """(element, text, characters of it in links) of each block that is not left out."""
        for block in self.blocks:
            pieces = [x for x in block if not self.dropped[x[0]]]
            while pieces and pieces[0][1].isspace():
                pieces.pop(0)
            text = " ".join(unescape("".join(p for _, p, _ in pieces)).split())
            if text and (not self.heading_only[pieces[0][0]] or self.in_heading[pieces[0][0]]):
                yield pieces[0][0], text, min(len(text), sum(len(p) for _, p, in_link in pieces if in_link))

    def _text(self, text: str) -> None:
        here = self.open[-1]
        if text and not self.dropped[here] and (self.pieces or not text.isspace()):
            self.pieces.append((here, text, self.links > 0))

    def _close(self) -> None:
        at = self.open.pop()
        self.where[self.tags[at]].pop()
        self.ends[at] = len(self.tags)
        if self.tags[at] == "a":
            self.links -= 1
        self.articles -= self.tags[at] in ("article", "main")
        if self.tags[at] in BLOCKS:
            self._flush()

    def _close_to(self, names: set[str], scopes: set[str]) -> None:
        """Close the nearest open element of these names, with all inside it, unless a scope lies between.

        The places of the open elements are kept by their names, so that a tag without partner costs nothing.
        """
        nearest = 0
        for name in names:
            places = self.where.get(name)
            if places and places[-1] > nearest:
                nearest = places[-1]
        if not nearest:
            return
        if len(self.open) - nearest < 16:
            if scopes and any(self.tags[at] in scopes for at in self.open[nearest + 1 :]):
                return
        elif any(places[-1] > nearest for name in scopes if (places := self.where.get(name))):
            return
        while len(self.open) > nearest:
            self._close()

    def _open(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self._close_to({"p"}, P_SCOPE)
            self._flush()
        if tag in ENDS:
            self._close_to(*ENDS[tag])
        parent = self.open[-1]
        inside = self.heading_only[parent]
        if tag == "header" and not self.dropped[parent] and self.articles:
            inside = True
        elif tag == "header":
            rest += " hidden"
        away = self._named_away(tag, rest) if rest.strip(" /") else ""
        dropped = self.dropped[parent] or tag in NEVER or away == "hidden"
        if inside and tag in BLOCKS and tag not in HEADINGS and tag not in ("header", "div", "section"):
            dropped = True
        if away not in ("", "hidden") or tag == "form":
            self.doubts[len(self.tags)] = away or "form"
        self.tags.append(tag)
        self.parents.append(parent)
        self.dropped.append(dropped)
        self.heading_only.append(inside)
        self.ends.append(len(self.tags))
        self.in_heading.append(tag in HEADINGS or (inside and self.in_heading[parent]))
        self.block_of.append(len(self.tags) - 1 if tag in BLOCKS else self.block_of[parent])
        if tag not in VOID:
            self.where.setdefault(tag, []).append(len(self.open))
            self.open.append(len(self.tags) - 1)
            self.links += tag == "a"
            self.articles += tag in ("article", "main")

    @staticmethod
    def _named_away(tag: str, rest: str) -> str:
        """"hidden" for what is not shown or has the role of a menu or the like, "named" or "answers" for a doubtful name, or nothing."""
        if tag in ("html", "body", "main", "article", "p", "a", "b", "i", "em", "strong") and "hidden" not in rest and "none" not in rest:
            return ""
        doubt = ""
        for name, *values in ATTRIBUTE.findall(rest):
            name, value = name.lower(), "".join(values)
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                return "hidden"
            if name == "role" and value.lower() in ROLES:
                return "hidden"
            if name == "role" and value.lower() == "form":
                doubt = doubt or "form"
            if name in ("class", "id") and tag not in HEADINGS:
                for token in value.split():
                    parts = [x.lower() for x in NAME_PARTS.findall(token)]
                    if len(parts) > 1 and (parts[0] in BEFORE or parts[-1] in AFTER):
                        continue
                    if found := NAMES.intersection(parts):
                        doubt = "answers" if found & ANSWERS else doubt or "named"
        return doubt

    def _read(self, html: str) -> None:
        at, last = 0, html.rfind(">") + 1
        while at < last and (found := TAG.search(html, at, last)):
            self._text(html[at : found.start()])
            at = found.end()
            if found["comment"] is not None:
                end = html.find("-->", at)
                at = last = len(html) if end < 0 else last
                if end >= 0:
                    at = end + 3
                continue
            if not found["name"]:
                continue
            tag = found["name"].lower()
            if found["close"]:
                self._end(tag)
            elif tag in RAW:
                self._open(tag, found["rest"])
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                at = html.find(">", end.start()) + 1 if end else 0
                if at == 0:
                    at = len(html)
                self._end(tag)
            else:
                if tag == "br":
                    self._text(" ")
                self._open(tag, found["rest"])
        rest = html[at:]
        self._text(rest.partition("<!--")[0])

    def _end(self, tag: str) -> None:
        if tag in ("body", "html"):
            return
        if tag in BLOCKS:
            self._close_to({tag}, set())
        else:
            self._close_to({tag}, BLOCKS)

    def main_text(self) -> str:
        """The blocks of the best container and its like, in page order."""
        n = len(self.tags)
        points, chars, linked = [0.0] * n, [0] * n, [0] * n
        kept = list(self._kept())
        for element, text, in_links in kept:
            element = self.block_of[element]
            chars[element] += len(text)
            linked[element] += in_links
            worth = (1 + text.count(",") + min(3.0, len(text) / 100)) * (1 - in_links / len(text))
            holder = self.parents[element] if self.tags[element] in PARAGRAPHS and self.parents[element] >= 0 else element
            share = 1.0
            for _ in range(4):
                points[holder] += worth * share
                holder, share = self.parents[holder], share / 2
                if holder < 0:
                    break
        for k in range(n - 1, 0, -1):
            chars[self.parents[k]] += chars[k]
            linked[self.parents[k]] += linked[k]
        final = [p * (1 - linked[k] / chars[k]) if chars[k] else 0.0 for k, p in enumerate(points)]
        best = max(range(n), key=lambda k: (final[k], -k))
        if not final[best]:
            return "" if not kept else "\n".join(t for _, t, _ in kept)
        top = best
        while top > 0 and self.tags[top] not in ("article", "main"):
            top = self.parents[top]
        if top > 0:
            best = top
        ranges = [(best, self.ends[best])]
        parent = self.parents[best]
        if parent >= 0:
            enough = max(1.0, final[best] / 5)
            ranges += [
                (k, self.ends[k])
                for k in range(1, n)
                if self.parents[k] == parent
                and k != best
                and not self.dropped[k]
                and (final[k] >= enough or (self.tags[k] == "p" and chars[k] > 80 and linked[k] < chars[k] / 4) or (self.tags[k] in HEADINGS and k < best))
            ]
        # Ranges of siblings do not overlap.
        ranges.sort()
        starts = [a for a, _ in ranges]
        inside = lambda k: (at := bisect_right(starts, k)) and k < ranges[at - 1][1]
        return "\n".join(t for k, t, _ in kept if inside(k))


def main_text(html: str | None) -> str:
    """The article of a page: its blocks, white space in each made one space, joined by line ends."""
    return Page(html).main_text() if html else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html; more columns are ignored).

    Null and empty html, and pages without article text, give an empty text. A headline in a header outside
    the article goes with the header. A task holds some ten times its longest page, and its time is linear in
    the page, however deep or broken. Every row gives a row,
    repeated ones too; a tag that never ends is text, an element that never closes ends with the page.
    """
    ship(pages.sparkSession)
    return pages.selectExpr("cast(page_id AS bigint) AS page_id", "url", "html").mapInArrow(_extracted, "page_id bigint, url string, text string, n_chars bigint")
