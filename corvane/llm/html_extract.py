"""Main text of web pages by the distribution of line blocks.

A page is taken apart into lines, one for each block element. Markup, scripts and
styles are stripped, and so are the parts that their elements name as none of the
article: menus, sidebars, forms, page headers and footers, and containers that
are called nothing but boilerplate. What a remaining line has in text beyond its
links is its length; lines that are mostly links have none. The lengths are
summed over a sliding window. Text surges where the sum reaches ``SURGE``, or the
page's greatest sum where that is less, and dives where the sum falls to nothing.
What stands from the first surge to the last dive is kept whole, links included;
beyond that stays only text that shares a container with it.

Structure helps in two ways. Every ``article`` or ``main`` is a region with a
distribution of its own, so that no window reaches across its edge, and the
region with the strongest stretch is taken: teasers and comments that are
articles themselves fall away. Text outside all regions is one more region, which
wins only where it is ``OUTSIDE`` times as strong.

Edge cases: a null or empty page, and one without text, gives the empty text.
Elements that are never closed end with the element around them, and a head that
is never closed ends where the body's elements or text begin. Broken character
references stay as they are. Repeated rows get the same text. The time is linear
in a page's length, whatever its markup.
"""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import append_columns, col, fresh

#: Lines in a window.
WINDOW = 3
#: Characters in a window from which text surges.
SURGE = 80
#: Times as strong as the best article that text outside of all must be to be taken instead.
OUTSIDE = 4

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9:-]*")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
_RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
_RAW_END = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*>?", re.IGNORECASE) for x in _RAW}
#: Elements that stand inside a line.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mspace semantics annotation".split()
)
#: Elements whose content is never shown as text of an article.
_NEVER = frozenset("head nav aside button select option datalist menu object audio video map svg canvas noscript template".split())
#: These belong to the page unless they stand in an article.
_EDGE = frozenset("header footer dialog".split())
_FORM = frozenset("form fieldset".split())
_ROLES = frozenset("navigation complementary contentinfo banner search".split())
#: Elements other than these end a head that is still open.
_HEAD = frozenset("head html base basefont bgsound link meta noscript template".split()) | _RAW
#: An element that opens one of these ends an open one of the same kind.
_CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
#: Elements whose class or id may name them boilerplate.
_CONTAINERS = frozenset("div section ul ol dl table details figure center".split())
#: What containers are called that hold no text of the article.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar sidebars nav navbar navigation menu menus "
    "breadcrumb breadcrumbs pagination pager footer masthead topbar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "signup login comment comments respond responses reply replies thread threads discussion disqus share sharing social related recommended recommendations teaser "
    "teasers toolbar search searchbox skip".split()
)
#: Words that may stand beside them in a compound name, as in "comment-list".
_AROUND = frozenset(
    "a area bar block box btn button buttons container content global group icons inner item items left links list main outer page panel post posts right row section "
    "site slot strip top bottom unit user wide widget widgets wrap wrapper zone".split()
)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _marked(token: str, inside: bool) -> bool:
    """Whether a name says boilerplate and nothing else: all of its parts do, or could stand beside such a word."""
    parts = [x.lower() for x in _PARTS.findall(token) if not x.isdigit()]
    marks = _MARKS if inside else _MARKS | {"header"}
    return any(x in marks for x in parts) and all(x in marks or x in _AROUND for x in parts)


class Line(NamedTuple):
    text: str
    #: Characters in links.
    linked: int
    #: Number of the block element around the line's own.
    container: int
    #: Number of the article around it, or 0.
    region: int
    #: Whether the line is a headline.
    title: bool
    #: Whether it stands in a form, or in a container that is called boilerplate.
    doubtful: bool


class Page:
    """The lines of a page, and its elements as numbers with their parents; number 0 is the page itself."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.lines: list[Line] = []
        self.parent = [0]
        #: The page itself, html and body.
        self.roots = {0}
        #: For each region: the region around it, and whether it is a main element.
        self.regions: dict[int, tuple[int, bool]] = {}
        # name, number, hard, doubtful, doubt put aside by an article, region put aside, link
        self._stack: list[tuple[str, int, int, int, int, int, int]] = []
        self._blocks = [0]
        self._inline: list[dict[str, int]] = [{}]
        self._scope: list[dict[str, int]] = [{}]
        self._open: dict[str, int] = {}
        self._hard = self._doubt = self._link = self._region = 0
        self._heads = 0
        self._parts: list[str] = []
        self._linked = 0
        self._tag = ""
        self._read()
        self._flush()

    def _flush(self) -> None:
        if self._parts:
            if not self._hard and (text := " ".join(entities.unescape("".join(self._parts)).split())):
                around = self._blocks[-2] if len(self._blocks) > 1 else 0
                self.lines.append(Line(text, self._linked, around, self._region, self._tag in ("h1", "h2"), self._doubt > 0))
            self._parts.clear()
        self._linked = 0

    def _text(self, start: int, end: int) -> None:
        if end > start:
            piece = self.source[start:end]
            if self._heads and not piece.isspace():
                self._pop_to("head")
            if not self._hard:
                self._parts.append(piece)
                if self._link:
                    self._linked += end - start

    def _pop(self) -> str:
        name, _, hard, doubtful, aside, region, link = self._stack.pop()
        self._hard -= hard
        self._doubt -= doubtful
        if aside >= 0:
            self._doubt, self._region = aside, region
        self._link -= link
        self._open[name] -= 1
        self._heads -= name == "head"
        if name in _INLINE:
            self._inline[-1][name] -= 1
        else:
            self._blocks.pop()
            self._inline.pop()
            if name in _CLOSES_ITSELF:
                self._scope[-1][name] -= 1
            else:
                self._scope.pop()
        return name

    def _pop_to(self, name: str) -> None:
        self._flush()
        while self._pop() != name:
            pass

    def _push(self, name: str, attributes: str) -> None:
        good = name in ("article", "main")
        hard = doubtful = False
        if name in _NEVER or (name in _EDGE and not self._region):
            hard = True
        elif name in _FORM:
            doubtful = True
        if attributes:
            for key, value in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), value.strip("\"'")
                if key == "hidden":
                    hard = True
                elif key == "role":
                    good |= value.lower() == "main"
                    hard |= value.lower() in _ROLES and name not in ("html", "body") and not (name in _EDGE and self._region)
                elif key in ("class", "id") and name in _CONTAINERS and not doubtful:
                    doubtful = any(_marked(x, self._region > 0) for x in value.split())
        number = len(self.parent)
        aside, before = -1, 0
        if name not in _INLINE:
            self.parent.append(self._blocks[-1])
            self._blocks.append(number)
            if name in ("html", "body"):
                self.roots.add(number)
            self._inline.append({})
            if name not in _CLOSES_ITSELF:
                self._scope.append({})
            else:
                self._scope[-1][name] = self._scope[-1].get(name, 0) + 1
            self._tag = name
        else:
            self._inline[-1][name] = self._inline[-1].get(name, 0) + 1
        if good and not hard and not self._hard and name not in _INLINE:
            # An article is in no doubt for what wraps it.
            self.regions[number] = (self._region, name != "article")
            aside, before, self._doubt, self._region, doubtful = self._doubt, self._region, 0, number, False
        link = name == "a"
        self._stack.append((name, number, hard, doubtful, aside, before, link))
        self._hard += hard
        self._doubt += doubtful
        self._link += link
        self._heads += name == "head"
        self._open[name] = self._open.get(name, 0) + 1

    def _start(self, name: str, attributes: str) -> None:
        if name not in _INLINE:
            self._flush()
        elif name == "br":
            self._parts.append(" ")
        if self._heads and name not in _HEAD:
            self._pop_to("head")
        if name in _VOID or attributes.rstrip().endswith("/"):
            return
        if name in _CLOSES_ITSELF and self._scope[-1].get(name):
            self._pop_to(name)
        self._push(name, attributes)

    def _end(self, name: str) -> None:
        if name in _INLINE:
            # The end of an inline element doesn't reach beyond the block it stands in.
            if self._inline[-1].get(name):
                while self._pop() != name:
                    pass
        else:
            self._flush()
            if self._open.get(name):
                self._pop_to(name)

    def _attributes(self, at: int) -> int:
        """Where the tag whose attributes begin at ``at`` ends, '>' excluded; quotes may hide a '>'."""
        source, n = self.source, len(self.source)
        while at < n:
            at = _PLAIN.match(source, at).end()
            if at >= n or source[at] == ">":
                break
            close = source.find(source[at], at + 1) if at < self._last[source[at]] else -1
            at = close + 1 if close >= 0 else at + 1
        return min(at, n)

    def _read(self) -> None:
        source, n = self.source, len(self.source)
        self._last = {x: source.rfind(x) for x in "\"'"}
        comments = source.rfind("-->")
        at = last = 0
        while (at := source.find("<", at)) >= 0:
            after = source[at + 1 : at + 2]
            if after == "!" or after == "?":
                self._text(last, at)
                if source.startswith("<!--", at):
                    end = source.find("-->", at + 4) + 3 if comments >= at + 4 else n
                else:
                    end = source.find(">", at) + 1 or n
                at = last = end
                continue
            closing = after == "/"
            m = _NAME.match(source, at + 1 + closing)
            if m is None:
                at += 1
                continue
            self._text(last, at)
            name = m[0].lower()
            end = self._attributes(m.end())
            attributes = source[m.end() : end]
            at = last = min(end + 1, n)
            if closing:
                self._end(name)
            elif name in _RAW:
                if name not in _INLINE and name != "script":
                    self._flush()
                if not attributes.endswith("/") or name in ("script", "style", "textarea", "title"):
                    stop = _RAW_END[name].search(source, at)
                    at = last = stop.end() if stop else n
            else:
                self._start(name, attributes)
        self._text(last, n)


def stretches(weights: np.ndarray, window: int, surge: float) -> list[tuple[int, int, float]]:
    """[start, end) and weight of the stretches between a surge and a dive of the windows' sums.

    Windows are centred on their line. A stretch grows from windows of ``surge``
    or more to where the sum falls to nothing, and has no empty line at its ends.
    """
    if not weights.any():
        return []
    total = np.convolve(weights, np.ones(window), mode="full")[(window - 1) // 2 :][: len(weights)]
    full = np.r_[False, total > 0, False]
    edges = np.flatnonzero(full[1:] != full[:-1])
    out = []
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if total[start:end].max() >= surge:
            solid = np.flatnonzero(weights[start:end]) + start
            out.append((int(solid[0]), int(solid[-1]) + 1, float(weights[start:end].sum())))
    return out


def _chosen(page: Page, lines: list[Line]) -> list[str]:
    """The texts between surge and dive, from the strongest region of ``lines``."""
    by: dict[int, list[int]] = {}
    for i, line in enumerate(lines):
        by.setdefault(line.region, []).append(i)
    found: dict[int, tuple[np.ndarray, list[tuple[int, int, float]], float]] = {}
    for region, at in by.items():
        weights = np.array([len(lines[i].text) if 2 * lines[i].linked < len(lines[i].text) else 0 for i in at], dtype=np.float64)
        if not weights.any():
            continue
        top = np.convolve(weights, np.ones(WINDOW)).max()
        own = stretches(weights, WINDOW, min(SURGE, top))
        found[region] = weights, own, max(x[2] for x in own)
    if not found:
        return []
    named = [r for r in found if r]
    best = max(named, key=lambda r: found[r][2], default=0)
    if best and 0 in found and found[0][2] >= OUTSIDE * max(found[best][2], SURGE):
        best = 0
    weights, strong, _ = found[best]
    at = by[best]
    start, end = strong[0][0], strong[-1][1]
    home = {lines[at[i]].container for s, e, _ in strong for i in range(s, e) if weights[i]}
    if not best and home - page.roots:  # at its ends, what stands in no container is the page's own
        while lines[at[start]].container in page.roots:
            start += 1
        while lines[at[end - 1]].container in page.roots:
            end -= 1
        home -= page.roots
    within = [False] * len(page.parent)
    for number, parent in enumerate(page.parent):
        within[number] = number in home or (number > 0 and within[parent])
    kept = [at[i] for i in range(len(at)) if start <= i < end or (weights[i] and within[lines[at[i]].container])]
    around, main = page.regions.get(best, (0, False))
    if around and not main and page.regions[around][1]:  # the headline may stand in main, before the article
        kept = [i for i in by.get(around, []) if lines[i].title and i < kept[0]][-1:] + kept
    return [lines[i].text for i in kept]


def extract(page: str | None) -> str:
    """The main text of a page: its blocks joined by an empty line."""
    if not page:
        return ""
    read = Page(page)
    sure = [x for x in read.lines if not x.doubtful]
    if not sure and sum(len(x.text) for x in read.lines) >= SURGE:
        # All of the page stands in a form or in a container with a misleading name.
        sure = read.lines
    return "\n\n".join(_chosen(read, sure))


def extract_pages(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, str]:
    """``pages`` with their main text, and that column's name."""
    (name,) = fresh(pages, "text")

    def make():
        return lambda batch: [pa.array([extract(x.decode()) if x else "" for x in batch], pa.string())]

    return append_columns(pages, html_col, [T.StructField(name, T.StringType())], make), name


def report(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    out, text = extract_pages(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", col(text).alias("text"), F.length(col(text)).cast("long").alias("n_chars"))
