"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with its path of block elements from the root. Per
path, text length outside links and punctuation are summed and divided by the number
of blocks. The two ratios are fused, smoothed along the page, and paths above a
threshold are content. What stands beside content in the same container, such as a
heading, belongs to it. Menus, forms and the like are out by their elements; names in
class, id or role lower the ratio of what they stand for, so that a page whose article is
misnamed still has its text.

Reading a page takes time in proportion to its length, however it is malformed: tags are
scanned once, and open elements are found by their names.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmatch.llm.ship import ship

#: Content paths have this share of the highest smoothed ratio.
THRESHOLD = 0.25
#: A container of content has this share of all content text.
CONTAINER_SHARE = 0.2
#: A block outside article and main that is links to this share is a menu.
LINK_SHARE = 0.6
#: A name that is not that of content lowers a ratio to this share.
NAMED_SHARE = 0.1

# Elements by what they do.
_RAW = "script|style|noscript|template|textarea|title|iframe|svg|canvas|object|select|math"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "html head body address article aside blockquote button caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_BOILERPLATE = frozenset("head nav footer aside form button dialog menu fieldset".split())
_MAIN = frozenset(("article", "main"))
_CLOSES = {  # an element whose start ends open ones, and where the search for them stops
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
# Words in class, id and role of elements that are not content.
_NAMES = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|popup|"
    r"modal|overlay|side-?bar|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|toolbar|footer|header|masthead|"
    r"comments?|commentlist|disqus|repl(?:y|ies)|respond|share|sharing|social|related|recommended|newsletter|"
    r"subscri\w*|sign-?up|log-?in|search|widgets?|skip|contentinfo|complementary|form)",
    re.I,
)
#: Names of what also stands on top of an article, with its title.
_TOPS = frozenset(("header", "masthead", "banner"))
# Parts that turn a name behind them into a trait, those that make a top
# the article's own, and those behind a name that leave it what it is.
_TRAITS = frozenset("with without no not has have is".split())
_OWNED = frozenset("entry article post story page content section".split())
_TAIL = re.compile(
    r"(?:\d+(?:x\d+)?|left|right|top|bottom|primary|secondary|container|wrapper|wrap|inner|outer|box|area|section|block|"
    r"lists?|items?|links?|bar|buttons?|icons?|posts?|articles|stories|slot|unit|content|widgets?|menu|form|title|"
    r"text|message|thread|nav)",
    re.I,
)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_RAW_TAG = re.compile(rf"(?:{_RAW})(?![^\s/>])", re.I)
_QUOTE = re.compile(r"=\s*+([\"'])|>")
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_MARKS = re.compile(r"[.,;:!?…。、，！？؟]")


def _named_out(token: str, inside: bool) -> bool:
    """True if a class, id or role names something that is not content. A name counts
    whole, as the last part, or with parts behind it that leave it what it is: not the
    header of an entry, nor a layout with a sidebar."""
    parts = [p for p in re.split(r"[_-]+", token.lower()) if p]
    for first in range(len(parts)):
        if parts[first] in _TRAITS:
            return False
        for last in range(first + 1, min(first + 2, len(parts)) + 1):
            name = "-".join(parts[first:last])
            if not _NAMES.fullmatch(name) or not all(map(_TAIL.fullmatch, parts[last:])):
                continue
            if name not in _TOPS or not (inside or _OWNED & set(parts[:first])):
                return True
    return False


class Block(NamedTuple):
    """A block's place among the paths of its page, its text, how much of that is links,
    and whether it is boilerplate by its elements or by a name."""

    path: int
    text: str
    link: int
    out: bool
    named: bool


class Page(NamedTuple):
    """Blocks in order, and the paths: the parent, the name and whether it is in article or
    main of each. A path comes after its parent; path 0 is the root."""

    blocks: list[Block]
    parents: list[int]
    names: list[str]
    in_main: list[bool]


class _Tag(NamedTuple):
    start: int
    end: int
    name: str
    close: bool
    rest: str


def _tag_end(page: str, at: int) -> int:
    """Place behind the tag whose attributes start at a place: its > outside quotes. A quote
    that is not closed where a value can end is a plain character."""
    while True:
        m = _QUOTE.search(page, at)
        if m is None:
            return len(page)
        if m[0] == ">":
            return m.end()
        closing = page.find(m[1], m.end())
        if closing >= 0 and (closing + 1 == len(page) or page[closing + 1] in " \t\n\f\r/>"):
            at = closing + 1
        else:
            at = m.end()


def _tags(page: str) -> Iterator[_Tag]:
    """Tags in order. Comments, declarations and raw elements come with an empty name; what
    the page's end cuts off is part of the last one."""
    at = 0
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            closing = page.find("-->", start + 4)
            at = len(page) if closing < 0 else closing + 3
            yield _Tag(start, at, "", False, "")
            continue
        close = page.startswith("/", start + 1)
        name = _NAME.match(page, start + 1 + close)
        if name is None:
            at = start + 1
            if page[at : at + 1] in ("!", "?", "/"):
                closing = page.find(">", at)
                at = len(page) if closing < 0 else closing + 1
                yield _Tag(start, at, "", False, "")
            continue
        end = at = _tag_end(page, name.end())
        rest = page[name.end() : end]
        if not close and _RAW_TAG.fullmatch(name[0]) and not rest.endswith("/>"):
            closing = re.compile(rf"</{name[0]}(?![^\s/>])", re.I).search(page, end)
            at = len(page) if closing is None else _tag_end(page, closing.end())
            yield _Tag(start, at, "", False, "raw")
        else:
            yield _Tag(start, end, name[0].lower(), close, rest)


class _Open(NamedTuple):
    """An open element; marked is its place if it is boilerplate itself, or -1."""

    name: str
    path: int
    out: bool
    named: bool
    marked: int
    mains: int
    articles: int


class _Reader:
    """Open elements and what was read so far."""

    def __init__(self, page: str, spared: frozenset[int]) -> None:
        self.page, self.spared = page, spared
        self.stack: list[_Open] = []
        self.places: dict[str, list[int]] = {}  # where in the stack elements of a name are
        self.blocks_open: list[int] = []  # the same of block elements other than p
        self.borders: list[int] = []  # the same of elements that end inline ones
        self.paths: dict[tuple[int, str], int] = {}
        self.parents, self.names, self.in_main = [-1], [""], [False]
        self.found: list[Block] = []
        self.parts: list[str] = []
        self.link = 0
        self.mains = self.articles = 0
        #: Boilerplate elements that hold main, and those that hold articles, with the
        #: numbers of these.
        self.hold_main: set[int] = set()
        self.hold_articles: list[tuple[int, int, int]] = []

    def read(self) -> None:
        last = 0
        for tag in _tags(self.page):
            if tag.start > last:
                self.add(self.page[last : tag.start])
            last = tag.end
            if not tag.name:
                if tag.rest:
                    self.parts.append(" ")
                continue
            if tag.name in _BLOCK:
                self.flush()
            elif tag.name == "br":
                self.parts.append(" ")
            if tag.close:
                self.close(tag.name)
            elif tag.name not in _VOID:
                self.open(tag)
        self.add(self.page[last:])
        self.flush()
        self.pop_to(0)

    def add(self, text: str) -> None:
        self.parts.append(text)
        if self.places.get("a"):
            self.link += len(text.strip())

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            top = self.stack[-1] if self.stack else _Open("", 0, False, False, -1, 0, 0)
            self.found.append(Block(top.path, text, self.link, top.out, top.named))
        self.parts.clear()
        self.link = 0

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            element = self.stack.pop()
            at = len(self.stack)
            for places in (self.places[element.name], self.blocks_open, self.borders):
                if places and places[-1] == at:
                    places.pop()
            if element.marked >= 0:
                if self.mains > element.mains:
                    self.hold_main.add(element.marked)
                elif self.articles > element.articles:
                    self.hold_articles.append((element.articles, self.articles, element.marked))

    def last(self, names: tuple[str, ...]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def close(self, name: str) -> None:
        """End the last open element of the name; inline ones only back to a border."""
        depth = self.last((name,))
        border = self.borders[-1] if self.borders else -1
        if depth >= 0 and (name in _BLOCK or depth > border):
            self.pop_to(depth)

    def open(self, tag: _Tag) -> None:
        name = tag.name
        if name in _BLOCK:
            ends, stops = _CLOSES.get(name, ((), ()))
            stop = self.last(stops) if ends else (self.blocks_open[-1] if self.blocks_open else -1)
            for wanted in (self.last(ends), self.last(("p",))):
                if wanted > stop:
                    self.pop_to(wanted)
        top = self.stack[-1] if self.stack else _Open("", 0, False, False, -1, 0, 0)
        inside = self.in_main[top.path]
        out = name in _BOILERPLATE or (name == "header" and not inside)
        named = False
        if not out and name not in ("html", "body", *_MAIN) and "=" in tag.rest:
            values = (g for a in _ATTRIBUTE.finditer(tag.rest) for g in a.groups() if g)
            named = any(_named_out(token, inside) for token in " ".join(values).split())
        marked = tag.start if (out or named) and tag.start not in self.spared else -1
        path = self.path(top.path, name) if name in _BLOCK else top.path
        at = len(self.stack)
        out = top.out or (out and marked >= 0)
        named = top.named or (named and marked >= 0)
        self.stack.append(_Open(name, path, out, named, marked, self.mains, self.articles))
        self.places.setdefault(name, []).append(at)
        if name in _BLOCK and name != "p":
            self.blocks_open.append(at)
        if name in ("article", "body", "table"):
            self.borders.append(at)
        self.mains += name == "main"
        self.articles += name == "article"

    def path(self, parent: int, name: str) -> int:
        number = self.paths.setdefault((parent, name), len(self.names))
        if number == len(self.names):
            self.parents.append(parent)
            self.names.append(name)
            self.in_main.append(self.in_main[parent] or name in _MAIN)
        return number

    def holders(self) -> frozenset[int]:
        """Boilerplate elements that hold main, or all articles of the page."""
        covered, upto = 0, 0
        for start, end, _ in sorted(self.hold_articles):
            covered += max(0, end - max(start, upto))
            upto = max(upto, end)
        around = {place for *_, place in self.hold_articles} if covered == self.articles else set()
        return frozenset(self.hold_main | around)


def parsed(page: str) -> Page:
    """The blocks of a page and their paths. An element that holds main, or all articles of
    the page, is not boilerplate."""
    reader = _Reader(page, frozenset())
    reader.read()
    if spared := reader.holders():
        reader = _Reader(page, spared)
        reader.read()
    return Page(reader.found, reader.parents, reader.names, reader.in_main)


def blocks(page: str) -> list[Block]:
    """The blocks of a page in their order. A tag that the page's end cuts off is dropped."""
    return parsed(page).blocks


#: Blocks of one path are apart if a name stands against some of them.
_Key = tuple[int, bool]


def _ratios(usable: list[Block], page: Page) -> dict[_Key, float]:
    """Each path's fused ratio: text per block, raised by punctuation per block."""
    sums: dict[_Key, list[int]] = {}
    for b in usable:
        s = sums.setdefault((b.path, b.named), [0, 0, 0])
        s[0] += 1
        s[1] += max(0, len(b.text) - b.link)
        s[2] += len(_MARKS.findall(b.text))
    return {
        (path, named): text / n * math.log(math.e + marks / n) * (2 if page.in_main[path] else 1)
        for (path, named), (n, text, marks) in sums.items()
    }


def _container_of(page: Page) -> list[int]:
    """For each path the one whose other blocks go with it: the outermost article or main,
    else a div, section or body as it is and the parent of anything else."""
    found: list[int] = []
    for path, (parent, name) in enumerate(zip(page.parents, page.names)):
        if parent >= 0 and page.in_main[parent]:
            found.append(found[parent])
        elif page.in_main[path] or name in ("div", "section", "body") or parent < 0:
            found.append(path)
        else:
            found.append(parent)
    return found


def main_text(html_text: str | None) -> str:
    """The article's blocks, joined by two line feeds."""
    page = parsed(html_text or "")
    usable = [b for b in page.blocks if not b.out and (page.in_main[b.path] or b.link <= LINK_SHARE * len(b.text))]
    if not usable:
        return ""
    ratio = _ratios(usable, page)
    raw = [ratio[b.path, b.named] for b in usable]
    smooth = [
        (raw[max(i - 1, 0)] + 2 * raw[i] + raw[min(i + 1, len(raw) - 1)]) / 4 for i in range(len(raw))
    ]
    of_path: dict[_Key, list[float]] = {}
    for b, value in zip(usable, smooth):
        of_path.setdefault((b.path, b.named), []).append(value)
    # What a name stands against gets nothing from its neighbours.
    level = {
        (path, named): ratio[path, named] * NAMED_SHARE if named else sum(values) / len(values)
        for (path, named), values in of_path.items()
    }
    most = max(level.values())
    content = {key for key, value in level.items() if value >= THRESHOLD * most}

    container = _container_of(page)
    text_in: dict[int, int] = {}
    for b in usable:
        if (b.path, b.named) in content:
            text_in[container[b.path]] = text_in.get(container[b.path], 0) + len(b.text)
    total = sum(text_in.values())
    # Where text is spread over many containers and none has its share, all count.
    chosen = [c for c, size in text_in.items() if size >= CONTAINER_SHARE * total] or list(text_in)
    if any(page.in_main[c] for c in chosen):
        chosen = [c for c in chosen if page.in_main[c]]
    covered = [False] * len(page.parents)
    for c in chosen:
        covered[c] = True
    for path, parent in enumerate(page.parents):
        covered[path] = covered[path] or (parent >= 0 and covered[parent])
    return "\n\n".join(
        b.text for b in usable if covered[b.path] and (not b.named or (b.path, True) in content)
    )


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (html, ...) with ``text``, the main text, and ``n_chars``, its code points.

    Whole pages are read, one by one. A null or empty page, or one without an article,
    has an empty text. Same-named columns are replaced.
    """
    ship(pages.sparkSession)

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    rest = [c for c in pages.columns if c not in ("text", "n_chars")]
    got = pages.select(*rest, F.pandas_udf(texts, "string")("html").alias("text"))
    return got.withColumn("n_chars", F.length("text").cast("long"))
