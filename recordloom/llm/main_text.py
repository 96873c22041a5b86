"""Main text of HTML pages by composite text density.

A page is parsed into a tree of blocks; tags within a line count as tags of their block. What is no
article by its element, role or class (menus, footers, forms, comments, ...) is cut off first. Every
node left has a density: its characters per tag, raised where few of them are in links. The density sum of a node
adds the densities of its children. The node with the largest sum is the main text. The least density on
the path from it up to the body is the threshold at which other blocks belong to the text as well.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by what they do.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
UNREAD = frozenset(
    "script style noscript template iframe object embed applet canvas svg math audio video select datalist textarea button input "
    "title head frameset noframes map".split())
APART = frozenset("nav footer aside dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An open element of the first kind ends where one of the second begins, unless one of the third lies between.
ENDED_BY = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "thead": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th"}), frozenset({"table"})),
}
PARAGRAPH_STAYS = frozenset("td th table caption object button".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
# Words of classes and ids that name what surrounds an article.
SURROUNDING = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus menubar breadcrumb breadcrumbs pagination pager sitemap sidebar sidebars rail aside related recommended "
    "recommendations footer foot masthead topbar toolbar cookie cookies consent gdpr notice notices banner banners popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social copyright disclaimer skip".split())
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply".split())
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_MOSTLY = 0.8  # share of link characters from which a block with several links is a list of links


class Block:
    """A node of the tree: its text and child blocks in page order, and what is counted for it."""

    __slots__ = ("tag", "above", "parts", "chars", "tags", "link_chars", "links", "cut", "marks", "holds", "density", "sum", "best")

    def __init__(self, tag: str, above: Block | None, marks: frozenset[str]) -> None:
        self.tag, self.above, self.marks = tag, above, marks
        self.parts: list[str | Block] = []
        self.chars = self.tags = self.link_chars = self.links = 0  # first of its own lines, then of all below
        self.cut = False
        self.holds: set[str] = set()  # which of main, article and headings are below


@dataclass(frozen=True)
class _Line:
    """Text of a block up to a child or its end: whether it was chosen, is mostly links, a heading, in the article's element."""

    text: str = ""
    chosen: bool = False
    links: bool = False
    heading: bool = False
    region: bool = False


def _marks(tag: str, attrs: list[tuple[str, str | None]]) -> frozenset[str]:
    """What an element's attributes say about it."""
    found = set()
    for name, value in attrs:
        value = value or ""
        if name in ("class", "id"):
            tokens = {t.lower() for t in _TOKEN.findall(value)}
            if tokens & COMMENTS:
                found.add("comments")
            if tokens & SURROUNDING:
                found.add("surrounding")
            if "header" in tokens:
                found.add("header")
        elif name == "role" and value.strip().lower() in ROLES:
            found.add("surrounding")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            found.add("hidden")
    return frozenset(found)


class _Reader(HTMLParser):
    """Builds the blocks of a page, whatever tags are missing."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks = [Block("body", None, frozenset())]
        self.stack: list[tuple[str, Block | None, bool]] = []  # open elements, their blocks, whether they hide what is in them
        self.open: Counter = Counter()
        self.here = self.blocks[0]
        self.unread = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        line = tag in INLINE
        if tag == "body" or (self.unread == 1 and not line and tag not in UNREAD):
            self._end("head")
        if tag in ("html", "body"):
            return
        if not self.unread:
            if not line and tag not in UNREAD:
                self._end_within(frozenset({"p"}), PARAGRAPH_STAYS)
            if tag in ENDED_BY:
                self._end_within(*ENDED_BY[tag])
        if tag in VOID:
            if not self.unread:
                self.here.tags += 1
                self.here.parts.append("\n" if tag in ("br", "hr") else "")
            return
        marks = _marks(tag, attrs)
        dropped = tag in UNREAD or "hidden" in marks or (line and bool(marks & {"comments", "surrounding"}))
        block = None
        if dropped:
            self.unread += 1
        elif self.unread:
            pass
        elif line:
            self.here.tags += 1
            self.here.links += tag == "a"
        else:
            block = Block(tag, self.here, marks)
            self.here.parts.append(block)
            self.blocks.append(block)
            self.here = block
        self.stack.append((tag, block, dropped))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.here.parts.append("\n")
        elif tag in INLINE:
            if not self.open[tag]:
                return
            for name, block, _ in reversed(self.stack):
                if name == tag:
                    self._end(tag)
                    break
                if block is not None:
                    break  # it does not reach out of its block
        else:
            self._end(tag)

    def handle_data(self, data: str) -> None:
        if self.unread:
            return
        size = len("".join(data.split()))
        self.here.parts.append(data)
        self.here.chars += size
        if self.open["a"]:
            self.here.link_chars += size

    def parse_html_declaration(self, i: int) -> int:
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def parse_comment(self, i: int, report: bool = True) -> int:
        end = super().parse_comment(i, report)
        return end if end >= 0 else len(self.rawdata)  # the page is fed whole: an open comment takes the rest

    def _pop(self) -> str:
        name, block, dropped = self.stack.pop()
        self.open[name] -= 1
        self.unread -= dropped
        if block is not None:
            self.here = block.above
        return name

    def _end(self, tag: str) -> None:
        if self.open[tag]:
            while self._pop() != tag:
                pass

    def _end_within(self, tags: frozenset[str], within: frozenset[str]) -> None:
        """Ends all open elements from the outermost of ``tags`` on, not beyond one of ``within``."""
        if not any(self.open[t] for t in tags):
            return
        depth = None
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] in within:
                break
            if self.stack[at][0] in tags:
                depth = at
                if len(tags) == 1:
                    break
        while depth is not None and len(self.stack) > depth:
            self._pop()


def _cut(blocks: list[Block]) -> None:
    """Marks what is no part of an article. Blocks stand in page order, so parents come first."""
    within = {id(None): False}  # whether an article or main element is at or above a block
    own = {}
    for block in blocks:
        inside = within.get(id(block.above), False) or block.tag in ("article", "main")
        within[id(block)] = inside
        if block.tag in HEADINGS | {"main"} or (block.tag == "article" and "comments" not in block.marks):
            own[id(block)] = block.tag
    paragraphs = [b.chars if b.tag == "p" else 0 for b in blocks]
    place = {id(b): i for i, b in enumerate(blocks)}
    for block in reversed(blocks):
        if id(block) in own:
            block.holds.add(own[id(block)])
        if block.above is not None:
            block.above.holds |= block.holds
            paragraphs[place[id(block.above)]] += paragraphs[place[id(block)]]
    for block in blocks:
        kind = block.tag
        if block.above is None or kind == "main":
            continue
        article_below = bool((block.holds - ({kind} if kind == "article" else set())) & {"main", "article"})
        if block.above.cut:
            block.cut = True
        elif kind in APART:
            block.cut = True
        elif kind == "header" or "header" in block.marks:
            block.cut = not within[id(block.above)] and not article_below
        elif kind == "form":
            block.cut = not article_below and 2 * paragraphs[place[id(block)]] <= paragraphs[0]
        elif "comments" in block.marks:
            block.cut = not block.holds & {"main", "h1"}
        elif "surrounding" in block.marks:
            # An article is only cut for its class where it stands in another.
            block.cut = not article_below and (kind != "article" or within[id(block.above)])


def _density(chars: int, tags: int, link_chars: int, links: int, body_share: float) -> float:
    """Characters per tag, raised by how little of them is in links, compared with the whole body."""
    if not chars:
        return 0.0
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + body_share * chars + 1 + math.e)
    ratio = chars / max(link_chars, 1) * tags / max(links, 1)
    return chars / tags * max(math.log(ratio), 0.0) / math.log(base) if ratio > 1 else 0.0


def _measure(blocks: list[Block]) -> None:
    """Densities, their sums, and the largest sum at or below each block."""
    lines = {}
    for block in reversed(blocks):
        if block.cut:
            continue
        lines[id(block)] = (block.chars, 1 + block.tags, block.link_chars, block.links)
        block.tags += 1
        for part in block.parts:
            if isinstance(part, Block) and not part.cut:
                block.chars += part.chars
                block.tags += part.tags
                block.link_chars += part.link_chars
                block.links += part.links
    body = blocks[0]
    share = body.link_chars / body.chars if body.chars else 0.0
    for block in reversed(blocks):
        if block.cut:
            continue
        block.density = _density(block.chars, block.tags, block.link_chars, block.links, share)
        block.sum = _density(*lines[id(block)], share)
        block.best = block
        below = [p for p in block.parts if isinstance(p, Block) and not p.cut]
        block.sum += sum(p.density for p in below)
        for part in below:
            if part.best.sum > block.best.sum:
                block.best = part.best


def _chosen(blocks: list[Block]) -> tuple[set[int], Block | None]:
    """The blocks whose whole subtree is main text, and the article or main element they lie in, if any."""
    main = blocks[0].best
    threshold, region, above = main.density, None, main.above
    if main.tag in ("article", "main"):
        region = main
    while above is not None:
        threshold = min(threshold, above.density)
        if region is None and above.tag in ("article", "main"):
            region = above
        above = above.above
    # Other blocks count where they lie in the same article, if there is one.
    todo, chosen = [region or blocks[0]], {id(main)}
    while todo:
        block = todo.pop()
        if block is main:
            continue
        if block.density >= threshold and block.density > 0:
            chosen.add(id(block.best))
        todo += [p for p in block.parts if isinstance(p, Block) and not p.cut]
    return chosen, region


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order joined by one space, white space within them as one space.

    Null and empty pages, and such without text, give an empty text. Pages of any length and depth are read whole.
    """
    if not html:
        return ""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    blocks = reader.blocks
    _cut(blocks)
    _measure(blocks)
    if not blocks[0].chars:
        return ""
    chosen, region = _chosen(blocks)
    threshold = blocks[0].density
    lines: list[_Line] = []
    todo: list[tuple[Block, int, _Line]] = [(blocks[0], 0, _Line())]
    held: list[str] = []

    def close(like: _Line) -> None:
        words = "".join(held).split()
        held.clear()
        if words:
            lines.append(replace(like, text=" ".join(words)))

    while todo:
        block, at, state = todo.pop()
        if not at:
            listed = block.links > 2 and block.link_chars >= _MOSTLY * block.chars and block.density < threshold
            state = _Line(
                chosen=id(block) in chosen or (state.chosen and not listed), links=state.links or 2 * block.link_chars > block.chars,
                heading=block.tag in HEADINGS, region=state.region or block is region)
        while at < len(block.parts):
            part = block.parts[at]
            at += 1
            if isinstance(part, str):
                held.append(part)
            else:
                close(state)
                if not part.cut:
                    todo += [(block, at, state), (part, 0, state)]
                    break
        else:
            close(state)
    kept = [i for i, line in enumerate(lines) if line.chosen]
    if not kept:
        return ""
    # Headings just above the text belong to it, in an article all from its first heading on,
    # and so does what stands between two of its blocks, unless it is mostly links.
    first = kept[0]
    heads = [i for i in range(first) if lines[i].heading and lines[i].region]
    if heads:
        first = heads[0]
    while first and lines[first - 1].heading:
        first -= 1
    return " ".join(line.text for line in lines[first : kept[-1] + 1] if line.chosen or not line.links)


def with_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "main_text") -> DataFrame:
    """``pages`` with the main text of each row in ``text_col``, which replaces a column of that name.

    Every row is kept, repeated ones too. A page is read on its own, so no row is moved.
    """

    @F.pandas_udf("string")
    def texts(html: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in html:
            yield pd.Series([main_text(h) for h in batch], dtype="object")

    return pages.withColumn(text_col, texts(F.col(html_col)))
