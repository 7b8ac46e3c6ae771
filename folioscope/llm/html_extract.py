"""Operator 10, HTML extraction: minimum-cut labelling of text blocks.

A page's tags cut its text into blocks. A linear classifier weighs a block's length against the page's usual one, its share of linked
characters, its ending, its heading and the tags and names around it; the sum is the cost of the other label, as capacity from the source
(content) or to the sink (boilerplate). Smoothness edges join neighbouring blocks and the blocks of one container, the stronger the closer
they are in the DOM. The minimum cut, found by augmenting paths, separates content from boilerplate. No name is a veto: a long paragraph of
the article outweighs a container called "social", and a short line among paragraphs is turned to content by its edges.

The page's script, style, comments and drawings are no text; a line break is white space inside its block; an unclosed element ends where
HTML ends it. White space is what Unicode calls so, no-break spaces included. A tag whose quotes never close ends at its first ">".

A page is read in one pass: an element is pushed and popped once, and looked up by its tag, so deep, broken and hostile pages of any length take
time in proportion to their length; only the search for augmenting paths may take more, over the blocks whose label no terminal settles.

Defined cases: null and empty pages give the empty text; an empty table an empty one; repeated pages and ids, null ids included, are extracted
each by itself; of equal cuts the one with the least content counts; other columns are ignored. A page is one row, and the operator a narrow map
without a shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import ROWS_PER_BATCH, slices

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_PLAIN_END, _STOP, _SPACE = re.compile(r"[^>\"'=]*>"), re.compile(r"[>=]"), re.compile(r"\s*")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Elements that hold no text of the page, that end a block of text, that have no content, and what a start tag closes.
RAW = frozenset("script style noscript template textarea iframe title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br input object svg".split())
#: Parts of a formula; they end no block, and "/>" closes them.
FORMULA = frozenset("math mi mn mo ms mtext mspace mrow msub msup msubsup munder mover munderover mmultiscripts mprescripts mfrac msqrt mroot mtable mtr mtd mstyle mpadded mphantom menclose mfenced semantics annotation annotation-xml".split())
INLINE |= FORMULA
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end a drawing left open.
BREAKS = HEADINGS | frozenset("article aside blockquote body center dd div dl dt footer form header hr li main nav ol p pre section table ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = RAW | frozenset("base link meta html head".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: A closed element never reaches beyond these.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

# The classifier's weights: evidence for content is positive.
BIAS, LENGTH, SHORTEST, SENTENCE, HEADING, LINKED, MARKED = 0.5, 1.5, -1.25, 1.0, 0.5, -4.0, -2.5
#: A block of so many words is long on any page.
USUAL = 15
NEIGHBOUR, SIBLING = 1.5, 2.0
TAGS = {"nav": -6.0, "footer": -6.0, "aside": -6.0, "form": -6.0, "head": -9.0, "button": -6.0, "select": -6.0, "menu": -6.0, "dialog": -7.0, "header": -4.0, "article": 3.5, "main": 3.5}
NAMES = {
    **dict.fromkeys("comment comments reply replies respond discussion disqus".split(), -8.0),
    **dict.fromkeys(
        "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup".split(),
        -7.0,
    ),
    **dict.fromkeys("nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager skip login search".split(), -6.0),
    **dict.fromkeys("sidebar side aside widget widgets related recommended recommendations complementary footer foot masthead contentinfo copyright legal disclaimer".split(), -6.0),
    **dict.fromkeys("share sharing social".split(), -4.0),
    **dict.fromkeys("article content main post entry story maincontent".split(), 2.0),
}
_MARKS = frozenset("©®›»")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    depth: int  # open elements
    low: int  # the fewest that were open since the block before
    box: int  # the element around the block's own
    names: float  # evidence of the tags and names around
    heading: bool


@lru_cache(4096)
def _element(tag: str, attributes: str) -> float:
    """The evidence of an element by its tag and names: the strongest against content, else the strongest for it."""
    found = [TAGS[tag]] if tag in TAGS else []
    if tag not in ("html", "body") and "=" in attributes:
        for m in _NAMED.finditer(attributes):
            found += [NAMES[x] for x in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()) if x in NAMES]
    return min(found) if found and min(found) < 0 else max(found, default=0.0)


def tags_of(page: str) -> Iterator[tuple[str, bool, str, str]]:
    """(text before, whether an end tag, tag, attributes) for each tag; the last has the empty tag."""
    at, look, quotes = 0, 0, True
    while True:
        i = page.find("<", look)
        if i < 0:
            yield page[at:], False, "", ""
            return
        m = _NAME.match(page, i + 1)
        if not m:
            if page.startswith("<!--", i):
                end = page.find("-->", i + 4)
                end = len(page) if end < 0 else end + 3
            elif page.startswith(("<!", "<?", "</"), i):
                end = page.find(">", i) + 1
            else:
                end = 0
            if end:
                yield page[at:i], False, "!", ""
                at = look = end
            else:
                look = i + 1
            continue
        end = 0
        if plain := _PLAIN_END.match(page, m.end()):
            end = plain.end()
        elif quotes:
            end = _tag_end(page, m.end())
            quotes = end > 0  # one quote that never closes: none is looked for from here on
        if not end:
            end = page.find(">", m.end()) + 1
        if not end:
            yield page[at:], False, "", ""
            return
        tag, close = m[2].lower(), bool(m[1])
        yield page[at:i], close, tag, page[m.end() : end - 1]
        at = look = end
        if tag in RAW and not close:
            shut = _shut(tag).search(page, at)
            at = look = shut.end() if shut else len(page)


def _tag_end(page: str, at: int) -> int:
    """The place after a tag's ">", which may stand in a quoted value before; 0 if there is none."""
    while m := _STOP.search(page, at):
        if m[0] == ">":
            return m.end()
        at = _SPACE.match(page, m.end()).end()
        if page[at : at + 1] in ('"', "'"):
            at = page.find(page[at], at + 1) + 1
            if not at:
                return 0
    return 0


@lru_cache(16)
def _shut(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.I)


class _Open:
    """The open elements, and where those of each tag are among them."""

    def __init__(self):
        self.tags: list[str] = []
        self.ids: list[int] = []
        self.names: list[tuple[float, float]] = [(0.0, 0.0)]  # evidence against and for content, of all elements up to here
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # those that end a block of text
        self.serial = 0

    def __len__(self) -> int:
        return len(self.tags)

    def push(self, tag: str, attributes: str) -> None:
        weight = _element(tag, attributes)
        against, for_ = self.names[-1]
        if tag == "header" and for_ > 0 and weight == TAGS[tag]:
            weight = 0.0  # an article's own header
        if weight < 0:
            against = min(against, weight)
        elif weight:
            for_ = max(for_, weight / 2 if against else weight)
        self.names.append((against, for_))
        self.at.setdefault(tag, []).append(len(self.tags))
        if tag not in INLINE:
            self.blocks.append(len(self.tags))
        self.serial += 1
        self.tags.append(tag)
        self.ids.append(self.serial)

    def cut(self, place: int) -> None:
        """Close all from a place on."""
        while len(self.tags) > place:
            tag = self.tags.pop()
            self.ids.pop()
            self.names.pop()
            self.at[tag].pop()
            if self.blocks and self.blocks[-1] == len(self.tags):
                self.blocks.pop()

    def last(self, tag: str) -> int:
        places = self.at.get(tag)
        return places[-1] if places else -1

    def end(self, tag: str) -> None:
        """An end tag; one of inline text reaches no further than the block around."""
        place = self.last(tag)
        if place >= 0 and (tag not in INLINE or not self.blocks or place > self.blocks[-1]):
            self.cut(place)

    def make_way(self, tag: str) -> None:
        """Close what the start tag of a block closes."""
        if tag in CLOSES:
            scope = max(map(self.last, SCOPES[tag]))
            places = [x[k] for t in (*CLOSES[tag], "p") if (x := self.at.get(t)) and (k := bisect_right(x, scope)) < len(x)]
            if places:
                self.cut(min(places))
        elif self.blocks and self.tags[self.blocks[-1]] == "p":
            self.cut(self.blocks[-1])
        if tag not in IN_HEAD and self.blocks and self.tags[self.blocks[-1]] == "head":
            self.cut(self.blocks[-1])


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked, low = 0, 0

    def flush() -> None:
        nonlocal linked, low
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, linked, len(open_), min(low, len(open_)), open_.ids[-2] if len(open_) > 1 else 0, sum(open_.names[-1]), any(t in HEADINGS for t in open_.tags[-3:])))
            low = len(open_)
        parts.clear()
        linked = 0

    for text, close, tag, attributes in tags_of(page):
        if text and not open_.at.get("svg"):
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if open_.at.get("a"):
                linked += len(text.strip())
        if tag in ("", "!"):
            continue
        drawing = open_.at.get("svg")
        if drawing and not close and tag in BREAKS:
            open_.cut(drawing[0])
        block = tag not in INLINE and tag not in RAW and not open_.at.get("svg")
        if block:
            flush()
        elif tag == "br":
            parts.append(" ")
        if close:
            open_.end(tag)
        elif tag not in RAW and tag not in VOID and not ((tag in FORMULA or tag == "svg") and attributes.endswith("/")):
            if block:
                open_.make_way(tag)
            low = min(low, len(open_))
            open_.push(tag, attributes)
        low = min(low, len(open_))
    flush()
    return out


def usual_words(blocks: list[Block]) -> int:
    """The size of the block in which the middle word of the page's unlinked text stands, ``USUAL`` at most."""
    sizes = sorted(b.text.count(" ") + 1 for b in blocks if 2 * b.linked < len(b.text))
    half, total = 0, sum(sizes)
    for n in sizes:
        half += n
        if 2 * half >= total:
            return min(n, USUAL)
    return 1


def score(b: Block, usual: int) -> float:
    """The classifier: positive for content."""
    words = b.text.count(" ") + 1
    s = BIAS + b.names + LENGTH * min(1.0, max(SHORTEST, log2((words + 1) / (usual + 1)))) + LINKED * min(1.0, b.linked / len(b.text))
    return s + SENTENCE * (b.text[-1] in ".!?…\"'”’»:") + HEADING * b.heading + MARKED * (not _MARKS.isdisjoint(b.text) and words < USUAL)


def smoothness(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Edges between neighbours, and between blocks that follow each other in one container."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges[i - 1, i] = NEIGHBOUR / (1 + blocks[i - 1].depth + b.depth - 2 * b.low)
        if b.box in last:
            edges[last[b.box], i] = edges.get((last[b.box], i), 0.0) + SIBLING / (1 + i - last[b.box])
        last[b.box] = i
    return edges


def minimum_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """True for nodes on the source's side. Positive scores are capacities from the source, negative ones to the sink.

    Of several minimum cuts, the one with the fewest nodes on the source's side. Nodes whose terminal outweighs their edges are settled
    before the search, which leaves the cut as it is; the search goes through each connected rest by itself.
    """
    n = len(scores)
    unary = list(scores)
    around: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), c in edges.items():
        around[i][j] = around[i].get(j, 0.0) + c
        around[j][i] = around[j].get(i, 0.0) + c
    side: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:  # a settled node's edges become its neighbours' terminals
        i = todo.pop()
        if side[i] is None and abs(unary[i]) > sum(around[i].values()):
            side[i] = unary[i] > 0
            for j, c in around[i].items():
                unary[j] += c if side[i] else -c
                del around[j][i]
                todo.append(j)
            around[i] = {}
    for k in range(n):
        if side[k] is None:
            part, todo = {k}, [k]
            while todo:
                new = [j for j in around[todo.pop()] if j not in part]
                part.update(new)
                todo += new
            reached = _augment(sorted(part), unary, around)
            for i in part:
                side[i] = i in reached
    return [bool(s) for s in side]


def _augment(nodes: list[int], unary: list[float], residual: list[dict[int, float]]) -> set[int]:
    """Augmenting paths, all of one length at a time, until none is left; the nodes that the source then reaches."""
    supply = {i: max(unary[i], 0.0) for i in nodes}
    demand = {i: max(-unary[i], 0.0) for i in nodes}
    tiny = 1e-12
    while True:
        level = {i: 0 for i in nodes if supply[i] > tiny}
        begun, front, met = list(level), list(level), False
        while front and not met:
            met = any(demand[i] > tiny for i in front)
            ahead = []
            for i in front:
                for j, c in residual[i].items():
                    if c > tiny and j not in level:
                        level[j] = level[i] + 1
                        ahead.append(j)
            front = ahead
        if not met:
            return set(level)
        arcs = {i: list(residual[i]) for i in level}
        for source in begun:
            path = [source]
            while path and supply[source] > tiny:
                i = path[-1]
                if demand[i] > tiny:
                    flow = min(supply[source], demand[i], *(residual[a][b] for a, b in zip(path, path[1:], strict=False)))
                    supply[source] -= flow
                    demand[i] -= flow
                    full = len(path)
                    for k, (a, b) in reversed(list(enumerate(zip(path, path[1:], strict=False)))):
                        residual[a][b] -= flow
                        residual[b][a] = residual[b].get(a, 0.0) + flow
                        if residual[a][b] <= tiny:
                            full = k + 1
                    del path[full:]
                    continue
                while arcs[i] and not (residual[i].get(arcs[i][-1], 0.0) > tiny and level.get(arcs[i][-1]) == level[i] + 1):
                    arcs[i].pop()
                if arcs[i]:
                    path.append(arcs[i][-1])
                else:
                    path.pop()
                    if path:
                        arcs[path[-1]].pop()


def labelled(page: str | None) -> tuple[list[Block], list[float], list[bool]]:
    """A page's blocks, what the classifier alone gives each, and the cut's labels."""
    blocks = blocks_of(page or "")
    usual = usual_words(blocks)
    scores = [score(b, usual) for b in blocks]
    return blocks, scores, minimum_cut(scores, smoothness(blocks))


def extract(page: str | None) -> str:
    blocks, _, content = labelled(page)
    return "\n".join(b.text for b, c in zip(blocks, content, strict=True) if c)


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    ready = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.col("url").cast("string").alias("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [extract(h) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return ready.mapInArrow(run, "page_id long, url string, text string, n_chars long")
