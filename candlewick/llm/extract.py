"""Main text of web pages by minimum-cut labelling.

A page is read once into blocks: runs of text between block-level tags, each with the elements it lies in. A linear classifier on
each block (kind of elements around it, words in their class and id, link share, length) gives the cost of calling it content or
boilerplate: its capacities to the two terminals. Blocks that follow each other, and blocks whose lowest common element is
near, are joined by smoothness edges, weaker across the border of an ``article`` or ``main`` and of elements that name
boilerplate, and between blocks of unlike link share. The maximum flow between the terminals is the cheapest labelling; blocks on the source's side are the text.

Scripts, styles, comments, the head and form controls never become blocks. Character references are decoded, white space in a block
becomes one space. A null or empty page has no text. Repeated rows are treated alike.

Class words of elements around an ``article`` or ``main`` describe the page's layout ("has-sidebar") and do not count inside, except
that an ``article`` among comments is a comment. Within an article, ids and words that also occur as headings ("legal") count little.
The weights are set by hand. Reading a page is linear in its length, lowest common elements take logarithmic time, and a search of the
flow never enters again what a search without success has seen.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import batch_of, table, utf8

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)", re.S)
_UNQUOTED = re.compile(r"=\s*+[^\s\"'>]++\Z")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.S)

#: Fixed values of HTML: elements by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike "
                    "strong sub sup time tt u var wbr img label").split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video noembed noframes xmp".split())
#: Of these, the ones that "/>" closes; a "/" in an unquoted value does not.
FOREIGN = frozenset(("svg", "math"))
HIDDEN = RAW | frozenset("head select option datalist button textarea".split())
CLOSES_P = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                      "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul").split())

#: Weights of the classifier: positive for content.
ELEMENT = {"article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0,
           "header": -5.0, "h1": 1.5, "p": 1.0, "blockquote": 0.5, "pre": 0.5, "address": -1.0, "fieldset": -4.0}
#: A header or footer within an article is milder than the page's, unless there is nothing but links in it.
INNER = {"header": 0.0, "footer": -6.0}
ROLE = {"navigation": -9.0, "banner": -9.0, "contentinfo": -9.0, "complementary": -9.0, "search": -9.0, "dialog": -9.0,
        "alertdialog": -9.0, "alert": -9.0, "menu": -9.0, "form": -9.0, "main": 3.0, "article": 4.0}
#: Words in classes and ids. Those of readers' talk hold for an article within as well.
TALK_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
BAD_WORDS = TALK_WORDS | frozenset(
    ("ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner cookie cookies "
     "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login discussion "
     "feedback sidebar side rail widget widgets related recommended "
     "recommendations trending popular share sharing social follow nav navbar navigation menu breadcrumb breadcrumbs "
     "pagination pager footer footnav masthead topbar toolbar skip copyright legal disclaimer tags taglist hidden").split())
#: These may name a part of an article too.
MILD_WORDS = frozenset(("banner alert discussion feedback side rail popular trending share sharing social follow legal disclaimer copyright "
                        "tags skip hidden").split())
GOOD_WORDS = frozenset("article content post entry story body main text maintext articlebody postbody".split())
#: A class such as "has-sidebar", "ad-free" or "content-sidebar-wrap" tells of the page, not of the element.
STATE_FIRST = frozenset("has have no not with without is hide show open enable enabled disable disabled".split())
STATE_LAST = frozenset("free enabled disabled open closed active on off layout template page".split())
WRAP = frozenset("wrap wrapper layout container row grid".split())
BAD_CLASS, MILD_CLASS, GOOD_CLASS = -9.0, -3.0, 1.0
BASE = 0.25
LINK_SHARE = -6.0
LONG_TEXT = 2.5
SHORT_TEXT = -0.2
#: Smoothness: between neighbours, times CLOSE for the same parent, times BORDER over an element that sets content apart, less UNLIKE
#: times the difference of their link shares.
SMOOTH, CLOSE, BORDER, UNLIKE = 1.2, 1.5, 0.05, 0.9


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    depth: int
    jump: int  # an element around it, far up; the root's is the root
    owner: int  # the nearest element around it (or itself) that is not inline
    kind: float  # weight of the elements around it and itself
    talk: float  # of their words for readers' talk
    layout: float  # of their other words
    border: int  # the nearest element around it (or itself) that sets content apart
    content: bool  # inside an article or main
    hidden: bool

    @property
    def weight(self) -> float:
        return self.kind + self.talk + self.layout


@dataclass(slots=True)
class Block:
    element: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _words(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w]


def _class_words(value: str) -> set[str]:
    """Words of a class or id that describe the element itself."""
    words: set[str] = set()
    for token in value.split():
        parts = _words(token)
        if len(parts) > 1 and (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST
                               or parts[-1] in WRAP and not GOOD_WORDS.isdisjoint(parts)):
            continue
        words.update(parts)
    return words


def _own_weights(tag: str, attributes: str, inside: bool) -> tuple[float, float, float, bool]:
    """Weights of an element itself (kind, talk, layout), and whether it is hidden."""
    kind, talk, layout = (INNER if inside and tag in INNER else ELEMENT).get(tag, 0.0), 0.0, 0.0
    hidden = tag in HIDDEN
    if tag == "form":  # some pages are one form
        kind, layout = 0.0, kind
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                if tag in ("html", "body", "main") or inside and name == "id" and tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                    continue
                words = _class_words(value)
                bad = words & BAD_WORDS
                if tag == "article":  # its classes list what the article is about
                    talk += BAD_CLASS if "comment" in value.lower().split() else 0.0
                elif bad:
                    mild = inside and (name == "id" and bad.isdisjoint(TALK_WORDS) or bad <= MILD_WORDS)
                    cost = MILD_CLASS if mild else BAD_CLASS
                    talk, layout = (talk, layout + cost) if bad.isdisjoint(TALK_WORDS) else (talk + cost, layout)
                elif not GOOD_WORDS.isdisjoint(words):
                    kind += GOOD_CLASS
            elif name == "role":
                kind += ROLE.get(value.lower(), 0.0)
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or \
                    name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                hidden = True
    return kind, talk, layout, hidden


def _closed_by(tag: str) -> tuple[str, ...]:
    """Elements without an end tag that the start of another one ends."""
    if tag in CLOSES_P:
        return ("p",)
    if tag in ("dd", "dt"):
        return ("dd", "dt")
    if tag in ("td", "th"):
        return ("td", "th")
    return {"li": ("li",), "tr": ("tr", "td", "th"), "option": ("option",)}.get(tag, ())


class _Open:
    """The open elements, with the places of each tag and of those that are not inline; every element enters and leaves once."""

    def __init__(self, elements: list[Element]):
        self.elements, self.stack, self.linking = elements, [0], 0
        self.blocks: list[int] = [0]
        self.places: dict[str, list[int]] = {}

    def push(self, k: int) -> None:
        tag = self.elements[k].tag
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.linking += tag == "a"
        self.stack.append(k)

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            tag = self.elements[self.stack.pop()].tag
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
            self.linking -= tag == "a"

    def end(self, tag: str) -> None:
        place = (self.places.get(tag) or [0])[-1]
        # An inline end tag does not close the blocks around it.
        if place and not (tag in INLINE and self.blocks[-1] > place):
            self.pop_to(place)

    def start(self, tag: str) -> None:
        closed = _closed_by(tag)
        if closed:
            for place in reversed(self.blocks):
                if self.elements[self.stack[place]].tag in closed:
                    self.pop_to(place)
                elif self.elements[self.stack[place]].tag == "p":
                    continue
                break
        if tag == "body" and self.places.get("head"):
            self.pop_to(1)


def _added(elements: list[Element], tag: str, attributes: str, parent: int) -> int:
    up = elements[parent]
    kind, talk, layout, hidden = _own_weights(tag, attributes, up.content)
    own, article = kind + talk + layout, tag in ("article", "main")
    skip = elements[up.jump]
    jump = skip.jump if up.depth - skip.depth == skip.depth - elements[skip.jump].depth else parent
    k = len(elements)
    elements.append(Element(
        tag, parent, up.depth + 1, jump, up.owner if tag in INLINE else k, up.kind + kind,
        talk + (0.0 if tag == "main" else up.talk), layout + (0.0 if article and not up.content else up.layout),
        k if own <= -3.0 or article else up.border, up.content or article, up.hidden or hidden))
    return k


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """The page's text blocks in order, and its elements."""
    elements = [Element("", -1, 0, 0, 0, 0.0, 0.0, 0.0, 0, False, False)]
    blocks: list[Block] = []
    opened, current, at = _Open(elements), None, 0

    def text(chunk: str) -> None:
        nonlocal current
        if not chunk or elements[opened.stack[-1]].hidden:
            return
        if current is None:
            if chunk.isspace():
                return
            current = Block(elements[opened.stack[-1]].owner)
            blocks.append(current)
        chunk = html.unescape(chunk) if "&" in chunk else chunk
        current.parts.append(chunk)
        if opened.linking:
            current.linked += len(chunk)

    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in INLINE or m[1] and tag == "br":
            current = None
        if m[1]:
            opened.end(tag)
            continue
        opened.start(tag)
        if tag in VOID:
            continue
        k = _added(elements, tag, m[3], opened.stack[-1])
        if tag in FOREIGN and m[3].endswith("/") and not _UNQUOTED.search(m[3]):
            continue
        if tag in RAW:  # its content is no markup
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            at = end.end()
            continue
        if not m[3].rstrip().endswith("/"):
            opened.push(k)
    for block in blocks:
        block.text = " ".join("".join(block.parts).split())
    return [b for b in blocks if b.text], elements


def link_share(block: Block) -> float:
    return min(1.0, block.linked / max(1, len(block.text)))


def score(block: Block, elements: list[Element]) -> float:
    """The classifier: above 0 for content."""
    element = elements[block.element]
    share = link_share(block)
    length = len(block.text)
    shape = LONG_TEXT if length >= 80 else SHORT_TEXT if length < 20 else 0.0
    return BASE + max(-20.0, min(8.0, element.weight)) + LINK_SHARE * share * (0.3 if element.content else 1.0) + shape


def _near(a: int, b: int, elements: list[Element]) -> int:
    """Steps from the lowest common element to the farther of two."""
    if elements[a].depth < elements[b].depth:
        a, b = b, a
    top, level = elements[a].depth, elements[b].depth
    while elements[a].depth > level:
        far = elements[a].jump
        a = far if elements[far].depth >= level else elements[a].parent
    while a != b:
        if elements[a].jump != elements[b].jump:
            a, b = elements[a].jump, elements[b].jump
        else:
            a, b = elements[a].parent, elements[b].parent
    return top - elements[a].depth


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: the labelling with the least cost.

    A node with cost above 0 pays it if cut from the source, one below 0 pays if cut from the sink; an edge pays its weight if its
    ends differ. Augmenting paths by breadth-first search, from nodes that still have supply to nodes that still have demand. What a
    search without success has seen has no way out any more, so no later search enters it.
    """
    supply, dead = list(costs), [False] * len(costs)
    around: list[list[int]] = [[] for _ in costs]
    heads, room = [], []
    for a, b, weight in edges:
        around[a].append(len(heads))
        heads.append(b)
        room.append(weight)
        around[b].append(len(heads))
        heads.append(a)
        room.append(weight)
    for origin in range(len(costs)):
        while supply[origin] > 1e-9 and not dead[origin]:
            came, queue, goal = {origin: -1}, deque([origin]), -1
            while queue and goal < 0:
                node = queue.popleft()
                for e in around[node]:
                    to = heads[e]
                    if room[e] > 1e-9 and to not in came and not dead[to]:
                        came[to] = e
                        if supply[to] < -1e-9:
                            goal = to
                            break
                        queue.append(to)
            if goal < 0:
                for node in came:
                    dead[node] = True
                break
            path, node = [], goal
            while came[node] >= 0:
                path.append(came[node])
                node = heads[came[node] ^ 1]
            flow = min(supply[origin], -supply[goal], *(room[e] for e in path))
            for e in path:
                room[e] -= flow
                room[e ^ 1] += flow
            supply[origin] -= flow
            supply[goal] += flow
    keep = [s > 1e-9 for s in supply]
    queue = deque(i for i, k in enumerate(keep) if k)
    while queue:
        for e in around[queue.popleft()]:
            if room[e] > 1e-9 and not keep[heads[e]]:
                keep[heads[e]] = True
                queue.append(heads[e])
    return keep


def smoothness(blocks: list[Block], elements: list[Element]) -> list[tuple[int, int, float]]:
    """Edges between blocks in a row, and from each block to the block before it in the same parent, if not the same."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        parent = elements[block.element].parent
        for j in {i - 1, last.get(parent, -1)} - {-1}:
            a, b = blocks[j].element, block.element
            weight = SMOOTH * (CLOSE if elements[a].parent == parent else 1.0) / max(1, _near(a, b, elements))
            weight *= 1.0 - UNLIKE * abs(link_share(blocks[j]) - link_share(block))
            edges.append((j, i, weight * (BORDER if elements[a].border != elements[b].border else 1.0)))
        last[parent] = i
    return edges


def main_text(page: bytes | None) -> tuple[str, int, int]:
    """The text, and how many blocks there are and are kept."""
    if not page:
        return "", 0, 0
    blocks, elements = blocks_of(page.decode("utf-8", "replace"))
    if not blocks:
        return "", 0, 0
    keep = minimum_cut([score(b, elements) for b in blocks], smoothness(blocks, elements))
    kept = [b.text for b, k in zip(blocks, keep) if k]
    return " ".join(kept), len(blocks), len(kept)


_EXTRACTED = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
                        ("n_blocks", pa.int32()), ("n_kept", pa.int32())])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.slice(at, 500)
            found = [main_text(page) for page in part.column(2).to_pylist()]
            texts, total, kept = (list(x) for x in zip(*found))
            texts = [t.encode("utf-8", "replace").decode() for t in texts]  # no lone surrogates from references
            yield batch_of(_EXTRACTED, [part.column(0), part.column(1), texts, [len(t) for t in texts], total, kept])


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """Main text and its number of code points, of every page."""
    slim = pages.select(F.col(id_column).cast("long").alias("id"), F.col(url).alias("url"), utf8(html_column).alias("html"))
    return slim.mapInArrow(_extracted, "id long, url string, text string, n_chars long, n_blocks int, n_kept int") \
        .withColumnRenamed("id", id_column)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
