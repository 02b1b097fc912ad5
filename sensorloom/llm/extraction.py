"""Main text of web pages by minimum-cut labelling.

A page becomes a sequence of text blocks.  A classifier weighs for each block what speaks for article and what for
boilerplate (containers, names of classes, links, length, sentences); these weights are the terminal capacities of a
graph.  Blocks that follow each other or share a container are joined by smoothness edges, so a short heading follows
the paragraphs around it and a lone sentence in a menu follows the menu.  The minimum cut separates article from
boilerplate.

The page is read by a tolerant scanner: unclosed and misnested tags, cut-off pages, ``>`` in quoted attributes and
stray ``<`` are all read to the end of the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.mincut import labels

# Elements of HTML by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset(
    "head nav aside footer form button select option datalist label fieldset legend input menu dialog object svg math canvas audio "
    "video map applet".split()
)
CLOSED_BY_BLOCK = "p"
SAME_CLOSES = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id, role or label of a container that speak for boilerplate.
BOILERPLATE = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising adslot adunit alert banner breadcrumb breadcrumbs comment comments commentlist "
    "consent contentinfo cookie cookies copyright dialog discussion disqus disclaimer donate feedback foot footer form gdpr login menu menubar modal "
    "nav navbar navigation newsletter notice notices notification outbrain pager pagination paywall popup prefooter privacy promo promotion "
    "recommendation recommendations recommended related replies reply respond search share sharing sidebar signin signup skip social sponsor sponsored "
    "subfooter subscribe subscription survey taboola tagcloud teaser teasers toolbar topbar trending widget widgets".split()
)
TOP = frozenset("header masthead head hero branding logo sitename".split())
MAIN = frozenset("article main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^<>]*+\Z",
    re.S,
)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|aria-label|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SENTENCE_END = (".", "!", "?", "…", "。", "！", "？", '."', ".”", ".»", ":")
RIGHTS = re.compile(r"\s*(?:©|\(c\)|copyright\b|all rights reserved)", re.I)

IN_MAIN, OUTSIDE, NAMED_SO, AT_TOP, SILENCED = 4.0, -3.0, -9.0, -7.0, -1000.0
ADJACENT, SIBLING = 0.4, 1.2


@dataclass
class Node:
    """An open element: what it and its ancestors say about text inside."""

    name: str
    parent: Node | None
    silent: bool = False
    main: bool = False
    words: frozenset[str] = frozenset()
    number: int = 0
    block: Node | None = None  # the nearest element that is a block, itself included


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _open(name: str, attributes: str, parent: Node | None, number: int) -> Node:
    silent, words = name in SILENT, set()
    if attributes:
        for key, value in NAMED.findall(attributes):
            key, value = key.lower(), unescape(value.strip("\"'"))
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and HIDDEN.search(value):
                silent = True
            elif key != "style":
                words.update(w.lower() for w in NAME_PART.findall(value))
    main = name in MAIN or bool(words & {"main"}) and name in ("div", "section")
    if parent:
        silent, main = silent or parent.silent, main or parent.main
    node = Node(name, parent, silent, main, frozenset(words), number)
    node.block = node if name in BLOCK or parent is None else parent.block
    return node


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a page in order, white space inside a block as one space, empty ones left out."""
    root = _open("", "", None, 0)
    stack, out, current, count = [root], [], None, 0
    opened: Counter[str] = Counter()  # names on the stack, so that what is not there is not looked for

    def add(text: str) -> None:
        nonlocal current
        if current is None:
            current = Block(stack[-1].block)
        current.parts.append(text)
        if opened["a"]:
            current.linked += len(text.strip())

    def flush() -> None:
        nonlocal current
        if current is not None:
            current.text = " ".join("".join(current.parts).split())
            if current.text:
                out.append(current)
            current = None

    def pop_to(k: int) -> None:
        while len(stack) > k:
            opened[stack.pop().name] -= 1

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            add(unescape(text))
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if name in BLOCK:
            flush()
        if closing:
            if opened[name]:
                pop_to(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name))
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if name == "br":
            add(" ")
        if name in VOID:
            continue
        if name in BLOCK:
            # a block ends an open paragraph, and an item the item before it
            ends = (name, SAME_CLOSES[name].split()) if name in SAME_CLOSES else (CLOSED_BY_BLOCK, ())
            for k in range(len(stack) - 1, 0, -1) if opened[ends[0]] or opened[CLOSED_BY_BLOCK] else ():
                if stack[k].name in (ends[0], CLOSED_BY_BLOCK):
                    pop_to(k)
                    if stack[-1].name != ends[0]:
                        break
                elif stack[k].name in ends[1] or stack[k].name in BLOCK and name not in SAME_CLOSES:
                    break
        if attributes.endswith("/") and name in ("svg", "path", "use", "rect", "circle"):
            continue
        count += 1
        stack.append(_open(name, attributes, stack[-1], count))
        opened[name] += 1
    flush()
    return out


def _nodes(blocks: list[Block]) -> list[Node]:
    """The containers of the blocks and all around them, each once, a container before what it holds."""
    seen: dict[int, Node] = {}
    for b in blocks:
        node: Node | None = b.node
        while node is not None and node.number not in seen:
            seen[node.number] = node
            node = node.parent
    return [seen[k] for k in sorted(seen)]


def page_wide(blocks: list[Block], nodes: list[Node]) -> set[int]:
    """Containers that hold a first heading and over half of the text that counts: their names say how the page is laid
    out ("with-sidebar"), not what the text is."""
    chars = dict.fromkeys((n.number for n in nodes), 0)
    headed: set[int] = set()
    for b in blocks:
        if not b.node.silent:
            chars[b.node.number] += len(b.text)
            if b.node.name == "h1":
                headed.add(b.node.number)
    for node in reversed(nodes):
        if node.parent is not None:
            chars[node.parent.number] += chars[node.number]
            if node.number in headed:
                headed.add(node.parent.number)
    total = chars[nodes[0].number]
    return {n for n in headed if 2 * chars[n] > total}


def around(nodes: list[Node], holds_main: set[int], wide: set[int]) -> dict[int, tuple[bool, bool]]:
    """Per container whether it or one around it is named like boilerplate, and like the top of a page."""
    out: dict[int, tuple[bool, bool]] = {}
    for node in nodes:
        named, top = out[node.parent.number] if node.parent is not None else (False, False)
        if node.number not in holds_main and node.name not in ("html", "body"):
            named = named or node.number not in wide and bool(node.words & BOILERPLATE)
            top = top or not node.main and (node.name == "header" or bool(node.words & TOP))
        out[node.number] = named, top
    return out


def evidence(block: Block, has_main: bool, named: bool, top: bool, has_prose: bool) -> float:
    """What speaks for article, above 0, or for boilerplate, below 0."""
    if block.node.silent:
        return SILENCED
    score = (IN_MAIN if block.node.main else OUTSIDE) if has_main else 0.0
    score += NAMED_SO * named + AT_TOP * top
    text = block.text
    linked = min(1.0, block.linked / len(text))
    words = text.count(" ") + 1
    score -= 8 * max(0.0, linked - 0.3)
    score += min(words, 60) / 20
    if text.endswith(SENTENCE_END):
        score += 0.5
    elif words < 12 and has_prose:
        score -= 1.0
    if block.node.name in HEADINGS:
        score += 2.5 if block.node.name == "h1" else 1.0
    if words < 40 and RIGHTS.match(text):
        score -= 4.0
    return score


def smoothness(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Edges between blocks that follow each other, and between followers inside one container."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            edges[i - 1, i] = edges.get((i - 1, i), 0.0) + ADJACENT
        parent = block.node.parent or block.node
        if parent.number in last:
            j = last[parent.number]
            edges[j, i] = edges.get((j, i), 0.0) + SIBLING
        last[parent.number] = i
    return edges


def main_text(html: str | None) -> str:
    """The article of a page, its blocks one per line; empty if there is none."""
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    nodes = _nodes(blocks)
    has_main = any(b.node.main and not b.node.silent for b in blocks)
    counted = {b.node.number for b in blocks if b.node.main and not b.node.silent}
    holds_main: set[int] = set()
    for node in reversed(nodes):
        if node.parent is not None and (node.number in holds_main or node.number in counted):
            # what is in the main part passes the mark on, what is around it keeps it
            (counted if node.parent.main else holds_main).add(node.parent.number)
    # on a page without a paragraph of some length, short lines are all there is
    has_prose = any(b.text.count(" ") >= 20 for b in blocks if not b.node.silent)
    facts = around(nodes, holds_main, page_wide(blocks, nodes))
    scores = [evidence(b, has_main, *facts[b.node.number], has_prose) for b in blocks]
    keep = labels([max(0.0, -s) for s in scores], [max(0.0, s) for s in scores], smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row ``page_id, url, text, n_chars`` (code points of the text).

    Null and empty html give an empty text; null ids and addresses are passed on; rows do not depend on each other, so
    repeated rows give repeated results and an empty table an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t.as_py()) for t in batch.column(2)]
            lengths = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(lengths, pa.int64())], schema.names
            )

    schema = T.StructType(
        [
            T.StructField("page_id", pages.schema[key].dataType),
            T.StructField("url", pages.schema[url].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    return pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(run, schema)
