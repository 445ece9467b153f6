"""Main text of web pages by boosted trees over DOM nodes.

A page becomes a tree of block nodes. Boosted trees give each node the odds of
being main content from its subtree's density, attribute tokens, depth and
siblings. Decoding picks the most likely labels under which no node is kept
below a dropped one.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildmend.llm.boosting import Boosted
from buildmend.llm.common import by_batch
from buildmend.llm.html_samples import labelled_pages

PART = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?](?:[^>]*>|.*\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:(?>[^<>\"']+|\"[^\"<]*\"|'[^'<]*')*+|[^>]*))(?:>|\Z)"
    r"|<|[^<]+", re.S,
)
TOKENS = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PIECES = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")

#: Elements without an end, elements whose text is never shown, elements inside a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template head title iframe object svg canvas audio video map button select option textarea datalist math".split())
RAW = set("script style title textarea noscript iframe".split())
FOREIGN = {"svg", "math"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Start tags that end an open element of these kinds (up to the nearest of the stops).
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}

#: Attribute words by what they say of an element.
GROUPS = {
    "advert": "ad ads advert advertisement adsense banner promo promoted sponsor sponsored",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs toolbar",
    "comments": "comment comments reply replies respond disqus discussion feedback reviews",
    "side": "side sidebar widget widgets related recommended popular trending rail aside complementary",
    "foot": "footer foot copyright colophon legal contentinfo bottom",
    "head": "header head masthead logo topbar top branding",
    "notice": "cookie cookies consent notice alert warning popup modal overlay gdpr message toast paywall",
    "form": "form search login signup subscribe newsletter register contact",
    "share": "share social sharing follow tags meta byline author date",
    "main": "article content main post entry story body text page prose",
}
GROUP_OF = {w: i for i, (g, ws) in enumerate(GROUPS.items()) for w in ws.split()}
KINDS = ["article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "table", "td", "p", "h1", "h2", "h3", "blockquote", "pre", "figure", "figcaption", "dl", "#text"]
KIND_OF = {k: i for i, k in enumerate(KINDS)} | {"h4": 17, "h5": 17, "h6": 17, "th": 13, "tr": 12, "tbody": 12, "dt": 11, "dd": 11, "menu": 9}
#: Kinds whose nature is plain, for the nearest such ancestor.
MARKED = {"article", "main", "nav", "header", "footer", "aside", "form"}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "parts", "links", "depth", "number", "length", "linked", "size", "commas", "paras", "index")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children, self.parts, self.links = [], [], 0
        self.depth = parent.depth + 1 if parent else 0

    def text(self) -> str:
        return " ".join("".join(map(unescape, self.parts)).split())


class RawEnds:
    """Where elements end whose inside is no markup; a kind that has no end tag ahead is not looked for again."""

    def __init__(self, html: str):
        self.html = html
        self.ended: dict[str, re.Match | None] = {}

    def after(self, tag: str, at: int) -> int:
        """The place behind the end tag; without one a script or style goes on to the end of the page, others are passed over."""
        m = self.ended.get(tag, False)
        if m is False or m is not None and m.start() < at:
            m = self.ended[tag] = re.compile(f"</{tag}[^>]*>?", re.I | re.A).search(self.html, at)
        if m is not None:
            return m.end()
        return len(self.html) if tag in ("script", "style") else at


def closed(html: str, tag: str, at: int, raw: RawEnds) -> dict[int, int]:
    """For each element of a kind from ``at`` on, by where its start tag ends: where its end tag ends. Unclosed ones are left out."""
    out: dict[int, int] = {}
    open_: list[int] = []
    while at < len(html):
        m = PART.match(html, at)
        at = m.end()
        if not m["tag"]:
            continue
        name = m["tag"].lower()
        if name == tag and m["end"]:
            if open_:
                out[open_.pop()] = at
        elif name == tag:
            if not (tag in FOREIGN and (m["attrs"] or "").endswith("/")):
                open_.append(at)
        elif name in RAW and not m["end"]:
            at = raw.after(name, at)
    return out


def parse(html: str) -> Node:
    """Tree of block nodes. Text between blocks becomes a ``#text`` node of its own.

    Open elements are kept by name; a stray end tag is passed over, and an
    unfinished tag or comment at the end is markup and dropped. The ends of all
    hidden elements of a kind are found in one pass over the page.
    """
    root = Node("body", "", None)
    stack: list[tuple[str, Node | None]] = [("", root)]  # inline elements carry None
    block, line, anchors = root, None, 0
    opened: Counter[str] = Counter()
    ends: dict[str, dict[int, int]] = {}
    raw = RawEnds(html)
    at, n = 0, len(html)

    def target() -> Node:
        nonlocal line
        if line is None:
            line = Node("#text", "", block)
            block.children.append(line)
        return line

    def pop(to: int) -> None:
        nonlocal block, line, anchors
        for tag, node in stack[to:]:
            anchors -= tag == "a"
            opened[tag] -= 1
            if node is not None:
                line = None
        del stack[to:]
        block = next(node for _, node in reversed(stack) if node is not None)

    while at < n:
        m = PART.match(html, at)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                if not m[0].isspace() or line is not None:
                    own = target()
                    own.parts.append(m[0])
                    own.links += len(m[0]) * (anchors > 0)
            continue
        tag = tag.lower()
        if m["end"]:
            for k in range(0) if not opened[tag] else range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
                if tag in INLINE and stack[k][1] is not None:
                    break
            continue
        if tag == "br":
            if line is not None:
                line.parts.append(" ")
            continue
        if tag in HIDDEN:
            if tag in RAW:
                at = raw.after(tag, at)
            elif tag != "head" and not (tag in FOREIGN and (m["attrs"] or "").endswith("/")):
                if tag not in ends:
                    ends[tag] = closed(html, tag, m.start(), raw)
                at = ends[tag].get(at, at)
            continue
        if tag in VOID:
            if tag == "hr":
                line = None
            continue
        if tag in INLINE:
            stack.append((tag, None))
            opened[tag] += 1
            anchors += tag == "a"
            continue
        if tag in ("html", "body"):
            continue
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][1] is not None:
                    break
        if tag in CLOSES:
            shut, stop = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in shut:
                    pop(k)
                    break
                if stack[k][0] in stop:
                    break
        node = Node(tag, m["attrs"] or "", block)
        block.children.append(node)
        stack.append((tag, node))
        opened[tag] += 1
        block, line = node, None
    return root


def measured(root: Node) -> list[Node]:
    """Nodes in page order without empty ones, with the sums of their subtrees."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += reversed(node.children)
    for node in reversed(order):
        if node.tag == "#text":
            own = node.text()
            node.length, node.commas = len(own), own.count(",") + own.count(".")
            node.linked, node.size, node.paras = min(node.links, node.length), 1, 0
            node.parts = own
        else:
            node.children = [c for c in node.children if c.length]
            node.length = sum(c.length for c in node.children)
            node.linked = sum(c.linked for c in node.children)
            node.commas = sum(c.commas for c in node.children)
            node.size = 1 + sum(c.size for c in node.children)
            node.paras = sum(c.paras for c in node.children) + (node.tag == "p")
    kept = [x for x in order if x.length]
    for i, node in enumerate(kept):
        node.number = i
        for k, c in enumerate(node.children):
            c.index = k
    root.index = 0
    return kept


@lru_cache(maxsize=4096)
def groups_of(attrs: str) -> tuple[int, ...]:
    """How often the attribute words of each group occur."""
    seen = [0] * len(GROUPS)
    for values in TOKENS.findall(attrs):
        for word in PIECES.findall("".join(values)):
            if (g := GROUP_OF.get(word.lower())) is not None:
                seen[g] += 1
    return tuple(seen)


FEATURES = 26 + 3 * len(GROUPS)


def features(nodes: list[Node]) -> np.ndarray:
    """One row for each node: subtree, attributes, depth, siblings, ancestors."""
    out = np.zeros((len(nodes), FEATURES))
    total = max(1, nodes[0].length) if nodes else 1
    carried: dict[int, tuple] = {}
    none = (0,) * len(GROUPS)
    for i, x in enumerate(nodes):
        up = x.parent
        own = groups_of(x.attrs) if x.attrs else none
        above, marked = carried[up.number] if up is not None else (none, -1)
        carried[i] = (tuple(a + b for a, b in zip(above, own)), KIND_OF[x.tag] if x.tag in MARKED else marked)
        line = up.children if up is not None else [x]
        before = line[x.index - 1] if x.index else None
        behind = line[x.index + 1] if x.index + 1 < len(line) else None
        below = none
        if x.attrs == "" and len(x.children) == 1 and x.children[0].attrs:
            below = groups_of(x.children[0].attrs)
        out[i, :26] = (
            KIND_OF.get(x.tag, 3), marked, x.depth, np.log1p(x.length), np.log1p(x.size), x.length / x.size, x.linked / x.length,
            x.commas / x.length, x.length / total, x.paras, np.log1p(len(x.children)), x.index, len(line),
            x.index / len(line), (len(line) - 1 - x.index) / len(line),
            x.length / max(1, up.length if up is not None else x.length),
            sum(c.tag == x.tag for c in line) / len(line),
            np.log1p(before.length) if before is not None else -1, np.log1p(behind.length) if behind is not None else -1,
            KIND_OF.get(before.tag, 3) if before is not None else -1, KIND_OF.get(behind.tag, 3) if behind is not None else -1,
            KIND_OF.get(up.tag, 3) if up is not None else -1, up.linked / up.length if up is not None else 0,
            up.paras if up is not None else 0, up.commas / up.length if up is not None else 0, i / len(nodes),
        )
        out[i, 26:] = own + above + below
    return out


def decode(nodes: list[Node], margins: np.ndarray) -> list[bool]:
    """Most likely labels without a kept node below a dropped one; the root stays.

    Bottom up each subtree is worth the better of dropping all of it and of
    keeping its top with the best of each child. Ties are kept.
    """
    keep, drop = np.zeros(len(nodes)), np.zeros(len(nodes))
    for i in range(len(nodes) - 1, -1, -1):
        keep[i] += -np.logaddexp(0, -margins[i])
        drop[i] += -np.logaddexp(0, margins[i])
        up = nodes[i].parent
        if up is not None:
            keep[up.number] += max(keep[i], drop[i])
            drop[up.number] += drop[i]
    kept = [False] * len(nodes)
    for i, x in enumerate(nodes):
        kept[i] = x.parent is None or (kept[x.parent.number] and keep[i] >= drop[i])
    return kept


@lru_cache(maxsize=2)
def model(pages: int, seed: int = 3) -> Boosted:
    """Trees learned from ``pages`` generated pages whose parts are known."""
    xs, ys = [], []
    for html in labelled_pages(pages, seed):
        ys.append(truth(measured(parse(html))))
        xs.append(features(measured(parse(html.replace("✓", "")))))
    x, y = np.concatenate(xs), np.concatenate(ys)
    return Boosted().fit(x, y, np.ones(len(y)))


def truth(nodes: list[Node]) -> np.ndarray:
    """Whether a node of a labelled page holds text with the mark of content.

    Features are made from the page without its marks.
    """
    y = np.zeros(len(nodes))
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        if x.tag == "#text":
            y[i] = x.parts.startswith("✓")
        if y[i] and x.parent is not None:
            y[x.parent.number] = 1
    return y


def main_text(nodes: list[Node], kept: list[bool]) -> str:
    return "\n".join(x.parts for x, k in zip(nodes, kept) if k and x.tag == "#text")


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", training_pages: int = 400) -> DataFrame:
    """Main text of every page from its whole HTML.

    ``training_pages`` bounds the generated pages from which the trees learn.
    Null or empty HTML, and pages without content, give an empty text and 0
    characters. Repeated rows give a row each, an empty table none. Only the
    named columns are read, so extra columns cannot clash.

    Returns: ``<page_id>``, ``<url>``, text, n_chars, n_nodes, n_kept.
    """
    trees = pages.sparkSession.sparkContext.broadcast(model(training_pages))

    def make():
        learned = trees.value

        def batch(cells: dict[str, list]) -> dict[str, list]:
            out = {"id": cells["id"], "address": cells["address"], "text": [], "n_chars": [], "n_nodes": [], "n_kept": []}
            for start in range(0, len(cells["html"]), 64):
                trees_of = [measured(parse(h or "")) for h in cells["html"][start : start + 64]]
                rows = [features(nodes) for nodes in trees_of]
                margins = learned.margins(np.concatenate(rows)) if rows else np.zeros(0)
                at = 0
                for nodes in trees_of:
                    kept = decode(nodes, margins[at : at + len(nodes)])
                    at += len(nodes)
                    body = main_text(nodes, kept)
                    out["text"].append(body)
                    out["n_chars"].append(len(body))
                    out["n_nodes"].append(len(nodes))
                    out["n_kept"].append(sum(kept))
            return out

        return batch

    given = pages.select(F.col(page_id).alias("id"), F.col(url).alias("address"), F.col(html).alias("html"))
    kinds = {c: given.schema[c].dataType.simpleString() for c in ("id", "address")}
    rows = by_batch(given, make, f"id {kinds['id']}, address {kinds['address']}, text string, n_chars long, n_nodes long, n_kept long")
    return rows.withColumnsRenamed({"id": page_id, "address": url})
