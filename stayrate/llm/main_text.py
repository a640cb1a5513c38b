"""The main text of web pages, by composite text density."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.scratch import in_small_batches

# --- fixed values: what elements are for ------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that are no part of an article's text.
NO_TEXT = set(
    "head script style noscript template iframe noembed noframes object svg math canvas audio video map nav aside footer form "
    "button input select option textarea dialog menu datalist title".split()
)
#: Words of a class, id or role that mark what is not the article.
NO_ARTICLE = set(
    "ad ads advert adverts advertisement adverting sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription paywall sidebar sidenav menu menubar nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager footer copyright colophon share sharing social related recommended recommendations "
    "comment comments disqus respond replies reactions toolbar login signup signin search widget complementary contentinfo".split()
)
#: Heads of pages; inside an article they are its own.
PAGE_HEAD = {"header", "masthead", "topbar"}
# ----------------------------------------------------------------------------

_COMMENTS = {"comment", "comments", "disqus", "replies", "respond"}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'](?=[^<>]*(?:>|\Z)))*+)(?:>|\Z)", re.DOTALL
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
#: An element of these ends an open one of those, up to the nearest of the last.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Around these an open paragraph or formatting element of the outside has no effect.
_WALLS = {"table", "td", "th", "button", "object", "template", "body", "html", "article", "section", "div", "li", "nav", "aside", "main", "form"}


class Node:
    __slots__ = ("tag", "parent", "children", "names", "hidden", "chars", "tags", "link_chars", "link_tags", "density", "total", "dropped")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.names: set[str] = set()
        self.hidden = False
        if attributes:
            for m in _NAMES.finditer(attributes):
                self.names.update(_WORDS.findall((m[1] or m[2] or m[3] or "").lower()))
            self.hidden = bool(_HIDDEN.search(attributes))
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.dropped = False
        if parent is not None:
            parent.children.append(self)


def parse(html: str) -> tuple[Node, list[Node], list[tuple[Node | None, str]]]:
    """The tree, its nodes in page order, and the page's pieces in order: (node, text), or
    (None, "") where a block begins or ends.

    Tags that are never closed, closed twice or cut off at the end are taken as browsers take them,
    roughly: a block ends an open paragraph, an item ends the item before.
    """
    root = Node("html", None)
    nodes, pieces, stack = [root], [], [root]
    at, end = 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            pieces.append((stack[-1], unescape(html[at:])))
            break
        if m.start() > at:
            pieces.append((stack[-1], unescape(html[at : m.start()])))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        block = tag not in INLINE
        if block:
            pieces.append((None, ""))
        elif tag in ("br", "wbr"):
            pieces.append((stack[-1], " " if tag == "br" else ""))
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if not block and stack[i].tag in _WALLS or tag == "p" and stack[i].tag in _WALLS:
                    break
            continue
        if tag in ("html", "body", "head") and any(x.tag == tag for x in stack[1:]):
            continue
        if tag == "html":
            continue
        if tag == "body":
            del stack[1:]
        if block and tag not in VOID or tag == "hr":
            _end_open(stack, {"p", "h1", "h2", "h3", "h4", "h5", "h6"} if tag[0] == "h" and len(tag) == 2 else {"p"}, _WALLS)
        if tag in _ENDS:
            _end_open(stack, *_ENDS[tag])
        node = Node(tag, stack[-1], m[3])
        nodes.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
            stop = close.start() if close else end
            if tag in ("title", "textarea"):
                pieces.append((node, unescape(html[at:stop])))
            if close is None:
                break
            at = stop
            stack.append(node)
            continue
        stack.append(node)
    pieces.append((None, ""))
    return root, nodes, pieces


def _end_open(stack: list[Node], tags: set[str], walls: set[str]) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in walls:
            return


def _inside(node: Node | None, tags: set[str]) -> Node | None:
    """The outermost of a node and its ancestors that has one of the tags."""
    found = None
    while node is not None:
        if node.tag in tags:
            found = node
        node = node.parent
    return found


def _lengths(nodes: list[Node], pieces: list[tuple[Node | None, str]]) -> dict[int, int]:
    """Characters of text in each node, those of scripts and the like left out."""
    out = dict.fromkeys(map(id, nodes), 0)
    for node, text in pieces:
        if node is not None and node.tag not in NO_TEXT:
            out[id(node)] += sum(map(len, text.split()))
    for node in reversed(nodes[1:]):
        if node.tag not in NO_TEXT:
            out[id(node.parent)] += out[id(node)]
    return out


def _named_furniture(node: Node, length: int, whole: int) -> bool:
    """Whether a name says so. A name that tells of a part inside ("has-sidebar") doesn't, nor does any but a
    comment's say it of most of the page."""
    if not node.names & NO_ARTICLE or node.names & {"has", "with", "no", "without"}:
        return False
    return bool(node.names & _COMMENTS) or node.tag != "article" and 2 * length <= whole


def _drop_furniture(nodes: list[Node], pieces: list[tuple[Node | None, str]]) -> None:
    """Marks elements, with all inside them, that by their purpose or name are not the article."""
    lengths = _lengths(nodes, pieces)
    holds_article: set[int] = set()
    for node in nodes:
        if node.tag in ("article", "main", "h1") and not node.names & _COMMENTS:
            above = node.parent
            while above is not None and id(above) not in holds_article:
                holds_article.add(id(above))
                above = above.parent
    for node in nodes[1:]:
        if node.parent.dropped or node.hidden or node.tag in NO_TEXT:
            node.dropped = True
        elif node.tag in ("body", "main") or id(node) in holds_article and node.tag != "header":
            continue
        elif _named_furniture(node, lengths[id(node)], lengths[id(nodes[0])]):
            node.dropped = True
        elif (node.tag == "header" or node.names & PAGE_HEAD) and not _inside(node.parent, {"article", "main"}):
            node.dropped = True


def _measure(nodes: list[Node], pieces: list[tuple[Node | None, str]]) -> None:
    """Text densities: characters per tag, less where the characters or tags are those of links."""
    for node, text in pieces:
        if node is not None and not node.dropped:
            node.chars += sum(map(len, text.split()))
    for node in reversed(nodes):
        if node.dropped:
            continue
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
        above = node.parent
        if above is not None:
            above.chars += node.chars
            above.tags += node.tags + 1
            above.link_chars += node.link_chars
            above.link_tags += node.link_tags + (node.tag == "a")
    root = nodes[0]
    page_share = root.link_chars / max(root.chars, 1)
    for node in reversed(nodes):
        if node.dropped or not node.chars:
            continue
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
        node.density = c / t
        base = log(c / max(c - lc, 1) * lc + page_share * c + e)
        if base > 1 + 1e-9:
            node.density *= max(log(c / max(lc, 1) * t / max(lt, 1)), 0.0) / log(base)
        if not node.total:
            node.total = node.density
        if node.parent is not None:
            node.parent.total += node.density


def _contents(nodes: list[Node]) -> list[Node]:
    """The subtrees that are the article.

    The node with the greatest sum of its children's densities is the heart of the page, and
    the least density on the way from it up to the body is the threshold. From the body down, every node
    that reaches the threshold gives its subtree with the greatest sum. What was chosen inside an article
    element is completed to that element, and if all of it lies in a main element, to that (see `_whole`).
    """
    living = [n for n in nodes if not n.dropped and n.chars]
    if not living:
        return []
    heart = max(living, key=lambda n: n.total)
    threshold, node = heart.density, heart
    while node is not None and node.tag != "html":
        threshold = min(threshold, node.density)
        node = node.parent
    best: dict[int, Node] = {}
    for n in reversed(living):
        top = best.setdefault(id(n), n)
        if n.total > top.total or n.total == top.total:
            top = best[id(n)] = n
        above = n.parent
        if above is not None and (id(above) not in best or top.total > best[id(above)].total):
            best[id(above)] = top
    chosen: set[int] = set()
    out: list[Node] = []
    waiting = [n for n in living if n.tag == "body"] or [nodes[0]]
    while waiting:
        n = waiting.pop()
        if n.dropped or not n.chars or n.density < threshold:
            continue
        top = best[id(n)]
        if id(top) not in chosen:
            chosen.add(id(top))
            out.append(top)
        waiting += [] if top is n else n.children
    return _whole(out or [heart])


def _whole(tops: list[Node]) -> list[Node]:
    """The chosen subtrees, each completed to the article around it, or all of them to the main element around all.

    A subtree around an article is the article alone if all the rest of its text is named as furniture.
    """
    articles = [_inside(n, {"article"}) for n in tops]
    mains = [_inside(n, {"main"}) for n in tops]
    if not any(articles) and all(mains) and len(set(map(id, mains))) == 1:
        return mains[:1]
    return [article or _bare(n) for n, article in zip(tops, articles)]


def _bare(top: Node) -> Node:
    """The only article or main element in a subtree, if there is no other text but in named furniture; else the subtree."""
    inner, waiting = [], [top]
    while waiting:
        n = waiting.pop()
        if n.tag in ("article", "main"):
            inner.append(n)
        elif n is top or not n.names & NO_ARTICLE:
            living = [c for c in n.children if not c.dropped and c.chars]
            if n.chars > sum(c.chars for c in living):
                return top
            waiting += living
    return inner[0] if len(inner) == 1 else top


def main_text(html: str | None) -> str:
    """The article of a page as plain text: blocks in page order, one space apart."""
    if not html:
        return ""
    _, nodes, pieces = parse(html)
    _drop_furniture(nodes, pieces)
    _measure(nodes, pieces)
    tops = {id(n) for n in _contents(nodes)}
    kept: set[int] = set()
    for node in nodes:
        if not node.dropped and (id(node) in tops or node.parent is not None and id(node.parent) in kept):
            kept.add(id(node))
    blocks: list[str] = []
    block: list[str] = []
    for node, text in pieces:
        if node is None:
            if words := "".join(block).split():
                blocks.append(" ".join(words))
            block = []
        elif id(node) in kept:
            block.append(text)
    return " ".join(blocks)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page (page_id, url, html).

    Elements that by tag, role or name are menus, page headers, footers, sidebars, notices, adverts,
    forms, scripts, styles or comments are taken out. Over what is left, the composite density of
    every node is its characters per tag, lowered by links; a node's children's densities are summed,
    and the greatest sum marks the article (see `_contents`). Character references are decoded,
    white space in a block becomes one space, blocks are joined by one space.

    A null or empty page, or one without text, has an empty text. Cut-off pages give what is there.
    Pages are handled one by one, repeated or not; other columns are not read.
    """

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"]]
            yield pd.DataFrame(
                {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    rows = in_small_batches(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInPandas(over, "page_id long, url string, text string, n_chars long")
