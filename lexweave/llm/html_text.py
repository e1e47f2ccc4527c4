"""Main text of web pages by composite text density.

A page becomes a tree of its tags, by a tolerant reading: unclosed tags close with their
parents, and the start of a block closes an open paragraph. One pass reads it: a tag ends at the
first > outside quotes, or, once quotes were found that never close, at the first >; below
``DEPTH`` levels tags stand side by side, as in browsers.

Every node has a density: its characters per tag, adjusted by a logarithm
whose argument falls and whose base rises with the share of link text, relative to that of the
body. The node whose children have the greatest sum of densities holds the main text; a paragraph
or a piece of one stands for the block around it, and a node within an article or main element
for that element. The least density on its path up to the body is the threshold: subtrees at or over it that
stand elsewhere are searched for their own greatest sum in the same way, so that a text
in several places is kept whole; where the main text is made of paragraphs, so must they be. A
heading right before a node of the main text belongs to it. Within the main text, lists that are
links nearly throughout are menus, and go with a heading of their own.

Scripts, styles, form controls and the like hold no text and are never read. Menus,
sidebars, footers and the like, known by tag, role or class, stay out of the densities, unless there
is an article or main element in them, they hold ``MOST`` of the page's text, or nothing else
has text. A class counts by its whole name, or by its first or last word if no word
(``has``, ``no``, ``open`` ...) makes it a property of something else.

White space inside a block becomes one space, blocks are trimmed and joined in page order
by a line feed; character references are decoded.

Edge cases: a null or empty page, or one without text, gives an empty text. A page without
a body tag is read as if all of it were the body; one that breaks off inside a tag ends there.
Very long pages are read whole, in time that grows with their length. Repeated rows are read each for
itself; an empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import batch_of, lean

DEPTH, MOST = 512, 0.9
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^>\"']*+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}\b", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template")}
_BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_PARAGRAPHS = frozenset(("p", "pre", "blockquote"))
#: What may hold a main text; all other tags are parts of a text.
_CONTAINERS = frozenset("article body center details div dl form main ol section table tbody td tr ul".split())
_NO_TEXT = frozenset("head script style noscript template iframe object embed svg canvas button select option textarea input".split())
_ASIDE = frozenset("nav aside footer header form label dialog menu fieldset".split())
#: Words of classes and ids, and of roles, that mark what is not main text.
_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer masthead ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion promotions banner "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "comment comments commentlist respond replies disqus widget widgets pagination pager toolbar skiplink copyright".split()
)
_QUALIFIED = frozenset("has no not with without is open closed enabled disabled layout page post hentry template theme".split())
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar alert dialog".split())
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("table td th ul ol dl article section main div body html aside nav footer header form blockquote".split())


@dataclass(slots=True)
class Node:
    tag: str
    parent: Node | None = None
    depth: int = 0
    place: int = 0  # among the parent's children
    children: list = field(default_factory=list)  # nodes and texts
    skip: bool = False
    aside: bool = False
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    paragraphs: int = 0
    density: float = 0.0
    sum: float = 0.0
    best: Node | None = None
    content: bool = False

    def nodes(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and not c.skip]


def _marked(names: str) -> bool:
    """Whether a class or id says that its element is beside the main text."""
    for name in names.lower().split():
        words = re.split(r"[-_]+", name)
        if (words[0] in _WORDS or words[-1] in _WORDS) and not _QUALIFIED.intersection(words):
            return True
    return False


def _stands_aside(tag: str, attributes: str, parent: Node) -> tuple[bool, bool]:
    """Whether an element is never read, and whether it seems to be beside the main text."""
    if tag in _NO_TEXT:
        return True, False
    aside = tag in _ASIDE
    if tag == "header":
        node: Node | None = parent
        while node is not None and aside:
            aside, node = node.tag not in ("article", "main"), node.parent
    if attributes and tag not in ("html", "body", "article", "main"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" and value.lower() != "false" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
                return True, False
            aside |= name in ("class", "id") and _marked(value) or name == "role" and value.lower() in _ROLES
    return False, aside


class _Reader:
    """Where tags end. Quotes count until one is met that nothing closes."""

    def __init__(self, page: str):
        self.page, self.quotes = page, True

    def end(self, pos: int) -> int:
        """The place of the > that ends the tag which is open at pos, or -1."""
        at = pos
        while self.quotes:
            at = _PLAIN.match(self.page, at).end()
            if at < len(self.page) and self.page[at] == ">":
                return at
            close = self.page.find(self.page[at], at + 1) if at < len(self.page) else -1
            if close < 0:
                self.quotes = False
            at = close + 1
        return self.page.find(">", pos)


def parse(page: str) -> Node:
    """The tree of a page; its root stands for the body."""
    root = Node("body")
    at, pos, n, reader = root, 0, len(page), _Reader(page)
    while pos < n:
        if page[pos] != "<":
            stop = page.find("<", pos)
            stop = n if stop < 0 else stop
            at.children.append(page[pos:stop])
            pos = stop
            continue
        if page.startswith("<!--", pos):
            stop = page.find("-->", pos + 4)
            pos = n if stop < 0 else stop + 3
            continue
        if page.startswith(("<!", "<?"), pos):
            stop = page.find(">", pos)
            pos = n if stop < 0 else stop + 1
            continue
        m = _OPEN.match(page, pos)
        if m is None:
            at.children.append("<")
            pos += 1
            continue
        stop = reader.end(m.end())
        if stop < 0:  # a tag that the page cuts off
            break
        pos, tag, attributes = stop + 1, m[2].lower(), page[m.end() : stop]
        if m[1]:
            node: Node | None = at
            while node is not None and node.tag != tag:
                node = None if tag not in _SCOPE and node.tag in _SCOPE else node.parent
            if node is not None and node.parent is not None:
                at = node.parent
            elif tag == "p":
                at.children.append(Node("br", at, at.depth + 1, len(at.children)))
            continue
        if tag in ("html", "body"):
            continue
        close = _CLOSES.get(tag) or (("p",) if tag in _BLOCKS and tag != "br" else ())
        if close:
            node, last = at, None
            while node is not None and node.tag not in _SCOPE - set(close):
                if node.tag in close:
                    last = node
                node = node.parent
            if last is not None and last.parent is not None:
                at = last.parent
        new = Node(tag, at, at.depth + 1, len(at.children))
        new.skip, new.aside = _stands_aside(tag, attributes, at)
        at.children.append(new)
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCKS:
            continue
        if tag in _RAW:
            new.skip = True
            end = _RAW[tag].search(page, pos)
            stop = page.find(">", end.start()) if end else -1
            pos = n if stop < 0 else stop + 1
            continue
        if new.depth < DEPTH:
            at = new
    return root


def _ordered(root: Node) -> list[Node]:
    """All nodes that are read, parents before children."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += reversed(node.nodes())
    return order


def _count(order: list[Node]) -> None:
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.paragraphs = int(node.tag in _PARAGRAPHS)
        for c in node.children:
            if isinstance(c, str):
                node.chars += len("".join(html.unescape(c).split()))
            elif not c.skip:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags + (c.tag == "a")
                node.paragraphs += c.paragraphs
        if node.tag == "a":
            node.link_chars = node.chars


def _set_aside(root: Node) -> None:
    """Skips what stands beside the main text, where that leaves some."""
    order = _ordered(root)
    _count(order)
    whole = {id(root)}
    for node in order:
        if node.tag in ("article", "main"):
            up: Node | None = node
            while up is not None and id(up) not in whole:
                whole.add(id(up))
                up = up.parent
    found = [n for n in order if n.aside and id(n) not in whole and n.chars < MOST * root.chars]
    for node in found:
        node.skip = True
    _count(_ordered(root))
    if not root.chars:
        for node in found:
            node.skip = False


def density(node: Node, share: float) -> float:
    """Characters per tag, less the more of them are in links than a share that the page has."""
    if not node.chars:
        return 0.0
    links, tags = max(node.link_chars, 1), max(node.tags, 1)
    base = math.log(node.chars * node.link_chars / max(node.chars - node.link_chars, 1) + share * node.chars + math.e)
    inner = max(node.chars / links * tags / max(node.link_tags, 1), 1.0)
    return node.chars / tags * math.log(inner) / base


def _measure(root: Node) -> None:
    """Counts, densities, their sums over children, and the greatest sum below each node (the first of equal ones)."""
    order = _ordered(root)
    _count(order)
    share = root.link_chars / root.chars if root.chars else 0.0
    for node in reversed(order):
        own = node.nodes()
        node.density = density(node, share)
        node.sum = math.fsum(c.density for c in own) if own else node.density
        node.best = node
        for c in own:
            if c.best.sum > node.best.sum:
                node.best = c.best


def _stood_for(node: Node) -> Node:
    """The article or main element around a node, or the nearest block that may hold a text."""
    up: Node | None = node
    while up is not None:
        if up.tag in ("article", "main"):
            return up
        up = up.parent
    while node.tag not in _CONTAINERS and node.parent is not None:
        node = node.parent
    return node


def _beside(node: Node, step: int) -> Node | None:
    """The element next to a node with nothing but white space between."""
    own = node.parent.children if node.parent else [node]
    i = node.place + step
    while 0 <= i < len(own):
        c = own[i]
        if isinstance(c, Node) and (c.skip or c.chars):
            return None if c.skip else c
        if isinstance(c, str) and c.strip():
            return None
        i += step
    return None


def _drop_menus(top: Node) -> None:
    """Leaves out lists within the main text that are links nearly throughout, and headings that have nothing else."""
    for node in _ordered(top)[1:]:
        if node.tag in ("ul", "ol", "div", "section", "dl") and node.link_tags >= 3 and node.link_chars >= 0.8 * node.chars and not node.skip:
            before, after = _beside(node, -1), _beside(node, 1)
            if before is not None and before.tag in _HEADINGS - {"h1"} and (after is None or after.tag in _HEADINGS):
                before.skip = True
            node.skip = True


def select(root: Node) -> None:
    """Marks the nodes that hold the main text."""
    _set_aside(root)
    _measure(root)
    if not root.chars:
        return
    best = root.best
    threshold, up = best.density, best.parent
    while up is not None:
        threshold, up = min(threshold, up.density), up.parent
    held = _stood_for(best)
    like = lambda node: node.paragraphs > 0 or not held.paragraphs
    chosen = []
    if held is root:  # the text stands in the body itself, with whatever else stands there
        parts = [c for c in root.nodes() if c.chars and c.tag in _CONTAINERS]
        chosen = [c for c in parts if like(c) and c.density >= threshold] or [c for c in parts if like(c)]
        loose = any(c.chars and c.tag not in _CONTAINERS for c in root.nodes()) or any(isinstance(c, str) and c.strip() for c in root.children)
        if loose or not chosen:
            chosen = [root]
    else:
        chosen = [held]
    above: set[int] = set()

    def mark(node: Node) -> None:
        node.content, up = True, node
        while up is not None and id(up) not in above:
            above.add(id(up))
            up = up.parent

    for node in chosen:
        mark(node)
    todo = [root]
    while todo:
        node = todo.pop()
        if node.content:
            continue
        for c in node.nodes():
            if not c.content and c.chars and c.density >= threshold and c.density > 0 and like(c) and c.best.link_chars * 2 < c.best.chars:
                found = _stood_for(c.best)
                path: Node | None = found
                while path is not None and not path.content:
                    path = path.parent
                if path is None and found is not root and like(found) and id(found) not in above:
                    mark(found)
                    chosen.append(found)
        todo += node.nodes()
    for node in chosen:
        _drop_menus(node)
        title = _beside(node, -1) if node is not root else None
        if title is not None and title.tag in _HEADINGS:
            title.content = True


def _blocks(root: Node) -> Iterator[str]:
    """The marked text in page order, block by block."""
    run: list[str] = []

    def flush() -> Iterator[str]:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            yield text

    todo: list = [(root, False)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            yield from flush()
        elif isinstance(item, str):
            if inside:
                run.append(item)
        elif not item.skip:
            inside = inside or item.content
            block = item.tag in _BLOCKS
            if block:
                yield from flush()
                todo.append((None, inside))
            todo += [(c, inside) for c in reversed(item.children)]
    yield from flush()


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks joined by a line feed."""
    root = parse(page or "")
    select(root)
    return "\n".join(_blocks(root))


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t) for t in batch.column(2).to_pylist()]
            yield batch_of(_OUT, batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, map(len, texts))

    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return slim.mapInArrow(lean(run), "page_id long, url string, text string, n_chars long")
