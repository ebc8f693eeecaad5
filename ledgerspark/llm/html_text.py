"""Main text of web pages by composite text density.

A page becomes a tree of elements. Elements that are never article text are left out first,
with all they contain: by tag (of a header inside an article the headings stay), or by id, class
or role. Such a name counts if it has a listed word and otherwise only words that say nothing
(``user-comments``, but not ``share-price``). Reader comments always go; another element of such a
name stays if it holds most of the page's text outside links, no article stands beside it, and
its name has other words, too, or it holds the article. Every other
node has characters C, tags T, link characters LC and link tags LT below it, and the
density C/T * log_b(C/LC * T/LT) with the base b = ln(C/(C-LC) * LC + LC_body/C_body * C + e),
so links lower it. A node's density sum is that of its children, its own text counting as a
child. The subtree with the largest sum is the article, or the article or main element
around it, or what holds all articles if there are several. Without such an element, its
neighbours on the way to the body join it if they are bare text, headings, paragraphs, lists
or the like that are not mostly links, or if their density meets the threshold: the smallest
density on the path to the body.
"""

from __future__ import annotations

import html
import math
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Elements that hold no article text, and words of id, class or role that say so.
DROPPED_TAGS = frozenset(
    "head nav header footer aside form script style noscript template iframe object embed svg canvas button select option textarea "
    "input label menu dialog audio video map title".split()
)
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar side aside footer foot header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended recommendations pager pagination "
    "toolbar widget widgets complementary contentinfo".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond reactions".split())
# Words that may stand beside a listed one in a name.
NEUTRAL_WORDS = frozenset(
    "area bar blog block bottom box btn button buttons col column container content desktop div fixed form global group home id inner item items js left "
    "link links list main message middle mobile module my outer page panel policy post posts primary reader readers right row secondary section site sticky "
    "the thread threads top ui unit user users view web wrap wrapper".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCK_TAGS = frozenset(
    "address article blockquote body br center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre "
    "section summary table tbody td tfoot th thead tr ul caption".split()
)
_TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre figure table ul ol dl section".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that end an open paragraph, and elements that end an open one of their kind.
_ENDS_PARAGRAPH = BLOCK_TAGS - {"br", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"} | {"nav", "header", "footer", "aside", "form", "menu"}
_ENDS_OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("table td th caption button object article section main nav header footer aside form div ul ol dl blockquote body html".split())
_RAW = frozenset("script style textarea title noscript iframe".split())

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""(?:^|[\s/"'])(?:id|class|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_SPACE = re.compile(r"[\s\x00]+")


class Node:
    __slots__ = ("tag", "parent", "items", "chars", "tags", "link_chars", "link_tags", "density", "total", "best")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.items = tag, parent, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0


def _unwanted(tag: str, attributes: str) -> str:
    """A mark: ``!`` for an element to drop by its tag or as comments, ``?`` for one by
    its name, ``+`` if that has listed words only."""
    if tag in DROPPED_TAGS:
        return "!"
    if not attributes or tag in ("body", "html", "main"):
        return ""
    found = ""
    for value in _NAMED.findall(attributes):
        for name in value.strip("\"'").split():
            words = {part.lower() for part in _PART.findall(name)}
            if words & (DROPPED_WORDS | COMMENT_WORDS) and words <= DROPPED_WORDS | COMMENT_WORDS | NEUTRAL_WORDS:
                if words & COMMENT_WORDS:
                    return "!"
                found = "?" if words & NEUTRAL_WORDS and found != "+" else "+"
    return found


def parse(page: str) -> Node:
    """The tree below the root; an item is a text or a node. Closing tags without an open
    partner are ignored, and what is open at the end is closed there."""
    root = node = Node("#root", None)
    at, lowered = 0, None
    while m := _MARKUP.search(page, at):
        if m.start() > at:
            node.items.append(page[at : m.start()])
        at = m.end()
        if m[2]:
            tag = m[2].lower()
            if tag in _ENDS_PARAGRAPH:
                node = _closed(node, {"p"})
            if tag in _ENDS_OWN_KIND:
                node = _closed(node, _ENDS_OWN_KIND[tag])
            if tag in ("html", "body") and root.items and any(isinstance(x, Node) and x.tag == tag for x in root.items):
                continue
            new = Node(tag + _unwanted(tag, m[3]), node)
            node.items.append(new)
            if tag in _RAW:
                lowered = page.lower() if lowered is None or len(lowered) != len(page) else lowered
                end = lowered.find(f"</{tag}", at)
                if end < 0 and tag == "title":
                    continue
                new.items.append(page[at : end if end >= 0 else len(page)])
                close = page.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else len(page)
            elif tag not in VOID_TAGS and not m[3].rstrip().endswith("/"):
                node = new
        elif m[1]:
            tag, up = m[1].lower(), node
            while up and up.tag.rstrip("!?+") != tag:
                up = up.parent
            if up:
                node = up.parent
    if at < len(page):
        node.items.append(page[at:])
    return root


def _closed(node: Node, kinds: set[str]) -> Node:
    """The node to go on in after an open element of ``kinds`` in the same scope is ended."""
    up = node
    while up and up.tag.rstrip("!?+") not in kinds:
        if up.tag.rstrip("!?+") in _SCOPES:
            return node
        up = up.parent
    return up.parent if up else node


def _ordered(root: Node) -> list[Node]:
    """All wanted nodes, parents first."""
    nodes = _below(root, "!")
    if not any(x.tag[-1] in "?+" for x in nodes):
        return nodes
    plain: dict[int, int] = {}
    inside: dict[int, int] = {}
    above = {id(root): 0}
    for node in reversed(nodes):
        below = [x for x in node.items if isinstance(x, Node)]
        own = sum(len("".join(x.split())) for x in node.items if isinstance(x, str)) + sum(plain[id(x)] for x in below)
        plain[id(node)] = 0 if node.tag.rstrip("?+") == "a" else own
        inside[id(node)] = sum(inside[id(x)] for x in below) + (node.tag in ("article", "main") and own > 0)
    for node in nodes[1:]:
        up = node.parent
        above[id(node)] = above[id(up)] + (up.tag in ("article", "main") and plain[id(up)] > 0)
    for node in nodes:
        # No article stands beside a node if all are inside it or around it.
        alone = inside[id(node)] + above[id(node)] == inside[id(root)]
        if node.tag[-1] in "?+":
            kept = 2 * plain[id(node)] > plain[id(root)] and alone and (node.tag[-1] == "?" or inside[id(node)])
            node.tag = node.tag[:-1] + ("" if kept else "?")
    return _below(root, "?")


def _below(root: Node, mark: str) -> list[Node]:
    """Nodes without the marked ones, parents first."""
    found, articles = [root], {id(root): False}
    for node in found:
        held = articles[id(node)] or node.tag == "article"
        items: list[Node | str] = []
        for x in node.items:
            if not isinstance(x, Node) or x.tag[-1] != mark:
                items.append(x)
            elif held and x.tag == "header!":
                items += _titles(x, node)
        node.items = items
        for x in items:
            if isinstance(x, Node):
                articles[id(x)] = held
                found.append(x)
    return found


def _titles(header: Node, up: Node) -> list[Node]:
    """The headings of a header, which then belong to ``up``."""
    found, open_nodes = [], [header]
    while open_nodes:
        node = open_nodes.pop()
        if node.tag in _HEADINGS:
            node.parent = up
            found.append(node)
        elif node is header or node.tag[-1] not in "!?+":
            open_nodes += [x for x in reversed(node.items) if isinstance(x, Node)]
    return found


def _density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    if not chars:
        return 0.0
    tags, plain = max(tags, 1), max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + ratio * chars + math.e)
    inner = chars / max(link_chars, 1) * tags / max(link_tags, 1)
    return max(0.0, chars / tags * math.log(max(inner, 1.0)) / max(base, 1e-9))


def measure(root: Node) -> list[Node]:
    """Fill in counts, densities and sums; returns all wanted nodes, parents first."""
    nodes = _ordered(root)
    for node in reversed(nodes):
        own = sum(len("".join(x.split())) for x in node.items if isinstance(x, str))
        node.chars += own
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if up := node.parent:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    ratio = root.link_chars / root.chars if root.chars else 0.0
    for node in reversed(nodes):
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
        below = [x for x in node.items if isinstance(x, Node)]
        own = node.chars - sum(x.chars for x in below)
        node.total = sum(x.density for x in below) + _density(own, 1, own if node.tag == "a" else 0, int(node.tag == "a"), ratio)
        node.best = max([node, *(x.best for x in below)], key=lambda x: x.total)
    return nodes


def _blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks of ``nodes`` in page order, white space made single, none empty."""
    blocks, current = [], []

    def end() -> None:
        if text := _SPACE.sub(" ", html.unescape("".join(current))).strip():
            blocks.append(text)
        current.clear()

    for top in nodes:
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                current.append(item)
            elif item.tag in BLOCK_TAGS or item is top:
                end()
                stack += [None, *reversed(item.items)]
            else:
                stack += reversed(item.items)
        end()
    return blocks


def _path(node: Node) -> list[Node]:
    path = [node]
    while path[-1].parent:
        path.append(path[-1].parent)
    return path


def _chosen(root: Node, nodes: list[Node]) -> list[Node]:
    """The subtrees that make up the article, in page order."""
    best = root.best
    path = _path(best)
    for node in path:
        if node.tag in ("article", "main"):
            return [_around(node, nodes)]
    held = {id(best)}
    tops = []
    for node in nodes:  # outermost articles inside the best subtree
        if id(node.parent) in held or node is best:
            if node.tag in ("article", "main") and 2 * node.link_chars <= node.chars:
                tops.append(node)
            else:
                held.add(id(node))
    if tops and 2 * sum(x.chars for x in tops) > best.chars:
        return [_around(tops[0], nodes)]
    threshold = min(node.density for node in path if node.tag not in ("html", "#root")) if best.tag not in ("html", "#root") else 0.0
    before: list[Node] = []
    after: list[Node] = []
    for below, up in zip(path, path[1:]):
        at = up.items.index(below)
        before = _beside(up.items[:at], threshold) + before
        after += _beside(up.items[at + 1 :], threshold)
    return [*before, best, *after]


def _around(node: Node, nodes: list[Node]) -> Node:
    """``node``, or the smallest node around it and all articles that are not mostly links."""
    if node.tag == "main":
        return node
    common = _path(node)
    for other in nodes:
        if other.tag == "article" and other.chars and 2 * other.link_chars <= other.chars:
            around = {id(x) for x in _path(other)}
            common = [x for x in common if id(x) in around]
    return common[0]


def _beside(items: list[Node | str], threshold: float) -> list[Node]:
    """Neighbours that belong to the article; bare text and inline elements in a row are one."""
    out: list[Node] = []
    run: Node | None = None
    for item in items:
        if isinstance(item, Node) and item.tag in BLOCK_TAGS:
            run = None
            if _belongs(item, threshold):
                out.append(item)
            continue
        if run is None:
            out.append(run := Node("#text", None))
        run.items.append(item)
        run.chars += len("".join(item.split())) if isinstance(item, str) else item.chars
        run.link_chars += 0 if isinstance(item, str) else item.link_chars
    return [x for x in out if x.tag != "#text" or x.chars and 2 * x.link_chars <= x.chars]


def _belongs(node: Node, threshold: float) -> bool:
    text_like = node.tag in _TEXT_TAGS and 2 * node.link_chars <= node.chars
    return node.chars > 0 and (node.density >= threshold or text_like)


def main_text(page: str | None) -> str:
    """Main text of a page, one block a line; empty for null, empty or text-free pages."""
    root = parse(page or "")
    nodes = measure(root)
    return "\n".join(_blocks(_chosen(root, nodes))) if root.chars else ""


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` and ``n_chars``. Repeated rows and
    null ids stay; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
