"""Main text of web pages by tree scoring.

A page becomes a tree (tolerant of missing end tags).  Elements that are never article text go: scripts, styles, forms,
navigation, headers, footers, sidebars, and those whose class, id or role says advert, notice, menu, comments and so on.
Every paragraph then gives points (one, one per comma, up to three for its length) to its parent, half as much to its
grandparent, a third to the next, and so on.  A container's points are discounted by its link density, the share of its
text inside links.  The best container may be a part of the article only: the outermost article element around it, or
else the outermost main, is kept whole, with those of its siblings that score a fifth of the best container.  Without
such an element (and from a main's only article up to that main) the container is kept with those siblings of it and of
its wrappers that score a fifth of it or are themselves plain text with few links.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from regfuse.llm.common import texts_of

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.DOTALL)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math".split())
_GONE = _RAW | frozenset(
    "head nav header footer aside form button select option optgroup datalist label input object canvas video audio map "
    "dialog menu fieldset legend progress meter".split()
)
_BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html "
    "li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
) | (_GONE - {"label", "button", "select", "option", "input"})
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTENT = frozenset("article main".split())
# opening one of these ends an open element of the listed names, if no element of the third group lies between
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"tbody"}, {"table"}),
}
_SIGNS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner "
    "nav navbar navigation menu menus topbar toolbar breadcrumb breadcrumbs pagination pager sidebar aside rail masthead header "
    "footer colophon cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login share "
    "sharing social comment comments commentlist disqus reply replies respond discussion related recommended widget widgets "
    "search complementary contentinfo alert".split()
)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Node:
    __slots__ = ("tag", "parent", "items", "gone", "points", "chars", "linked")

    def __init__(self, tag: str, parent: _Node | None, gone: bool):
        self.tag, self.parent, self.gone = tag, parent, gone
        self.items: list = []  # strings and nodes, in page order
        self.points, self.chars, self.linked = 0.0, 0, 0


def _is_noise(tag: str, attributes: str) -> bool:
    """By name, or by what class, id or role say."""
    if tag in _GONE:
        return True
    if tag in ("html", "body", *_CONTENT):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role") and any(p.lower() in _SIGNS for v in values for p in _PARTS.findall(v)):
            return True
    return False


def parse(page: str) -> _Node:
    """The tree of a page; text lies in it with character references decoded."""
    root = node = _Node("#", None, False)
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            node.items.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            node.items.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue  # a comment or declaration
        tag = m[2].lower()
        if m[1]:
            up = node
            while up.parent and up.tag != tag and (tag in _BLOCK or up.tag not in _BLOCK):
                up = up.parent
            if up.parent and up.tag == tag:
                node = up.parent
            continue
        if tag in _RAW:
            if not m[3].endswith("/"):
                close = re.compile(f"</{tag}\\s*>", re.IGNORECASE).search(page, at)
                at = close.end() if close else end
            if tag in _BLOCK:
                node.items.append(_Node(tag, node, True))
            continue
        names, fences = _ENDS.get(tag, ({"p"}, set()) if tag in _BLOCK else (set(), set()))
        up = node
        while up.parent and names and up.tag not in fences:
            if up.tag in names:
                node = up.parent
                break
            if tag in _BLOCK and names == {"p"} and up.tag in _BLOCK:
                break
            up = up.parent
        child = _Node(tag, node, node.gone or _is_noise(tag, m[3]))
        node.items.append(child)
        if tag not in _VOID and not m[3].endswith("/"):
            node = child
    return root


def _nodes(root: _Node, leaf: _Node | None = None) -> list[_Node]:
    """All kept elements, parents before children; nothing inside ``leaf``."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        if node is leaf:
            continue
        todo += [x for x in reversed(node.items) if isinstance(x, _Node) and not x.gone]
    return out


def _own_text(node: _Node) -> str:
    """Text of a block up to its inner blocks."""
    parts, todo = [], list(reversed(node.items))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x.tag == "br":
            parts.append(" ")
        elif not x.gone and x.tag not in _BLOCK:
            todo += reversed(x.items)
    return " ".join("".join(parts).split())


def _score(root: _Node) -> list[_Node]:
    nodes = _nodes(root)
    for node in nodes:
        if node.tag in _BLOCK and node.tag not in _HEADING:
            text = _own_text(node)
            if text:
                points, up, depth = 1 + text.count(",") + min(len(text) / 100, 3), node.parent if node.tag != "div" else node, 1
                while up is not None:
                    up.points += points / depth
                    up, depth = up.parent, depth + 1
    for node in reversed(nodes):
        own = sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str))
        inner = [x for x in node.items if isinstance(x, _Node) and not x.gone]
        node.chars = own + sum(x.chars for x in inner)
        node.linked = node.chars if node.tag == "a" else sum(x.linked for x in inner)
    for node in nodes:
        node.points *= (2 if node.tag in _CONTENT else 1) * (1 - _links(node))
    return nodes


def _links(node: _Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def blocks(kept: list[_Node]) -> list[str]:
    """Texts of the blocks of some elements, in page order."""
    out, run = [], []

    def close():
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    todo: list = list(reversed(kept))
    while todo:
        x = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag in _BLOCK:
            close()
            if not x.gone:
                todo += [None, *reversed(x.items)]
        elif not x.gone:
            if x.tag == "br":
                run.append(" ")
            todo += reversed(x.items)
    close()
    return out


def main_text(page: str | None) -> str:
    """The article's text: white space within a block is one space, blocks are joined by line feeds; empty if none."""
    if not page:
        return ""
    root = parse(page)
    best = max(_score(root), key=lambda n: (n.points, n.tag in _CONTENT), default=root)
    if best.points <= 0:
        return "\n".join(blocks([root]))
    top, reach = _article(best)
    before, after, node = deque(), [], top
    while node.parent is not None and node.tag not in ("body", "html") and node is not reach:
        strict = top.tag in _CONTENT and reach is None
        family = [x for x in node.parent.items if isinstance(x, _Node) and (x is node or not x.gone and _belongs(x, best, strict))]
        at = next(i for i, x in enumerate(family) if x is node)
        before.extendleft(reversed(family[:at]))
        after += family[at + 1 :]
        if strict:
            break
        node = node.parent
    return "\n".join(blocks([*before, top, *after]))


def _article(best: _Node) -> tuple[_Node, _Node | None]:
    """The element that holds the whole article of the best container, and the main whose only article it is, if any."""
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    article = next((x for x in reversed(around) if x.tag == "article"), None)
    main = next((x for x in reversed(around) if x.tag == "main"), None)
    if article is None or main is None:
        return article or main or best, None
    alone = not any(x.tag == "article" and x is not article for x in _nodes(main, article))
    return article, main if alone and any(x is main for x in around[around.index(article) :]) else None


def _belongs(x: _Node, best: _Node, strict: bool) -> bool:
    """Whether an element beside the article, or beside a wrapper of it, is taken for a part of it."""
    if x.points >= best.points / 5:
        return True
    return not strict and x.tag in _BLOCK and x.tag not in ("ul", "ol", "table") and x.chars > 0 and _links(x) < 0.25


def _extract(batches):
    for batch in batches:
        texts = [main_text(t.decode("utf-8", "replace") if t else None) for t in texts_of(batch.column("html"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points of the text).

    Null, empty or text-free pages give an empty text; a page without a paragraph gives all its text outside the dropped
    elements.  Pages are independent: repeated rows and null ids are kept as they are, other columns are ignored, an empty
    table gives an empty result.
    """
    pages = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars bigint")
