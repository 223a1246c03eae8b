"""Main text of web pages by tree scoring: paragraphs pass points to their ancestors, link density takes them away."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heightgrid.llm.text import batch_of

#: How elements behave in a page, by the public HTML rules.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside menu dialog form button select option textarea input fieldset iframe object embed svg math canvas audio video map xmp noembed noframes".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
#: Names of classes, ids and roles that tell page furniture and reader comments from text.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|masthead|menu|modal|nav\w*|newsletter|notice|pager|pagination|"
    r"popup|promo\w*|related|replies|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget|contentinfo|complementary|navigation|search)(?:$|[\s_-])",
    re.I,
)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text)(?:$|[\s_-])", re.I)

_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|itemprop)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_STYLE_NONE = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: Node | None
    named: str = ""
    dropped: bool = False
    children: list[Node | str] = field(default_factory=list)
    points: float = 0.0
    chars: int = 0
    link_chars: int = 0
    scored: bool = False


def _named(attributes: str) -> tuple[str, bool]:
    if "=" not in attributes and "hidden" not in attributes:
        return "", False
    names, hidden = [], bool(_STYLE_NONE.search(attributes)) and "style" in attributes
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif key in ("class", "id", "role", "itemprop"):
            names.append(value)
    return " ".join(names), hidden


def parse(page: str) -> Node:
    """A tree of elements and texts from tags in order; open paragraphs and items end where the rules say so."""
    root = here = Node("#root", None)
    open_: dict[str, int] = {}
    at, n = 0, len(page)
    for_raw: dict[str, re.Pattern] = {}
    search = _TAG.search
    while at < n:
        m = search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_.get(tag):  # an end tag of nothing that is open is passed over at once
                here = _left(here, _close(here, tag), open_)
            continue
        here = _left(here, _make_room(here, tag), open_)
        named, hidden = _named(m[3])
        node = Node(tag, here, named, hidden or tag in DROPPED or here.dropped)
        here.children.append(node)
        if tag in RAW:
            end = for_raw.setdefault(tag, re.compile(rf"</{tag}\s*[^>]*(?:>|$)", re.I)).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID:
            here = node  # a slash does not close an ordinary element
            open_[tag] = open_.get(tag, 0) + 1
    return root


def _left(here: Node, to: Node, open_: dict[str, int]) -> Node:
    """Step out from ``here`` to its ancestor ``to``; the elements on the way are no longer open."""
    while here is not to:
        open_[here.tag] -= 1
        here = here.parent
    return to


def _close(here: Node, tag: str) -> Node:
    node = here
    while node.parent is not None:
        if node.tag == tag:
            return node.parent
        if tag in INLINE and node.tag not in INLINE:
            return here  # an inline end tag does not close a block
        node = node.parent
    return here


def _make_room(here: Node, tag: str) -> Node:
    """End what the new element ends: a paragraph before a block, an item before the next one."""
    if tag in ENDS_P:
        node = here
        while node.parent is not None and (node.tag in INLINE or node.tag == "p"):
            if node.tag == "p":
                return node.parent
            node = node.parent
    elif tag in ENDS_SAME:
        node = here
        while node.parent is not None and node.tag not in SCOPES[tag]:
            if node.tag in ENDS_SAME[tag]:
                return node.parent
            node = node.parent
    return here


def clean(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


def _measure(node: Node, in_link: bool = False) -> None:
    """Characters of text and of link text below each node, children first, without recursion."""
    order, stack = [], [node]
    while stack:
        x = stack.pop()
        order.append(x)
        stack += [c for c in x.children if not isinstance(c, str)]
    for x in reversed(order):
        if x.dropped or (x.named and x.tag not in ("body", "html", "article", "main") and UNLIKELY.search(x.named) and not LIKELY.search(x.named)):
            x.dropped = True
            x.chars = x.link_chars = 0
            continue
        for c in x.children:
            if isinstance(c, str):
                x.chars += len(c) if not c.isspace() else 0
            else:
                x.chars += c.chars
                x.link_chars += c.chars if c.tag == "a" else c.link_chars


def link_density(node: Node) -> float:
    return node.link_chars / node.chars if node.chars else 0.0


_START = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "form": -3.0}
_PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6".split())


def _score(root: Node) -> list[Node]:
    """Give every ancestor its points; returns the ancestors that have any, in page order.

    A paragraph passes its points to its parent whole, to the next ancestor by half, and by two thirds less from each
    to the next. Lengths, commas and points are summed from the leaves up, so every node is visited once each way.
    """
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        if not x.dropped:
            order.append(x)
            stack += [c for c in reversed(x.children) if not isinstance(c, str)]
    size: dict[int, tuple[int, int]] = {}
    own: dict[int, float] = {}
    passed: dict[int, tuple[float, float]] = {}
    for x in reversed(order):
        chars = commas = 0
        near = far = 0.0
        words = False
        for c in x.children:
            if isinstance(c, str):
                text = clean(c)
                words |= bool(text)
                chars, commas = chars + len(text) + (c[:1].isspace() and bool(text)), commas + text.count(",") + text.count("、")
            elif not c.dropped:
                chars, commas = chars + size[id(c)][0], commas + size[id(c)][1]
                below = passed[id(c)]
                near, far = near + own[id(c)], far + below[0] / 2 + below[1] * 2 / 3
        size[id(x)], passed[id(x)] = (chars, commas), (near, far)
        block = chars > 0 and (x.tag in _PARAGRAPHS or (x.tag in ("div", "section") and words))
        own[id(x)] = 1 + commas + min(chars // 100, 3) if block else 0.0
    found: list[Node] = []
    for x in order:
        up = x.parent if own[id(x)] else None
        while up is not None and up.tag != "#root" and not up.scored:
            up.scored = True
            up.points = sum(passed[id(up)]) + _START.get(up.tag, 0.0) + (25.0 if LIKELY.search(up.named) else 0.0)
            found.append(up)
            up = up.parent
    return found


def _blocks(node: Node, out: list[str]) -> None:
    """Texts of all blocks below a node in page order; inline elements and texts beside them belong to one block."""
    held: list[str] = []

    def flush() -> None:
        text = clean("".join(held))
        held.clear()
        if text:
            out.append(text)

    stack: list[object] = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif x.dropped:
            continue
        elif x.tag == "br":
            held.append(" ")
        elif x.tag in INLINE:
            stack += reversed(x.children)
        else:
            flush()
            stack.append(None)
            stack += reversed(x.children)
    flush()


def _container(best: Node) -> Node:
    """The article around the best node: the nearest article or main element, or else as far up as what stands beside it is text and not links."""
    node = best
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    if node is not None:
        return node
    node = best
    while node.parent is not None and node.parent.tag not in ("body", "html", "#root"):
        up = node.parent
        beside, links = up.chars - node.chars, up.link_chars - node.link_chars
        if links > 0.25 * beside:
            break
        node = up
    return node


def _drop_links(container: Node, best: Node) -> None:
    """Drop the blocks of links that stand beside the best node on its way up to the container."""
    node = best
    while node is not container:
        for c in node.parent.children:
            if not isinstance(c, str) and c is not node and c.tag not in INLINE and link_density(c) > 0.5:
                c.dropped = True
        node = node.parent


def main_text(page: str) -> str:
    """The article around the best node and those siblings of it that also hold text, as blocks joined by line feeds.

    The best node has the most points after the discount for link density; ties go to the first in the page. All
    text of the article around it stays but furniture and blocks of links. Outside an article or main element a sibling
    is kept if its own discounted points reach a fifth of the best node's, or if it is text with few links. A page
    without any paragraph gives the text of its body.
    """
    root = parse(page)
    _measure(root)
    found = _score(root)
    if not found:
        out: list[str] = []
        _blocks(root, out)
        return "\n".join(out)
    final = {id(x): x.points * (1 - link_density(x)) for x in found}
    best = max(found, key=lambda x: final[id(x)])
    whole = _container(best)
    _drop_links(whole, best)
    out = []
    if whole.tag in ("article", "main") or whole.parent is None or whole.parent.tag in ("html", "#root"):
        _blocks(whole, out)
        return "\n".join(out)
    limit = max(10.0, final[id(best)] * 0.2)
    for x in whole.parent.children:
        if isinstance(x, str):
            if text := clean(x):
                out.append(text)
            continue
        if x.dropped:
            continue
        density = link_density(x)
        good = x is whole or final.get(id(x), 0.0) + (0.2 * final[id(best)] if x.named and x.named == whole.named else 0.0) >= limit
        if not good and x.tag in ("p", "h1", "h2", "h3", "pre", "blockquote", "ul", "ol", "dl", "table", "section", "div"):
            short = _text_end(x) if 0 < x.chars <= 80 and density == 0 else ""
            good = (x.chars > 80 and density < 0.25) or (x.tag in ("h1", "h2", "h3") and density == 0 and x.chars > 0) or short.endswith((".", "!", "?"))
        if good:
            _blocks(x, out)
    return "\n".join(out)


def _text_end(node: Node) -> str:
    out: list[str] = []
    _blocks(node, out)
    return out[-1] if out else ""


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; no shuffle, one page at a time.

    Null or empty html, or none of it text: empty text. Null ids and urls and repeated pages stay as they are; further
    columns are not read; an empty table gives an empty one.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                some = batch.slice(a, 256)
                texts = [main_text(h) if h else "" for h in some.column(2).to_pylist()]
                yield batch_of({"page_id": some.column(0), "url": some.column(1), "text": texts, "n_chars": [len(t) for t in texts]}, schema)

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
