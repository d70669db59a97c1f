"""Main text of HTML pages by composite text density.

Every DOM node gets its characters per tag, adjusted for links; a node's sum is that of its children's
densities. The node with the largest sum holds the article. The smallest density on its way up to the body is
the threshold that other subtrees have to reach to count as content too. Parts that name themselves as
something else (menus, forms, adverts, comments ...) are cut before densities are taken.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpuslens.llm.common import arrow_schema, slices, utf8

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"(?:^|\s)(class|id|role|aria-hidden|hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
DROPPED = frozenset(
    "script style noscript template head nav footer aside form button select textarea option input iframe svg canvas object audio video dialog menu map title datalist".split()
)
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: What a start tag closes, if open and not behind a table or list boundary.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"},
}
FENCE = frozenset("ul ol dl table div article section main body html blockquote aside nav footer form".split())
#: Words of class, id or role that name a part which is not the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored nav navbar navigation menu menubar submenu breadcrumb "
    "breadcrumbs sidebar sidebars aside complementary rail footer contentinfo masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup "
    "modal overlay dialog newsletter subscribe subscription signup login register search comment comments disqus replies reply respond responses share sharing social "
    "related recommended recommendations pagination pager widget widgets skip copyright legal disclaimer paywall toc hidden offscreen tagcloud teaser".split()
)
#: Of these, words that also name subjects of an article: a box so named stays if most of the page's plain text is in it.
AMBIGUOUS = frozenset("legal copyright disclaimer search social notice notices alert register response share sharing skip banner overlay hidden teaser".split())
#: The same for article elements, whose other names say what stands beside them.
ARTICLE_HINTS = frozenset("ad ads advert comment comments reply promo related teaser sponsored".split())
PARTS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: A subtree outside the article's needs this part of the largest density sum to count as content.
SIDE_SHARE = 0.3
#: A box of the article has a smaller part of its characters in links.
LINK_SHARE = 0.3
#: Lists and boxes with this part of their characters in links are menus.
MENU_SHARE = 0.6


class Node:
    __slots__ = ("tag", "hint", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "core")

    def __init__(self, tag: str, hint: str, parent: Node | None):
        self.tag, self.hint, self.parent = tag, hint, parent
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.core = False  # holds an article or its heading: then no class name makes it something else


def hinted(tag: str, attrs: str) -> str:
    """Whether a start tag names its element as something else than the article: "no", "maybe" or "yes"."""
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return "no"
    hint = "no"
    for match in NAMED.finditer(attrs):
        name, value = match[1].lower(), (match[2] or "").strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "yes"
        if name == "style":
            if "display:none" in value.replace(" ", "").lower():
                return "yes"
        elif tag not in ("html", "body", "main"):
            named = (ARTICLE_HINTS if tag == "article" else HINTS).intersection(PARTS.findall(CAMEL.sub("-", value).lower()))
            if named - AMBIGUOUS:
                return "yes"
            if named:
                hint = "maybe"
    return hint


class Open:
    """The open elements, with the places of each tag among them: a look costs no walk through all of them."""

    def __init__(self, root: Node):
        self.path: list[Node] = []
        self.places: dict[str, list[int]] = {}
        self.fences: list[int] = []
        self.push(root)

    @property
    def here(self) -> Node:
        return self.path[-1]

    def push(self, node: Node) -> None:
        at = len(self.path)
        self.path.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in FENCE:
            self.fences.append(at)

    def cut(self, size: int) -> None:
        """Close all but the first ``size`` elements."""
        while len(self.path) > size:
            tag = self.path.pop().tag
            self.places[tag].pop()
            if tag in FENCE:
                self.fences.pop()

    def start(self, name: str) -> None:
        """Close what a start tag closes: the outermost such element inside the innermost box."""
        fence, found = self.fences[-1], len(self.path)
        for tag in CLOSES.get(name) or (("p",) if name in BLOCKS else ()):
            places = self.places.get(tag, ())
            first = bisect_right(places, fence)
            if first < len(places):
                found = min(found, places[first])
        self.cut(found)

    def end(self, name: str) -> None:
        """Close an element by its end tag; a stray end tag does not close the box around it."""
        places = self.places.get(name)
        if places and places[-1] and (name in FENCE or places[-1] > self.fences[-1]):
            self.cut(places[-1])


def parse(page: str) -> Node:
    """A tree of the page's elements; text between tags becomes strings with references decoded.

    A further ``html`` start tag is passed over.
    """
    root = Node("html", "no", None)
    stack, at, size = Open(root), 0, len(page)
    while at < size:
        match = TAG.search(page, at)
        if match is None:
            add(stack.here, page[at:])
            break
        if match.start() > at:
            add(stack.here, page[at : match.start()])
        at = match.end()
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        if match["end"]:
            stack.end(name)
            continue
        if name == "html":
            continue
        stack.start(name)
        here = stack.here
        node = Node(name, hinted(name, match["attrs"] or ""), here)
        here.children.append(node)
        if name in ("article", "main", "h1") and node.hint == "no":
            above = here
            while above is not None and not above.core:
                above.core, above = True, above.parent
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else size
        elif name not in VOID:
            stack.push(node)
    return root


def add(node: Node, text: str) -> None:
    node.children.append(entities.unescape(text) if "&" in text else text)


def dropped(node: Node, inside: bool) -> bool:
    return node.tag in DROPPED or node.hint == "yes" and not node.core or node.tag == "header" and not inside


def settle(root: Node) -> None:
    """Decide boxes that may be something else: one stays if it holds more plain text than all the rest of the page."""
    doubtful = [n for n in nodes(root) if n.hint == "maybe" and not n.core]
    if not doubtful:
        return
    plain: dict[int, int] = {}
    order: list[Node] = []
    stack = [(root, False, False)]
    while stack:
        node, link, inside = stack.pop()
        order.append(node)
        link, inside = link or node.tag == "a", inside or node.tag in ("article", "main")
        plain[id(node)] = 0 if link else sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        stack.extend((c, link, inside) for c in node.children if not isinstance(c, str) and not dropped(c, inside))
    for node in reversed(order):
        if node.parent is not None:
            plain[id(node.parent)] += plain[id(node)]
    for node in doubtful:
        node.hint = "no" if 2 * plain.get(id(node), 0) > plain[id(root)] else "yes"


def measured(node: Node, link: bool, inside: bool) -> None:
    """Characters, tags and links of what is not dropped, bottom up without recursion."""
    order: list[tuple[Node, bool]] = []
    stack = [(node, link, inside)]
    while stack:
        at, link, inside = stack.pop()
        link, inside = link or at.tag == "a", inside or at.tag in ("article", "main")
        order.append((at, link))
        kept = []
        for child in at.children:
            if isinstance(child, str):
                count = len("".join(child.split()))
                at.chars += count
                at.link_chars += count * link
                kept.append(child)
            elif not dropped(child, inside):
                kept.append(child)
                stack.append((child, link, inside))
        at.children = kept
    for at, link in reversed(order):
        for child in at.children:
            if not isinstance(child, str):
                at.chars += child.chars
                at.tags += child.tags + 1
                at.link_chars += child.link_chars
                at.link_tags += child.link_tags + (child.tag == "a")
    body_chars, body_links = max(node.chars, 1), node.link_chars
    for at, _ in order:
        at.density = composite(at, body_links / body_chars)
    for at, _ in order:
        at.total = sum(child.density for child in at.children if not isinstance(child, str))


def composite(node: Node, body_share: float) -> float:
    chars, tags = node.chars, max(node.tags, 1)
    if not chars:
        return 0.0
    links, plain = max(node.link_chars, 1), max(chars - node.link_chars, 1)
    base = math.log(chars / plain * node.link_chars + body_share * chars + math.e)
    value = chars / links * tags / max(node.link_tags, 1)
    return chars / tags * math.log(max(value, 1.0)) / base


def nodes(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(child for child in reversed(node.children) if not isinstance(child, str))


def content(page: str) -> list[str]:
    """Blocks of the page's main text, in order."""
    root = parse(page)
    settle(root)
    measured(root, False, False)
    if not root.chars:
        return []
    body = next((n for n in nodes(root) if n.tag == "body"), root)
    if not body.chars:
        body = root
    best = max(nodes(body), key=lambda n: n.total)
    if best.total <= 0:
        best = body
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    # the article is the whole box around the densest part, not one of its sections
    top = next((n for n in path if n.tag == "article"), None) or next((n for n in path if n.tag == "main"), None)
    if top is None:
        top = best
        for n in path[1:]:
            if n is body or n.link_chars >= LINK_SHARE * n.chars or n.density < threshold:
                break
            top = n
    chosen, above = {id(top)}, {id(n) for n in path}
    # without a box of its own the article may go on in the boxes beside the densest one
    loose = top.parent is body and top.tag not in ("article", "main")
    stack: list[tuple[Node, bool]] = [(body, False)]
    while stack:
        n, inside = stack.pop()
        inside = inside or id(n) in chosen
        if not inside and id(n) not in above and n.tag in FENCE:
            dense = n.density >= threshold and n.total >= SIDE_SHARE * best.total
            if dense or loose and n.parent is body and n.link_chars < LINK_SHARE * n.chars and any(c.tag == "p" for c in nodes(n)):
                chosen.add(id(n))
                inside = True
        stack.extend((c, inside) for c in reversed(n.children) if not isinstance(c, str))
    return blocks(body, chosen)


def blocks(body: Node, chosen: set[int]) -> list[str]:
    out: list[str] = []
    parts: list[str] = []

    def end() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append(text)

    stack: list[tuple[Node | str | None, bool]] = [(body, False)]
    while stack:
        node, inside = stack.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            if inside:
                parts.append(node)
        else:
            inside = inside or id(node) in chosen
            if inside and id(node) not in chosen and node.tag in ("ul", "ol", "div", "section", "table") and node.chars and node.link_chars >= MENU_SHARE * node.chars:
                continue
            if node.tag == "br":
                parts.append(" ")
            if node.tag in BLOCKS:
                end()
                stack.append((None, inside))
            stack.extend((child, inside) for child in reversed(node.children))
    end()
    return out


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` (its code points): one row per input row.

    Null and empty pages, and pages without text outside the cut parts, give empty text. Null keys stay; repeated
    rows give repeated results; an empty table gives an empty result. Columns other than ``html`` and ``keep`` are
    not read, whatever their names.
    """
    rows = pages.select(*keep, pages[html].alias("__html"))
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in slices(batches, "__html"):
            texts = ["\n\n".join(content((data or b"").decode("utf-8", "replace"))) for data in utf8(batch.column("__html"))]
            columns = [batch.column(c).cast(target.field(c).type) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, target.field("text").type), pa.array([len(t) for t in texts], pa.int64())], schema=target)

    return rows.mapInArrow(run, schema)
