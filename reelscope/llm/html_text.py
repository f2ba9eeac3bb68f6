"""Main text of web pages by composite text density.

Method: a page is parsed into a tree; elements that are boilerplate by tag,
attribute or class name (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, reader comments) are cut off.  Every remaining node
gets its composite text density

    C/T * log_b(C/LC * T/LT),  b = ln(C/(C-LC) * LC + LCbody/Cbody * C + e)

with C characters and T tags below it and LC, LT those inside links.  The
subtree whose children's densities have the largest sum is the main text.  What
stands beside it under the same parent belongs to it, however short, but for
blocks that are mostly links and below the threshold, which is the least density
on the path from the subtree up to the body.  Farther up that path a subtree
counts if it reaches the threshold, and a heading if what follows it does.

Names are taken with care.  A name that an article may use for its own parts
(``related``, ``social``, ``discussion`` ...) marks boilerplate only where the
element is also built like it: mostly links, a form, a thread of entries.  Where
the subtree lies in an ``article`` or ``main`` element, nothing of that element
is left out for its density or its links.  If names would leave no text at all,
only tags and attributes count.

One pass over the rows; a page is parsed by itself.

Defined cases: null or empty html, or a page without text, gives an empty
text and 0 characters; markup cut off in the middle is closed where the page
ends and an unfinished tag at the end is dropped; repeated rows are all
returned; other columns are not read.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from reelscope.llm.staging import bounded_batches
from reelscope.llm.textgrams import slices

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes plaintext".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul caption".split()
)
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form button select option optgroup textarea input "
    "label fieldset datalist dialog menu iframe object embed audio video canvas svg applet frameset noframes".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end when one of the second kind starts in the same container.
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "option": frozenset(["option", "optgroup"]),
    "thead": frozenset(["tbody", "tfoot"]),
    "tbody": frozenset(["tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
# Words of class and id names that mark boilerplate by themselves,
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements sponsor sponsored promo banner sidebar nav navbar navi "
    "breadcrumb breadcrumbs cookie cookies gdpr notice notices popup modal overlay newsletter signup pagination pager "
    "toolbar searchbox skip".split()
)
# and that do so inside an article, or on a paragraph, only where the element is mostly links or has a form.
DOUBTFUL_WORDS = frozenset(
    "advertising promotion aside navigation menu footer consent alert subscribe subscription login search share sharing "
    "social related recommended recommendations widget widgets disclaimer".split()
)
PAGE_HEADER_WORDS = frozenset("header masthead topbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus".split())
# Names of reader comments, where entries or a form follow, and of parts of an article, where they do not.
DOUBTFUL_COMMENT_WORDS = frozenset("discussion respond reply replies responses".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/><]*+)((?:[^\"'<>]|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(>|\Z|(?=<))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:@-][^\s=>/]*+)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?")
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")  # the slash of href=/a/ is part of the address
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Node:
    tag: str
    parent: Node | None
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # nodes and strings
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    density_sum: float = 0.0


def parse(page: str) -> Node:
    """The element tree; tolerant of missing and stray end tags."""
    root = at = Node("#root", None)
    position = 0
    open_count: dict[str, int] = {}

    def close(to: Node) -> Node:
        nonlocal at
        while at is not to:
            open_count[at.tag] -= 1
            at = at.parent
        return at

    def text(raw: str) -> None:
        if raw:
            at.children.append(references.unescape(raw))

    while True:
        found = _TAG.search(page, position)
        if not found:
            text(page[position:])
            return root
        text(page[position : found.start()])
        position = found.end()
        name = found[2]
        if name is None:
            if found[0].startswith("<![CDATA["):
                text(found[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if found[1]:
            if open_count.get(name):
                node = at
                while node.tag != name:
                    node = node.parent
                at = close(node.parent)
            continue
        if not found[4] and position == len(page):
            return root  # a tag that the end of the page cut off
        if name in BLOCKS and open_count.get("p") and name not in ("html", "body"):
            node = at
            while node.tag != "p" and (node.tag not in BLOCKS):
                node = node.parent
            if node.tag == "p":
                close(node.parent)
        for ended, by in CLOSED_BY.items():
            if name in by and open_count.get(ended):
                node = at
                while node.tag != ended and node.tag not in ("table", "ul", "ol", "dl", "select", "#root"):
                    node = node.parent
                if node.tag == ended:
                    close(node.parent)
        attributes = {
            m[1].lower(): references.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(found[3])
        }
        node = Node(name, at, attributes)
        at.children.append(node)
        if name in VOID or _SELF_CLOSED.search(found[3]) and name not in BLOCKS:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?![^\s/>])[^>]*+>?", re.I).search(page, position)
            position = end.end() if end else len(page)
            continue
        open_count[name] = open_count.get(name, 0) + 1
        at = node


def _walk(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") or node.attributes.get("role") == "main"


def _names(node: Node) -> set[str]:
    return set(_WORD.findall(f"{node.attributes.get('class', '')} {node.attributes.get('id', '')}".lower()))


def _hidden(node: Node) -> bool:
    style = node.attributes.get("style", "").replace(" ", "").lower()
    return "hidden" in node.attributes or node.attributes.get("aria-hidden") == "true" or "display:none" in style


@dataclass
class _Shape:
    """What a subtree is built of, before anything is cut off."""

    chars: int = 0
    link_chars: int = 0
    forms: int = 0
    entries: int = 0  # li and article elements, and such as are named a comment or reply
    mains: int = 0  # article and main elements

    @property
    def links(self) -> bool:
        return self.link_chars * 2 > self.chars


def _shapes(order: list[Node]) -> dict[int, _Shape]:
    shapes = {id(n): _Shape() for n in order}
    for node in reversed(order):
        own = shapes[id(node)]
        if node.tag not in ("script", "style"):
            own.chars += sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            own.link_chars = own.chars
        own.forms += node.tag in ("form", "textarea", "input")
        own.entries += node.tag in ("li", "article") or bool(_names(node) & (COMMENT_WORDS | {"reply"}))
        own.mains += node.tag in ("article", "main")
        if node.parent is not None:
            up = shapes[id(node.parent)]
            for name, value in vars(own).items():
                setattr(up, name, getattr(up, name) + value)
    return shapes


def _is_boilerplate(node: Node, shape: _Shape, page: _Shape, in_main: bool, by_name: bool) -> bool:
    if node.tag in DROPPED:
        return True
    if node.tag in ("#root", "html", "body", "main"):
        return False
    if _hidden(node):
        return True
    if not by_name or node.tag in HEADINGS:
        return False
    names = _names(node)
    if 0 < shape.mains == page.mains and not in_main:  # it holds every article: no part beside one, unless comments are the articles
        return bool(names & COMMENT_WORDS) and shape.mains > 1 and shape.chars * 2 < page.chars
    if names & COMMENT_WORDS or names & DOUBTFUL_COMMENT_WORDS and (shape.forms or shape.entries > 1):
        return True
    if node.tag == "article" or node.tag == "header" and in_main:
        return False
    if node.attributes.get("role", "").lower() in BOILERPLATE_ROLES or names & BOILERPLATE_WORDS:
        return True
    if names & DOUBTFUL_WORDS and (shape.links or shape.forms or not in_main and node.tag not in ("p", "blockquote", "li", "td")):
        return True
    return not in_main and (node.tag == "header" or bool(names & PAGE_HEADER_WORDS))


def prune(root: Node, by_name: bool = True) -> None:
    """Cut boilerplate elements off the tree."""
    order = _walk(root)
    shapes = _shapes(order)
    in_main = set()
    for node in order:
        if _is_main(node) or id(node.parent) in in_main:
            in_main.add(id(node))
        inside = id(node) in in_main
        if any(isinstance(c, Node) for c in node.children):
            node.children = [
                c for c in node.children if isinstance(c, str) or not _is_boilerplate(c, shapes[id(c)], shapes[id(root)], inside, by_name)
            ]


def measure(root: Node) -> list[Node]:
    """Counts and densities of all nodes; returns them parents first."""
    order = _walk(root)
    for node in reversed(order):
        node.tags = max(1, sum(1 + c.tags for c in node.children if isinstance(c, Node) and c.children) + sum(
            1 for c in node.children if isinstance(c, Node) and not c.children
        ))
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(" ".join(child.split()))
            else:
                node.chars += child.chars
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.tag == "a":
            node.link_chars = node.chars
            node.link_tags += 1
    body = next((n for n in order if n.tag == "body"), root)
    share = body.link_chars / max(1, body.chars)
    for node in order:
        if node.chars:
            plain = max(1, node.chars - node.link_chars)
            base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
            value = node.chars / max(1, node.link_chars) * (node.tags / max(1, node.link_tags))
            node.density = node.chars / node.tags * math.log(max(1.0, value)) / math.log(base) if base > 1 else (
                node.chars / node.tags * math.log(max(1.0, value))
            )
    for node in order:
        node.density_sum = sum(c.density for c in node.children if isinstance(c, Node))
        if any(isinstance(c, str) and c.strip() for c in node.children):
            node.density_sum = max(node.density_sum, node.density)
    return order


def _menu(node: Node, threshold: float) -> bool:
    """Whether a block is mostly links, and less dense than the path to the body."""
    return node.link_tags > 1 and node.link_chars * 2 > node.chars and node.density < threshold


def _main_parts(order: list[Node]) -> tuple[list[Node | str], float | None]:
    """Subtrees and strings of the main text in page order; the density below
    which blocks of links in them go (None: they stay)."""
    best = max(order, key=lambda n: n.density_sum)
    path = []
    node = best
    while node is not None:
        path.append(node)
        if node.tag == "body":
            break
        node = node.parent
    threshold = min(n.density for n in path)
    top = max((i for i, n in enumerate(path) if _is_main(n)), default=-1)
    inside = {id(n) for n in path[: top + 1]}  # the explicit article and what leads to the subtree in it
    on_path = {id(n) for n in path}

    def stays(parent: Node, child: Node | str) -> bool:
        if isinstance(child, str):
            return bool(child.strip()) and (id(parent) in inside or parent is best.parent)
        if id(child) in on_path:
            return True
        if not child.chars:
            return False
        if id(parent) in inside:
            return True
        if parent is best.parent:
            return not _menu(child, threshold)
        return child.density >= threshold

    parts: list[Node | str] = []
    stack: list[Node | str] = [path[-1]]
    while stack:
        node = stack.pop()
        if isinstance(node, str) or node is best or id(node) not in on_path:
            parts.append(node)
            continue
        kept, follows = [], True
        for child in reversed(node.children):
            heading = isinstance(child, Node) and child.tag in HEADINGS and id(child) not in on_path
            if heading and id(node) not in inside:
                keep = bool(child.chars) and follows  # a heading goes with what it stands over
            else:
                keep = stays(node, child)
                if not isinstance(child, str) or child.strip():
                    follows = keep
            if keep:
                kept.append(child)
        stack.extend(kept)
    return parts, None if inside else threshold


def _blocks(root: Node | str, threshold: float | None) -> Iterator[str]:
    """The text of each block in page order."""
    parts: list[str] = []
    stack: list = [root]
    edge = object()
    while stack:
        item = stack.pop()
        if item is edge:
            if joined := " ".join("".join(parts).split()):
                yield joined
            parts.clear()
        elif isinstance(item, str):
            parts.append(item)
        else:
            block = item.tag in BLOCKS
            # A paragraph, entry or cell is text even where it is all links; a list or box of links is a menu.
            if threshold is not None and block and item is not root and item.tag not in ("p", "li", "dd", "td") and _menu(item, threshold):
                continue
            if item.tag == "br":
                parts.append(" ")
            if block:
                stack.append(edge)
            stack.extend(reversed(item.children))
            if block:
                stack.append(edge)
    if joined := " ".join("".join(parts).split()):
        yield joined


def main_text(page: str | None) -> str:
    """The main text of a page, one line per block."""
    if not page:
        return ""
    for by_name in (True, False):
        root = parse(page)
        prune(root, by_name)
        order = measure(root)
        if root.chars:
            parts, threshold = _main_parts(order)
            return "\n".join(block for part in parts for block in _blocks(part, threshold))
    return ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id``, ``url``, ``html``)."""
    rows = pages.selectExpr("cast(page_id as bigint) as page_id", "cast(url as string) as url", "cast(html as string) as html")
    return bounded_batches(rows).mapInArrow(_extract, SCHEMA)
