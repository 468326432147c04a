"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. A small classifier of structure and wording gives each block two costs, of being
called content and of being called boilerplate; they are the capacities of its edges to the two terminals. Neighbours
on the page and blocks with the same place in the document tree are joined by smoothness edges. The maximum flow cuts
the page where labelling is cheapest as a whole; what stays on the side of the source is the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 500

# Elements of the markup language.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
HIDDEN = frozenset("button select option optgroup datalist svg".split())
FORM_PARTS = frozenset("label legend".split())  # hidden in a form only
#: Elements that end an open one of the same kind, and where the search for it stops. A ``p`` ends one that is the nearest block.
SELF_CLOSING = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}}
SELF_CLOSING |= {"td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

CHROME = frozenset("nav footer aside form menu dialog".split())
# Parts of class names and ids. Layout words count as whole names, behind a word of place or before one of content.
_CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice alert popup breadcrumb breadcrumbs comment comments commentlist disqus reply replies respond share sharing social "
    "related recommended copyright legal login signup subscribe newsletter pagination pager teaser outbrain taboola".split()
)
_LAYOUT_NAMES = frozenset(
    "sidebar side-bar menu nav navbar navigation header masthead footer toolbar widget modal overlay skip tag tags".split()
)
_MAIN_NAMES = frozenset("article content main post entry story body text".split())
_PLACES = frozenset("site page top bottom left right primary secondary global main sub mobile".split())
#: Names that tell of a page's state, or of a wrapper, rather than of what is inside.
_STATES = frozenset("with has no without hide show is".split())
_WRAPS = frozenset("wrap wrapper container layout inner".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)(?:>|$)", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
_NOTICE = re.compile(r"©|\(c\) \d{4}|copyright|all rights reserved|privacy policy|terms of (?:use|service)|cookies?", re.I)


@dataclass
class Element:
    name: str
    number: int
    parent: int
    chrome: int = 0
    main: bool = False
    hidden: bool = False
    link: bool = False
    form: bool = False


@dataclass
class Block:
    element: int
    grandparent: int
    name: str
    chrome: bool
    main: bool
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


#: How firmly an element is chrome: a form or dialog may hold a page's content, a box named for its layout an article.
LOOSE, LAYOUT, FIRM = 1, 2, 3


def _named(label: str) -> tuple[int, bool]:
    """Whether one class name or id tells of chrome, and how firmly, or else of content. Names that tell of both are chrome."""
    parts = [p for p in re.split(r"[-_]+", label.lower().replace("side-bar", "sidebar")) if p]
    if not parts or parts[0] in _STATES:
        return 0, False
    main = not _MAIN_NAMES.isdisjoint(parts)
    wrapper = parts[0] in _MAIN_NAMES and parts[-1] in _WRAPS
    if not wrapper and not _CHROME_NAMES.isdisjoint(parts):
        return FIRM, False
    kinds = [p for p in parts if p not in _PLACES and p not in _WRAPS]
    while len(kinds) > 1 and kinds[0] in _LAYOUT_NAMES and kinds[-1] in _MAIN_NAMES:
        kinds.pop()
    if main and not wrapper and len(kinds) > 1 and kinds[-1] in _LAYOUT_NAMES - {"header"}:
        return LAYOUT, False
    if not wrapper and len(kinds) == 1 and kinds[0] in _LAYOUT_NAMES:
        return LAYOUT, False
    return 0, main


def _opened(name: str, attributes: str, number: int, above: Element) -> Element:
    """The nearest element that tells of chrome or of content decides; inside chrome, only the firmer signs of content do."""
    named: dict[str, str] = {}
    if attributes.strip():
        named = {k.lower(): (v or "").strip("\"'") for k, v in _NAMED.findall(attributes)}
    told = [_named(label) for label in f"{named.get('class', '')} {named.get('id', '')}".split()]
    role = named.get("role", "").lower()
    chrome = max((firm for firm, _ in told), default=0)
    if name in ("nav", "footer", "aside", "menu") or role in _CHROME_ROLES or name == "header" and not above.main:
        chrome = FIRM
    elif name in CHROME:
        chrome = max(chrome, LAYOUT if above.main else LOOSE)
    if name in ("main", "body", "html") or name == "article" and chrome < FIRM:
        chrome = 0
    # the firmest chrome around that an element can stand in and still be content
    most = FIRM if name == "main" or role == "main" else LAYOUT if name == "article" else LOOSE if any(m for _, m in told) else -1
    if chrome:
        chrome, main = max(chrome, above.chrome), False
    elif above.chrome <= most:
        chrome, main = 0, True
    else:
        chrome, main = above.chrome, above.main
    hidden = name in HIDDEN or "hidden" in named or named.get("aria-hidden") == "true"
    hidden = hidden or "display:none" in named.get("style", "").replace(" ", "").lower()
    form = above.form or name == "form"
    hidden = above.hidden or hidden or form and name in FORM_PARTS
    return Element(name, number, above.number, chrome, main, hidden, above.link or name == "a", form)


def blocks_of(page: str) -> list[Block]:
    """Visible text blocks in page order. Markup need not be well formed."""
    stack = [Element("", 0, -1)]
    open_at: dict[str, list[int]] = {}  # the depths of open elements by name
    open_blocks = [0]
    out: list[Block] = []
    current: Block | None = None
    number = at = 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            open_at[stack.pop().name].pop()
        while open_blocks[-1] >= depth:
            open_blocks.pop()

    def text(piece: str) -> None:
        nonlocal current
        top = stack[-1]
        if not piece or top.hidden:
            return
        if current is None:
            if not piece.strip():
                return
            holder = stack[open_blocks[-1]]
            current = Block(holder.number, holder.parent, holder.name, bool(holder.chrome or top.chrome), holder.main and not top.chrome)
            out.append(current)
        current.pieces.append(piece)
        if top.link:
            current.linked += len(piece.strip())

    length = len(page)
    while at < length:
        tag = _TAG.search(page, at)
        if tag is None:
            text(html.unescape(page[at:]))
            break
        if tag.start() > at:
            text(html.unescape(page[at : tag.start()]))
        at = tag.end()
        name = tag[2]
        if not name:
            continue
        name = name.lower()
        if name == "br":
            text(" ") if current else None
            continue
        if name in BLOCKS:
            current = None
        if tag[1]:
            if open_at.get(name):
                close(open_at[name][-1])
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else length
            continue
        if name in VOID or tag[3].rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name == "p":
            if stack[open_blocks[-1]].name == "p":
                close(open_blocks[-1])
        elif name in SELF_CLOSING and open_at.get(name):
            if open_at[name][-1] > max((open_at[n][-1] for n in SELF_CLOSING[name] if open_at.get(n)), default=0):
                close(open_at[name][-1])
        number += 1
        open_at.setdefault(name, []).append(len(stack))
        if name in BLOCKS:
            open_blocks.append(len(stack))
        stack.append(_opened(name, tag[3], number, stack[-1]))
    for block in out:
        block.text = _SPACE.sub(" ", "".join(block.pieces)).strip()
    return [b for b in out if b.text]


def boilerplate_odds(block: Block) -> float:
    """Log-odds that a block is boilerplate, from its place, its links and its wording. Hand-set: no page is labelled."""
    words = block.text.count(" ") + 1
    odds = 0.5
    if block.chrome:
        odds += 6.0
    if block.main:
        odds -= 4.0
    if block.linked > 0.5 * len(block.text):
        odds += 2.5
    if block.name in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "figcaption"):
        odds -= 1.0
    odds -= min(3.0, words / 12)
    if block.text[-1] in ".!?…:;\"'”»":
        odds -= 0.5
    if words < 40 and _NOTICE.search(block.text):
        odds += 2.5
    return odds


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges: between neighbours on the page, stronger under one parent, and between the next of the same place in the tree."""
    edges = [
        (i, i + 1, 0.3 if a.chrome != b.chrome else 1.0 if a.element == b.element or a.grandparent == b.grandparent else 0.5)
        for i, (a, b) in enumerate(zip(blocks, blocks[1:]))
    ]
    last: dict[tuple[int, str], int] = {}
    for i, b in enumerate(blocks):
        key = (b.grandparent, b.name)
        if key in last and last[key] < i - 1:
            edges.append((last[key], i, 0.5))
        last[key] = i
    return edges


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True where a block is content: the source side of the smallest minimum cut, by blocking flows.

    A block with odds x below 0 has capacity -x from the source (the cost of calling it boilerplate), one above 0 has
    capacity x to the sink. Each phase finds the distances from all blocks with capacity left, and then fills the shortest
    paths, trying every edge once; flow stays near where it starts, so phases are few however long the page is."""
    n, least = len(odds), 1e-9
    gives, takes = [max(0.0, -x) for x in odds], [max(0.0, x) for x in odds]
    near: list[list[int]] = [[] for _ in range(n)]  # edges by number; an edge and its other direction differ in the last bit
    to: list[int] = []
    left: list[float] = []
    for a, b, w in edges:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += (b, a)
        left += (w, w)
    while True:
        level = [-1] * n
        front = [i for i in range(n) if gives[i] > least]
        starts, depth = front, 0
        for i in front:
            level[i] = 0
        while front and not any(takes[i] > least for i in front):
            depth += 1
            following = []
            for i in front:
                for e in near[i]:
                    if left[e] > least and level[to[e]] < 0:
                        level[to[e]] = depth
                        following.append(to[e])
            front = following
        if not front:
            return [x >= 0 for x in level]
        tried = [0] * n
        for start in starts:
            i, path = start, []
            while gives[start] > least:
                if takes[i] > least:
                    flow = min(gives[start], takes[i], *(left[e] for e in path))
                    gives[start] -= flow
                    takes[i] -= flow
                    for e in path:
                        left[e] -= flow
                        left[e ^ 1] += flow
                    i, path = start, []
                elif tried[i] < len(near[i]):
                    e = near[i][tried[i]]
                    if level[i] < depth and left[e] > least and level[to[e]] == level[i] + 1:
                        path.append(e)
                        i = to[e]
                    else:
                        tried[i] += 1
                elif path:
                    i = to[path.pop() ^ 1]
                    tried[i] += 1
                else:
                    break


def main_text(page: str | None) -> str:
    """The content blocks of a page, in order, separated by an empty line. A null or empty page gives an empty text."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    content = min_cut([boilerplate_odds(b) for b in blocks], smoothness(blocks))
    return "\n\n".join(b.text for b, c in zip(blocks, content, strict=True) if c)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per row of ``pages``: the columns ``keep``, ``text`` and ``n_chars``.

    Null and empty pages give empty texts; nulls in ``keep``, repeated rows and other columns have no effect. Each page is
    handled whole, on its own, without a shuffle; an empty table gives an empty table."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                texts = [main_text(p.as_py()) for p in batch.column(len(keep))]
                kept = [batch.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*keep, "text", "n_chars"],
                )

    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select(*keep, F.col(html_col).alias("_html")).mapInArrow(each, f"{schema}, text string, n_chars long")
