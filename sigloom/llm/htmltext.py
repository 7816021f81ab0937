"""Main text of web pages by tree scoring.

One pass over the markup builds a tree of elements and a list of text blocks. Elements that are
never content (menus, page headers and footers, sidebars, forms, scripts ..., by tag, role or a
word of their class or id) are left out with all they hold. Every other block of some length
passes points for its length and its commas to its parent, half of them to the grandparent and
less and less beyond; a container's points are then discounted by its link density. The best
container, raised to the ``article`` or ``main`` around it, is kept together with those of its
siblings that score well beside it or are plain paragraphs.

Blocks keep their page order. Character references are decoded, white space inside a block is one
space (``br`` counts as white space), blocks are joined by an empty line. All steps are linear in
the page, at any depth of nesting. A null or empty page, and one without text, give an empty text;
broken markup (unclosed or crossed tags, a page that ends within a tag) is read as far as it goes.
Ties between containers go to the one that begins first. Repeated rows are read each, an empty
table gives no rows, other columns aren't read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces, strings

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?][^>]*+>",
    re.S,
)
_ATTR = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+|["'/=]""")
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math object canvas audio video".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr td th".split()
)
_DROP = frozenset("nav footer aside form button select option input dialog menu head applet fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NEVER = frozenset("html body article main".split())
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner breadcrumb breadcrumbs comment comments commentlist disqus reply replies "
    "respond cookie cookies consent gdpr notice notices notification alert popup modal overlay promo promotion promoted related recommended recommendations "
    "share sharing social sidebar sidebars side rail sponsor sponsored sponsor-links menu menus nav navbar navigation newsletter subscribe subscription signup "
    "login search searchbox footer foot masthead topbar toolbar widget widgets paywall disclaimer pager pagination paging skip outbrain taboola header page-header site-header".split()
)
#: Words that count within a compound name too (``site-footer``); the others may be part of any name.
_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs commentlist comments consent cookie cookies disqus footer gdpr masthead nav "
    "navbar newsletter outbrain paywall popup promo sidebar sponsored taboola topbar".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: An opening tag ends an open element of these, up to the boundary.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
}
_P = (frozenset(["p"]), frozenset(["td", "th", "table", "button", "article", "section", "div", "blockquote", "li"]))
MIN_BLOCK = 25
KEPT, DROPPED, HEADINGS = 0, 1, 2


class Node:
    __slots__ = ("tag", "parent", "drop", "at", "last", "score", "chars", "links", "inside")

    def __init__(self, tag: str, parent: Node | None, drop: int, at: int, inside: bool):
        self.tag, self.parent, self.drop, self.at, self.last = tag, parent, drop, at, at
        self.score, self.chars, self.links, self.inside = 0.0, 0, 0, inside


class Block:
    __slots__ = ("node", "parts", "linked", "text")

    def __init__(self, node: Node):
        self.node, self.parts, self.linked, self.text = node, [], 0, ""


def _dropped(tag: str, attributes: str, inside: bool) -> int:
    if tag in _DROP:
        return DROPPED
    if tag == "header":
        return HEADINGS if inside else DROPPED
    if attributes and tag not in _NEVER:
        for name, a, b, c in _ATTR.findall(attributes):  # name and value by turns: a value never counts as a name
            name, value = name.lower(), (a or b or c).lower()
            if name == "role":
                if value in _ROLES:
                    return DROPPED
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                return DROPPED
            elif name == "style":
                if re.search(r"display\s*:\s*none", value):
                    return DROPPED
            elif name in ("class", "id"):
                for word in value.split():
                    if word in _WORDS or not _PARTS.isdisjoint(re.split(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])", word)):
                        if tag in _HEADING and word in ("header", "masthead"):
                            continue
                        return DROPPED
    return KEPT


def _parse(html: str) -> tuple[list[Node], list[Block]]:
    root = Node("#", None, KEPT, 0, False)
    nodes, blocks, stack = [root], [], [root]
    where: dict[str, list[int]] = {}  # places of each open element in the stack, and of all that aren't inline
    walls: list[int] = [0]
    block: Block | None = None
    depth_a = 0
    at, n = 0, len(html)

    def text(start: int, end: int) -> None:
        nonlocal block
        node = stack[-1]
        if node.drop or start >= end:
            return
        piece = html[start:end]
        if block is None:
            if piece.isspace():
                return
            block = Block(stack[walls[-1]])
            blocks.append(block)
        block.parts.append(piece)
        if depth_a:
            block.linked += len(piece)

    def pop_to(size: int) -> None:
        nonlocal depth_a
        while len(stack) > size:
            gone = stack.pop()
            where[gone.tag].pop()
            if gone.tag == "a":
                depth_a -= 1
            if gone.tag not in _INLINE:
                walls.pop()

    def topmost(tags) -> int:
        """Place in the stack of the topmost of these elements, 0 for none."""
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            rest = html.find("<", at)
            while 0 <= rest and not re.match(r"<[a-zA-Z/!?]", html[rest : rest + 2]):
                rest = html.find("<", rest + 1)
            text(at, n if rest < 0 else rest)  # what follows is a tag without its end
            break
        text(at, m.start())
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in _INLINE
        if m.group(1):
            i = topmost((tag,))
            if not inline:
                block = None
            if i and not (inline and i < walls[-1]):  # an inline element isn't ended from within a block inside it
                pop_to(i)
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at) if not m.group(3).endswith("/") else None
            if end:
                at = end.end()
            elif not m.group(3).endswith("/"):
                at = n
            continue
        if tag in _VOID:
            if tag == "br":
                if block is not None:
                    block.parts.append(" ")
            elif not inline:
                block = None
            continue
        if not inline:
            block = None
        elif tag in ("td", "th") and block is not None:
            block.parts.append(" ")
        for what, until in ([_P] if tag in _CLOSES_P else []) + ([_CLOSES[tag]] if tag in _CLOSES else []):
            i = topmost(what)
            if i > topmost(until):
                pop_to(i)
        parent = stack[-1]
        if parent.drop == DROPPED:
            drop = DROPPED
        elif parent.drop == HEADINGS:
            drop = KEPT if tag in _HEADING else HEADINGS
        else:
            drop = _dropped(tag, m.group(3), parent.inside)
        node = Node(tag, parent, drop, len(nodes), parent.inside or tag in ("article", "main"))
        nodes.append(node)
        if not m.group(3).endswith("/") or not inline:
            where.setdefault(tag, []).append(len(stack))
            if not inline:
                walls.append(len(stack))
            stack.append(node)
            if tag == "a":
                depth_a += 1
    return nodes, blocks


def main_text(html: str) -> str:
    """The article's text, or the empty text."""
    if not html:
        return ""
    nodes, blocks = _parse(html)
    kept = []
    for block in blocks:
        block.text = " ".join(unescape("".join(block.parts)).split())
        if block.text:
            kept.append(block)
            block.node.chars += len(block.text)
            block.node.links += min(block.linked, len(block.text))
            if len(block.text) >= MIN_BLOCK:
                points = 1 + block.text.count(",") + min(len(block.text) // 100, 3)
                if block.linked > len(block.text) // 2:
                    continue
                node, level = block.node, 0
                if node.tag in ("p", "pre", "blockquote", "li", "td", "tr", "dd") or node.tag in _HEADING:
                    node = node.parent
                while node is not None and level < 6:
                    node.score += points / (1 if level == 0 else 2 if level == 1 else level * 3)
                    node, level = node.parent, level + 1
    if not kept:
        return ""
    for node in reversed(nodes[1:]):
        up = node.parent
        up.chars += node.chars
        up.links += node.links
        up.last = max(up.last, node.last)
    best, top = None, 0.0
    for node in nodes:
        if node.score and node.tag not in ("#", "html", "tr", "tbody"):
            score = node.score * (1 - node.links / max(1, node.chars))
            node.score = score * 1.25 if node.tag in ("article", "main") else score
            if node.score > top:
                best, top = node, node.score
    if best is None:  # nothing but short blocks
        named = [x for x in nodes if x.tag in ("article", "main") and x.chars and not x.drop]
        best = max(named, key=lambda x: x.chars) if named else nodes[0]
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    ranges = [(best.at, best.last)]
    if best.parent is not None and best.tag not in ("body", "article", "main"):
        for node in nodes[best.parent.at + 1 : best.parent.last + 1]:
            if node.parent is best.parent and node is not best and not node.drop and node.chars:
                density = node.links / node.chars
                plain = node.tag in ("p", "pre", "blockquote") or node.tag in _HEADING
                if node.score >= max(10.0, 0.2 * top) or (plain and density < 0.25):
                    ranges.append((node.at, node.last))
        own = best.parent.at
    else:
        own = -1
    out = []
    for block in kept:
        at = block.node.at
        if at == own or any(a <= at <= b for a, b in ranges):
            out.append(block.text)
    return "\n\n".join(out)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row; one map over the table, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=2):
            texts = [main_text(h) for h in strings(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.selectExpr(
        f"cast(`{id_col}` as bigint) page_id", f"cast(`{url_col}` as string) url", f"cast(`{html_col}` as string) html"
    ).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
