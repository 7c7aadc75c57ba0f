"""Main text of web pages by tree scoring.

A page becomes a tree of elements and, in page order, a list of text blocks (runs of text between the borders of block
elements). Paragraph blocks pass points up the tree: one, plus one for each comma, plus one for each hundred characters up
to three; their parent gets them whole, each further ancestor half of what the one below it got. An element starts with a
few points by its tag; its sum is discounted by its link density. The best container is kept whole. Beside the way
from it to the root, siblings of it and of its ancestors are kept if they are no lists of links; outside the article or main
element around it, if there is one, they must be articles or headings, read like prose or score a fifth of the best.

Page furniture takes no part. Scripts, styles, menus, footers, hidden elements and the like go by tag. Headers, sidebars,
forms, notices, adverts, reader comments and so on go by tag or by their class, id or role: a whole name that says so, a
compound of such names and of words of place, or one that ends in an unambiguous one; `share-price`, `notice-board`,
`post-header` or `ad-free` say nothing. Where no prose is left beside those, what lies in the fewest of them stands, so that
a page inside a form isn't empty. Inside an article, a header keeps its headings.

Nothing else is dropped or capped. Sums go once over the tree and places of open tags are kept in lists, so the cost is
linear in the length of the page, depth included (unclosed quotes in many tags apart). Defined cases: null or empty html has the
text ''; unclosed and misnested tags close as their block ends; a page without tags is one block; repeated rows and null
ids are rows as others; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_arrow, slices

# HTML element names by the part that they play, and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GONE = frozenset("nav footer head menu button select option input svg canvas object embed audio video math map".split()) | RAW
ASIDE = frozenset("aside form header dialog label fieldset".split())
NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disclaimer disqus footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination popup promo promoted promotion related recommended remark reply respond share sharing shoutbox sidebar signup skip social sponsor sponsored sponsors subscribe subscription toolbar widget alert search complementary contentinfo dialog".split())
ENDS = frozenset("ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments commentlist consent cookies disclaimer footer masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination popup sidebar signup sponsors toolbar".split())
PLACES = frozenset("site page top bottom left right primary secondary global user reader container wrapper wrap box area section list block slot unit bar links buttons button icons inner outer item items body text content thread policy posts stories articles media form row col column panel group holder zone region placeholder google js mobile desktop sticky fixed small large".split())
DENIED = frozenset("no non not free without has with".split())
KEEP = frozenset("html body article main".split())
START = {"article": 25, "main": 15, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ol": -3, "ul": -3, "dl": -3, "dd": -3, "dt": -3, "li": -3, "address": -3, "th": -5}
PARAGRAPHS = frozenset("p pre td blockquote div section article main body li dd center".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

HOLDS_P = ("td", "th", "li", "div", "section", "article", "blockquote")

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[A-Za-z][^>]*>""", re.S)
NAMED = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PARTS = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
RAW_ENDS = {tag: re.compile(rf"</{tag}[^>]*>?", re.I) for tag in RAW}
PROSE = 25
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element. aside: how many elements of furniture it lies in, itself included; gone: it never counts."""

    __slots__ = ("tag", "parent", "gone", "aside", "header", "inside", "score", "text", "link", "kept")

    def __init__(self, tag: str, parent: Node | None, gone: bool = False, named: bool = False):
        self.tag, self.parent, self.gone = tag, parent, gone
        up_aside, up_header, up_inside = (parent.aside, parent.header, parent.inside) if parent is not None else (0, 0, False)
        headline = tag in HEADINGS and up_inside
        self.aside = up_aside + (named and tag not in KEEP or tag in ASIDE) - (up_header if headline else 0)
        self.header = 0 if headline else up_header + (tag == "header" and up_inside)
        self.inside = up_inside or tag in ("article", "main")
        self.score, self.text, self.link, self.kept = float(START.get(tag, 0)), 0, 0, False


def _names_furniture(name: str) -> bool:
    """Whether one class, id or role names page furniture."""
    parts = [x.lower() for x in PARTS.split(name) if x]
    if not parts or not DENIED.isdisjoint(parts):
        return False
    return parts[-1] in ENDS or not NAMES.isdisjoint(parts) and all(x in NAMES or x in PLACES for x in parts)


def _furniture(attributes: str) -> tuple[bool, bool]:
    """Whether attributes hide an element; whether they name page furniture."""
    named = False
    for key, value in NAMED.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and UNSEEN.search(value):
            return True, named
        if key in ("class", "id", "role"):
            named = named or any(map(_names_furniture, value.split()))
    return False, named


class _Stack:
    """The open elements, with the places of each tag and of block elements among them."""

    def __init__(self, root: Node):
        self.nodes, self.places, self.blocks, self.links = [root], defaultdict(list), [0], 0

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)
        self.links += node.tag == "a"

    def leave(self, to: int) -> None:
        """Close all from place `to` on."""
        while len(self.nodes) > to:
            tag = self.nodes.pop().tag
            self.places[tag].pop()
            self.links -= tag == "a"
        while self.blocks[-1] >= to:
            self.blocks.pop()

    def last(self, tags) -> int:
        """The place of the innermost open element of these tags; 0 if none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def owner(self) -> Node:
        return self.nodes[self.blocks[-1]]


def _parse(page: str) -> tuple[list[tuple[Node, str, int]], list[Node]]:
    """Blocks (owner, text, characters in links) in page order, and all nodes, parents first."""
    root = Node("#root", None)
    nodes, blocks, stack = [root], [], _Stack(root)
    pieces: list[str] = []
    link_pieces = 0

    def flush():
        nonlocal pieces, link_pieces
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append((stack.owner(), text, min(link_pieces, len(text))))
            pieces, link_pieces = [], 0

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        raw = page[at : m.start()] if m else page[at:]
        if raw and not stack.nodes[-1].gone:
            piece = html.unescape(raw) if "&" in raw else raw
            pieces.append(piece)
            link_pieces += len(piece.strip()) if stack.links else 0
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and not stack.nodes[-1].gone:
                pieces.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        block = tag in BLOCK
        if m[1]:
            if stack.places.get(tag):
                k = stack.places[tag][-1]
                if block:
                    flush()
                if block or stack.blocks[-1] < k:
                    stack.leave(k)
            elif tag == "p":
                flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif not stack.nodes[-1].gone:
                pieces.append(" " if tag in ("br", "img", "input") else "")
            continue
        if block:
            flush()
            if (k := stack.last(("p",))) > stack.last(HOLDS_P):
                stack.leave(k)
        if tag in CLOSES:
            own, limits = CLOSES[tag]
            limit = stack.last(limits)
            found = [p[k] for t in own if (p := stack.places.get(t)) and (k := bisect_right(p, limit)) < len(p)]
            if found:
                stack.leave(min(found))
        hidden, named = _furniture(m[3]) if m[3] else (False, False)
        up = stack.nodes[-1]
        node = Node(tag, up, up.gone or tag in GONE or hidden, named)
        nodes.append(node)
        if tag in RAW:
            close = RAW_ENDS[tag].search(page, at)
            if close is None:
                break
            at = close.end()
            continue
        stack.push(node)
    flush()
    return blocks, nodes


def _prose(text: str, link: int) -> bool:
    return len(text) >= PROSE and 3 * link < len(text)


def _points(blocks: list[tuple[Node, str, int]], nodes: list[Node]) -> None:
    """Sums of text, links and points of all nodes, in one pass from the leaves."""
    given = dict.fromkeys(map(id, nodes), 0.0)
    for owner, text, link in blocks:
        owner.text += len(text)
        owner.link += link
        if owner.tag in PARAGRAPHS:
            to = owner.parent if owner.tag in ("p", "pre", "blockquote", "li", "dd") and owner.parent is not None else owner
            given[id(to)] += 1 + text.count(",") + min(len(text) // 100, 3)
    for node in reversed(nodes):
        node.score += given[id(node)]
        if (up := node.parent) is not None:
            up.text += node.text
            up.link += node.link
            given[id(up)] += given[id(node)] / 2


def main_text(page: str | None) -> str:
    """The article of a page, one block a line."""
    if not page:
        return ""
    blocks, nodes = _parse(page)
    level = min((o.aside for o, text, link in blocks if o.tag not in HEADINGS and _prose(text, link)), default=0)
    blocks = [b for b in blocks if b[0].aside <= level]
    if not blocks:
        return ""
    _points(blocks, nodes)
    density = lambda n: n.link / max(1, n.text)
    worth = lambda n: n.score * (1 - density(n))
    candidates = [n for n in nodes if n.text and n.tag in PARAGRAPHS and n.tag not in ("p", "li")]
    best = max(candidates, key=worth, default=nodes[0])  # of equal ones the first, which is the outermost
    way, around = set(), None
    node = best
    while node is not None:
        way.add(node)
        if node.tag == "article" or node.tag == "main" and around is None:
            around = node if around is None or around.tag == "main" else around
        node = node.parent
    within = set()  # on the way, from the article or main element down; without one the whole way
    node = best
    while node is not None:
        within.add(node)
        node = None if node is around else node.parent

    def joins(n: Node) -> bool:
        """Whether a sibling of the way is kept."""
        if n.parent in within or density(n) >= 1 / 3:
            return density(n) < 1 / 3
        if n.tag in HEADINGS or n.tag == "article":
            return True
        return n.text > 80 and (n.tag in ("p", "pre", "blockquote") or worth(n) >= 0.2 * worth(best))

    for n in nodes:
        n.kept = n is best or n.parent is not None and (n.parent.kept or n.text > 0 and n not in way and n.parent in way and joins(n))
    loose = lambda n, text, link: n in way and 4 * link < len(text) and (n in within or len(text) > 80)
    return "\n".join(text for owner, text, link in blocks if owner.kept or loose(owner, text, link))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars. Further columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "html"):
            found = [main_text(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return in_arrow(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
