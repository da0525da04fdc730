"""Main text of web pages by scoring the element tree.

Paragraph-like elements earn points for length and commas and pass them up: all to
the parent, half to the grandparent, a third to the element above. Each container
is discounted by its link density; the best one makes the article (the approach of the
Arc90 Readability experiment), with what stands beside it or beside an element around
it and has a good score or mostly unlinked text. Lists of links go, unless they follow
a heading inside it. Menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and comments go first: by tag, role or
being hidden; by a class or id that names boilerplate; with a boilerplate word elsewhere
in a name only if it is mostly links. A word removes nothing where all elements that it
names hold most of the unlinked text of the article (of the page, if it has no ``article``
or ``main``): it then names layout, and only lowers their scores. Elements that hold
``article`` or ``main`` stay; reader comments go in any case. Forms and fieldsets follow the
same rule by their tag, and stay if they hold paragraphs and no control.

Defined results: NULL or empty html gives an empty text; markup that never closes
ends at the end of the page; repeated rows give equal results; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements whose start ends an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NEVER_TEXT = frozenset("script style noscript template iframe object embed svg math canvas audio video head title select option button textarea input nav footer aside menu".split())
#: Tags that are boilerplate like a name; of these, the ones that are layout if they hold paragraphs and no control.
NAMING_TAGS, CONTROL_TAGS = frozenset("form fieldset dialog".split()), frozenset("form fieldset".split())
CONTROLS = frozenset("input select textarea button".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOT_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert sidebar aside menu menus nav navbar navigation "
    "breadcrumb breadcrumbs comment comments commentlist reply replies disqus discussion respond share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay "
    "footer header masthead topbar toolbar pagination pager widget skip".split()
)
HOLDS_MAIN = frozenset("html body article main".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TAG_POINTS = {"article": 25.0, "main": 15.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "th": -5.0}
#: Share of linked text over which an element outside the best container needs a good score.
MOSTLY_LINKS = 0.5
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Last words of a name that say how a thing is laid out, not what it is.
LAYOUT_NAMES = frozenset(
    "area bar block bottom box button buttons column content container group inner item items left link links list outer panel posts right section text title top wrap wrapper".split()
)
READER_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
#: Share of the unlinked text over which a word names layout and removes nothing.
MOST_TEXT = 0.5
#: Share of the page's unlinked text from which ``article`` or ``main`` is the article, and names outside are boilerplate.
REAL_MAIN = 0.1
#: What is left of the score of an element with a boilerplate word elsewhere in its name.
NAMED_SHARE = 0.75


class Node:
    __slots__ = ("tag", "parent", "parts", "gone", "main", "controls", "prose", "chars", "linked", "score", "order")

    def __init__(self, tag: str, parent: Node | None, gone: bool):
        self.tag, self.parent, self.gone = tag, parent, gone
        self.parts: list[Node | str] = []
        self.main = self.controls = self.prose = False
        self.chars = self.linked = 0
        self.score = 0.0


def unwanted(tag: str, attrs: list[tuple[str, str | None]], inside_main: bool) -> tuple[bool, int, str]:
    """Whether an element is surely boilerplate, what its names say (``name_kind``), and by which word."""
    if tag in NEVER_TEXT or tag == "header" and not inside_main:
        return True, 0, ""
    named = (2, tag) if tag in NAMING_TAGS else (0, "")
    for name, value in attrs:
        value = value or ""
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True, 0, ""
        if name == "role" and value.strip().lower() in NOT_TEXT_ROLES:
            return True, 0, ""
        if name in ("class", "id"):
            named = max([named, *(name_kind(x, inside_main) for x in value.split())])
    return False, *((0, "") if tag in HOLDS_MAIN else named)


def name_kind(name: str, inside_main: bool) -> tuple[int, str]:
    """What one class or id says: 0 nothing, 1 a boilerplate word somewhere, 2 boilerplate, 3 reader comments; and the word.

    The last word that is no layout word is what a compound names: ``related-posts`` and
    ``post-comments`` are boilerplate, ``related-work`` and ``share-price`` are not.
    """
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    hit = {p for p in parts if p in NOT_TEXT_NAMES}
    if not hit or inside_main and hit == {"header"}:
        return 0, ""
    while len(parts) > 1 and parts[-1] in LAYOUT_NAMES:
        parts.pop()
    if parts[-1] in NOT_TEXT_NAMES:
        return 3 if parts[-1] in READER_NAMES else 2, parts[-1]
    return 1, min(hit)


class Tree(HTMLParser):
    """Builds the element tree; ends what HTML ends by itself."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", None, False)
        self.nodes = [self.root]
        self.named: list[tuple[Node, int, str]] = []
        self.open = [self.root]
        self.counts: dict[str, int] = {}

    def _push(self, tag, attrs):
        top = self.open[-1]
        sure, named, word = unwanted(tag, attrs, self.counts.get("article", 0) + self.counts.get("main", 0) > 0)
        node = Node(tag, top, sure)
        if named:
            self.named.append((node, named, word))
        top.parts.append(node)
        self.nodes.append(node)
        return node

    def _pop_to(self, tags) -> None:
        while True:
            node = self.open.pop()
            self.counts[node.tag] -= 1
            if node.tag in tags:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH and self.counts.get("p"):
            self._pop_to({"p"})
        if tag in ENDS_LIKE and self.open[-1].tag in ENDS_LIKE[tag]:
            self._pop_to({self.open[-1].tag})
        node = self._push(tag, attrs)
        if tag not in VOID:
            self.open.append(node)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.counts.get(tag):
            self._pop_to({tag})

    def handle_data(self, data):
        self.open[-1].parts.append(data)

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):  # children come after parents
        if node.parent is not None:
            node.parent.controls |= node.controls or node.tag in CONTROLS
            node.parent.prose |= node.prose or node.tag == "p"
        if node.gone:
            continue
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(part) - part.count(" ")
            elif not part.gone:
                node.chars += part.chars
                node.linked += part.linked
                node.main |= part.main or part.tag in ("article", "main")
        if node.tag == "a":
            node.linked = node.chars


def _named_boilerplate(tree: Tree) -> list[Node]:
    """Named elements that go: by word and scope, unless the word's elements together hold most of the scope's text.

    The scope is the outermost ``article`` or ``main`` around an element, else the page.
    On a page whose ``article`` or ``main`` holds a real part of the text, a name outside
    of them is enough.
    """
    unlinked = lambda n: n.chars - n.linked
    root, scopes, inside = tree.root, {}, 0
    for node in tree.nodes:
        above = scopes.get(id(node.parent), root)
        scopes[id(node)] = node if above is root and node.tag in ("article", "main") and not node.gone else above
        if scopes[id(node)] is node and node is not root:
            inside += unlinked(node)
    whole = {id(root): 1.0 if inside > REAL_MAIN * unlinked(root) else MOST_TEXT}
    layout = lambda n, word: n.tag in CONTROL_TAGS and word == n.tag and n.prose and not n.controls
    asked = [(n, word, kind) for n, kind, word in tree.named if not n.gone and not n.main and (kind > 1 or _density(n) > MOSTLY_LINKS) and not layout(n, word)]
    held: dict[tuple[int, str], int] = {}
    words: dict[int, frozenset[str]] = {}
    named = {id(n): word for n, word, _ in asked}
    for node in tree.nodes:  # an element inside another one of its word counts with that one
        over = words.get(id(node.parent), frozenset())
        word = named.get(id(node))
        if word is not None and word not in over:
            scope = id(scopes[id(node)])
            held[scope, word] = held.get((scope, word), 0) + unlinked(node)
            over |= {word}
        words[id(node)] = over
    fits = lambda n, word: held[id(s := scopes[id(n)]), word] <= whole.get(id(s), MOST_TEXT) * unlinked(s)
    return [n for n, word, kind in asked if kind == 3 or fits(n, word)]


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _own_text(node: Node) -> str:
    """Text of a node and its inline elements."""
    out, stack = [], [node]
    while stack:
        for part in stack.pop().parts:
            if isinstance(part, str):
                out.append(part)
            elif part.tag in INLINE and not part.gone:
                stack.append(part)
    return "".join(out)


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        node.score += TAG_POINTS.get(node.tag, 0.0) if node.chars and not node.gone else 0.0
    for node in nodes:
        if node.gone or node.tag in INLINE or not node.chars:
            continue
        text = _own_text(node)
        if not text.strip():
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        above = node.parent if node.tag in PARAGRAPHS else node
        for share in (1, 2, 3):
            if above is None:
                break
            above.score += points / share
            above = above.parent


def _link_list(node: Node) -> bool:
    links = sum(1 for p in node.parts if not isinstance(p, str))
    return node.tag in ("ul", "ol", "div", "section", "table") and links >= 2 and _density(node) > 0.8


def _beside(part: Node | str, least: float) -> bool:
    """Whether something outside the best container belongs to the article."""
    if isinstance(part, str):
        return True
    return not part.gone and part.chars > 0 and not _link_list(part) and (part.score >= least or _density(part) <= MOSTLY_LINKS)


def _render(node: Node, out: list[str], best: Node, around: set[int], least: float) -> None:
    """Blocks of the article in page order; each block with single spaces.

    ``around`` holds the ids of the elements around the best container.
    """
    piece: list[str] = []

    def flush():
        if piece:
            if block := " ".join("".join(piece).split()):
                out.append(block)
            piece.clear()

    # With each part: 1 inside the best container, 2 if a heading is just before it, else 0.
    # A whole page as the best container has its menus in it.
    whole = best.tag not in ("", "html", "body")
    stack: list[tuple[Node | str | None, int]] = [(node, 0)]
    while stack:
        x, place = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            piece.append(x)
        elif x.tag == "br":
            piece.append(" ")
        elif x.gone or x is not best and id(x) not in around and place < 2 and _link_list(x):
            continue
        else:
            if x.tag not in INLINE:
                flush()
                stack.append((None, 0))
            inside = place > 0 or x is best and whole
            parts = [p for p in x.parts if p is best or id(p) in around or _beside(p, least)] if id(x) in around else x.parts
            placed, headed = [], False
            for p in parts:
                placed.append((p, inside + (inside and headed)))
                if not isinstance(p, str):
                    headed = p.tag in HEADINGS
                elif p.strip():
                    headed = False
            stack.extend(reversed(placed))
    flush()


def main_text(html: str | None) -> str:
    """The article of one page."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    nodes = tree.nodes
    for node in nodes:
        if node.parent is not None and node.parent.gone:
            node.gone = True
    _measure(nodes)
    if dropped := _named_boilerplate(tree):
        for node in dropped:
            node.gone = True
        for node in nodes:
            if node.parent is not None and node.parent.gone:
                node.gone = True
            node.chars = node.linked = 0
        _measure(nodes)
    _score(nodes)
    boxes = [n for n in nodes if not n.gone and n.chars and n.tag not in INLINE and n.tag not in PARAGRAPHS]
    if not boxes:
        return ""
    for n in boxes:
        n.score *= 1 - _density(n)
    for n, _, _ in tree.named:
        n.score *= NAMED_SHARE
    best = max(boxes, key=lambda n: n.score)
    around, above = set(), best.parent
    while above is not None:
        around.add(id(above))
        above = above.parent
    out: list[str] = []
    _render(tree.root, out, best, around, max(10.0, 0.2 * best.score))
    return " ".join(out)


def extract(pages: DataFrame, html: str = "html"):
    """Column of main texts of a column of html."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([main_text(x) for x in part], dtype=object)

    return run(pages[html])
