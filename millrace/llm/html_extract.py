"""Main text of web pages by wrapper induction.

All pages of a host are parsed to trees and aligned by simple tree matching. Nodes whose text is the
same in all of them are the host's template, nodes whose text varies are slots. The wrapper of a
host is the set of its constant ``(place, text)`` pairs, and of those that half of all its pages
hold, counted over every node of every page. A slot whose texts come from a pool, as those of
rotating adverts do, is no content either: its texts stand on several pages each, where those of an
article stand on one.
The pages are also merged to one tree of the host, by parts of some pages each and then the parts
with one another, and the subtree that holds most of the text that varies is its content. Each page
is aligned with that tree; its node that falls on the content is where its main text stands, marked
as an article or not. The page then gives up its
template nodes; of the slots left, those inside menus, headers, footers, forms, adverts, comments
and the like are set aside by their tags, roles and class names. Without a content, or where a
page has its text elsewhere, its marked articles or else its body take its place.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import url_filter
from millrace.llm.tables import prepare, stored

#: Pages of a host, or trees of so many pages, that one task merges; more are merged in rounds.
MERGED_PAGES = 64
#: A node is template too if this share of a host's distinct pages holds it, and so many pages.
COMMON_SHARE, COMMON_PAGES = 0.5, 4
#: Outside marked articles also if its slot is a pool (each text there is held by so many distinct
#: pages on average), and this share of the host's pages and ``COMMON_PAGES`` hold the node.
POOL_PAGES, POOL_SHARE = 3, 0.02
#: Template text may make up this share of a page's marked article; beyond it the host's pages
#: are copies of one article, and nothing in it is a template.
TEMPLATE_SHARE = 0.5
#: Inside a marked article being constant isn't enough: a node is template there if it is common
#: and so many distinct pages hold it, is no heading, and its text has at most so many characters.
ARTICLE_PAGES, ARTICLE_CHARS = 20, 200
#: A host of so many distinct pages has a content: the innermost subtree with such a share of the
#: text that varies at each level above it.
CONTENT_PAGES, CONTENT_SHARE = 4, 0.6
#: Text blocks beside a subtree hold the way down above them if so many of the pages have them.
BESIDE_SHARE = 1 / 8
#: A page with less of its text there has another layout.
CONTENT_LEAST = 1 / 3
#: Wrappers of all hosts that are sent to every task; more are joined by host.
BROADCAST_BYTES = 1 << 24

# Elements of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math"}
HIDDEN = RAW | set("head select option button object canvas audio video map dialog datalist".split())
BOILERPLATE = set("nav header footer aside form menu".split())
BOILERPLATE_ROLES = set(
    "navigation banner contentinfo complementary search menu menubar alert alertdialog dialog form note".split()
)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: An opening tag ends an open sibling of these kinds, up to the container.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup summary caption figcaption legend dt th".split())
#: Parts of a text, not places of one: the content holds them together.
TEXT_BLOCKS = HEADINGS | set("p pre blockquote figure table ul ol dl".split())
#: Words of class names and ids that mark boilerplate.
MARKERS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer bottombar sidebar rail "
    "widget cookie cookies consent gdpr notice alert disclaimer popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended recommendations comment comments reply replies "
    "disqus discussion reactions responses pagination pager skip toolbar paywall hidden".split()
)
#: On the document's own frame such words describe the page, not a part of it.
FRAME = {"html", "body", "main", "article"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    attributes: str = ""
    children: list["Node | str"] = field(default_factory=list)
    set_aside: bool = False

    def elements(self) -> list["Node"]:
        return [child for child in self.children if isinstance(child, Node)]


def parse(document: str) -> Node:
    """A tree of the document's elements and texts. Inline elements dissolve into their text."""
    root = Node("#root")
    stack = [root]
    position, end = 0, len(document)
    while position < end:
        match = _TAG.search(document, position)
        text = document[position : match.start() if match else end]
        if text:
            stack[-1].children.append(html.unescape(text))
        if match is None:
            break
        position = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if match[1]:
            _close(stack, name)
        elif name in RAW:
            position = _skip(document, position, name)
        elif name in INLINE and not _is_boilerplate(name, match[3]):
            continue
        elif name == "br" or name == "hr":
            stack[-1].children.append(" ")
        elif name not in VOID:
            _open(stack, name, match[3])
            if match[3].endswith("/") and name not in CLOSES_PARAGRAPH:
                stack.pop()
    return root


def _skip(document: str, position: int, name: str) -> int:
    found = re.compile(rf"</{name}\b[^>]*>", re.I).search(document, position)
    return found.end() if found else (len(document) if name not in ("title", "noscript") else position)


def _open(stack: list[Node], name: str, attributes: str) -> None:
    if name in CLOSES_PARAGRAPH and stack[-1].tag == "p":
        stack.pop()
    if name in ENDS:
        ended, containers = ENDS[name]
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in containers:
                break
            if stack[depth].tag in ended:
                del stack[depth:]
                break
    node = Node(name, attributes, [], _is_boilerplate(name, attributes))
    stack[-1].children.append(node)
    stack.append(node)


def _close(stack: list[Node], name: str) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag == name:
            del stack[depth:]
            return


def _is_boilerplate(name: str, attributes: str) -> bool:
    if name in HIDDEN or name in BOILERPLATE:
        return True
    if not attributes or not attributes.strip(" /"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), html.unescape(values[0] or values[1] or values[2])
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value.lower() in BOILERPLATE_ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id") and name not in FRAME and MARKERS & {w.lower() for w in _WORD.findall(value)}:
            return True
        if key in ("class", "id") and name == "article" and {"comment", "comments", "reply", "ad", "promo", "related"} & {
            w.lower() for w in _WORD.findall(value)
        }:
            return True
    return False


def own_text(node: Node) -> str:
    """The text directly in a node, white space folded."""
    return " ".join("".join(child if isinstance(child, str) else " " for child in node.children).split())


def places(root: Node) -> list[tuple[str, Node]]:
    """Every element with its place: the tags from the root to it."""
    found, todo = [], [("", root)]
    while todo:
        path, node = todo.pop()
        found.append((path, node))
        todo.extend((f"{path}/{child.tag}", child) for child in reversed(node.elements()))
    return found


#: Alignments of more pairs of siblings are computed by rows of numbers.
FEW_CELLS = 2048
#: Shapes of other trees that are kept for the next one.
KNOWN_SHAPES = 256


class Alignment:
    """Simple tree matching of a tree with others: the largest order-keeping alignment of equal tags.

    Only tags count, so that subtrees of equal shape (tags and order) have equal scores; each
    pair of shapes is scored once. Equal shapes at the end of two lists of siblings match, as no
    other partner could be larger. Nothing recurses: pages may be deep.
    """

    def __init__(self, tree):
        self._tree = tree
        self._begin()

    def _begin(self) -> None:
        self._numbers: dict[tuple, int] = {}
        self._shapes: list[tuple[str, tuple[int, ...]]] = []
        self._sizes: list[int] = []
        self._scores: dict[tuple[int, int], int] = {}
        self._ours = self._added(self._tree)
        self._most = len(self._shapes) + KNOWN_SHAPES

    def _added(self, root) -> dict[int, tuple[int, list]]:
        """The shape and the children of every node, by the node's id."""
        nodes, lists = [root], []
        for node in nodes:  # grows while it is walked
            children = node.elements()
            lists.append(children)
            nodes += children
        found: dict[int, tuple[int, list]] = {}
        for node, children in zip(reversed(nodes), reversed(lists)):
            shape = (node.tag, tuple([found[id(child)][0] for child in children]))
            number = self._numbers.get(shape)
            if number is None:
                number = self._numbers[shape] = len(self._shapes)
                self._shapes.append(shape)
                self._sizes.append(1 + sum(self._sizes[child] for child in shape[1]))
            found[id(node)] = number, children
        return found

    def to(self, other) -> "Alignment":
        if len(self._shapes) > self._most:
            self._begin()
        self._other, self._theirs = other, self._added(other)
        return self

    def score(self) -> int:
        if self._tree.tag != self._other.tag:
            return 0
        x, y = self._ours[id(self._tree)][0], self._theirs[id(self._other)][0]
        self._prepare([(x, y)])
        return self._score(x, y)

    def pairs(self) -> list[tuple]:
        if self._tree.tag != self._other.tag:
            return []
        found = [(self._tree, self._other)]
        for x, y in found:  # grows while it is walked
            found += self.children(x, y)
        return found

    def _score(self, x: int, y: int) -> int:
        """Of shapes that have been prepared."""
        if x == y:
            return self._sizes[x]
        return self._scores[x, y] if self._shapes[x][0] == self._shapes[y][0] else 0

    def _open(self, x: int, y: int) -> tuple[tuple[int, ...], tuple[int, ...], int]:
        """The children of two shapes without the equal ones at the end, and how many those are."""
        left, right = self._shapes[x][1], self._shapes[y][1]
        same, most = 0, min(len(left), len(right))
        while same < most and left[-1 - same] == right[-1 - same]:
            same += 1
        return left[: len(left) - same], right[: len(right) - same], same

    def _missing(self, left: tuple[int, ...], right: tuple[int, ...]) -> list[tuple[int, int]]:
        shapes, scores = self._shapes, self._scores
        others = set(right)
        return [
            (x, y) for x in set(left) for y in others if x != y and shapes[x][0] == shapes[y][0] and (x, y) not in scores
        ]

    def _prepare(self, todo: list[tuple[int, int]]) -> None:
        """Scores of these pairs of shapes with equal tags, and of all below that they need."""
        while todo:
            x, y = todo[-1]
            if x == y or (x, y) in self._scores:
                todo.pop()
                continue
            left, right, same = self._open(x, y)
            missing = self._missing(left, right) if left and right else []
            if missing:
                todo += missing
                continue
            ended = self._shapes[x][1][len(left) :]
            self._scores[x, y] = 1 + sum(self._sizes[child] for child in ended) + (self._best(left, right) if left and right else 0)
            todo.pop()

    def _best(self, left: tuple[int, ...], right: tuple[int, ...]) -> int:
        if len(left) * len(right) > FEW_CELLS:
            row = None
            for row, _, _ in self._rows(left, right):
                pass
            return int(row[-1])
        return self._table(left, right)[-1][-1]

    def _table(self, left: tuple[int, ...], right: tuple[int, ...]) -> list[list[int]]:
        best = [[0] * (len(right) + 1)]
        for x in left:
            above, row, most = best[-1], [0], 0
            for j, y in enumerate(right):
                most = max(most, above[j + 1], above[j] + self._score(x, y))
                row.append(most)
            best.append(row)
        return best

    def _rows(self, left: tuple[int, ...], right: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Each row of the table, where it takes a pair, and where it equals the row above."""
        rows: dict[int, np.ndarray] = {}
        above = np.zeros(len(right) + 1, dtype=np.int64)
        for x in left:
            if x not in rows:
                found = {y: self._score(x, y) for y in set(right)}
                rows[x] = np.array([found[y] for y in right], dtype=np.int64)
            taken = above[:-1] + rows[x]
            row = np.append(0, np.maximum.accumulate(np.maximum(above[1:], taken)))
            yield row, (rows[x] > 0) & (row[1:] == taken), row[1:] == above[1:]
            above = row

    def children(self, a, b) -> list[tuple]:
        """The pairs of children of two aligned nodes, last ones first."""
        (x, ours), (y, theirs) = self._ours[id(a)], self._theirs[id(b)]
        if x == y:
            return list(zip(reversed(ours), reversed(theirs)))
        left, right, same = self._open(x, y)
        pairs = [(ours[-1 - k], theirs[-1 - k]) for k in range(same)]
        i, j = len(left), len(right)
        if not i or not j:
            return pairs
        self._prepare(self._missing(left, right))
        if i * j > FEW_CELLS:
            bits = [(np.packbits(taken), np.packbits(up)) for _, taken, up in self._rows(left, right)]
            at = lambda kind, i, j: bits[i - 1][kind][(j - 1) >> 3] >> (7 - ((j - 1) & 7)) & 1
            while i and j:
                if at(0, i, j):
                    i, j = i - 1, j - 1
                    pairs.append((ours[i], theirs[j]))
                elif at(1, i, j):
                    i -= 1
                else:
                    j -= 1
            return pairs
        best = self._table(left, right)
        while i and j:
            score = self._score(left[i - 1], right[j - 1])
            if score and best[i][j] == best[i - 1][j - 1] + score:
                i, j = i - 1, j - 1
                pairs.append((ours[i], theirs[j]))
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return pairs


def match_trees(a, b) -> tuple[int, list[tuple]]:
    """The score of simple tree matching, and the aligned pairs."""
    pairs = Alignment(a).to(b).pairs()
    return len(pairs), pairs


def induce(pages: list[str]) -> list[tuple[str, str]]:
    """The constant ``(place, text)`` pairs of pages of one host; one page has none."""
    first, *others = sorted(set(pages)) or [""]
    if not others:
        return []
    left = constants(outline(parse(first)), (outline(parse(other)) for other in others))
    found = places(parse(first))
    return sorted({(found[at][0], own_text(found[at][1])) for at in left})


@dataclass(eq=False, slots=True)
class Part:
    """A node of a page's outline, or of the merged tree of many pages.

    ``pages`` have the node. ``n`` texts of ``chars`` characters stand there; ``key`` is that of one
    of them and ``lead`` what is left of its count after each other text took one away, so that
    one pass tells the text of more than half of them.
    """

    tag: str
    set_aside: bool = False
    children: list["Part"] = field(default_factory=list)
    key: int | None = None
    chars: int = 0
    pages: int = 1
    n: int = 0
    lead: int = 0

    def elements(self) -> list["Part"]:
        return self.children


def outline(root: Node) -> Part:
    """All elements of a page, with the keys of their places and texts."""
    top = Part(root.tag)
    todo = [("", root, top)]
    while todo:
        path, node, part = todo.pop()
        text = own_text(node)
        if text:
            part.key, part.chars, part.n, part.lead = node_key(path, text), len(text), 1, 1
        for child in node.elements():
            made = Part(child.tag, child.set_aside)
            part.children.append(made)
            todo.append((f"{path}/{child.tag}", child, made))
    return top


def constants(reference: Part, pages: Iterable[Part]) -> dict[int, int]:
    """The keys of those nodes of a page that have the same text on all others, by their order on it."""
    left = [(at, part) for at, part in enumerate(_parts(reference)) if part.key is not None]
    alignment = Alignment(reference)
    for page in pages:
        if not left:
            break
        same = {id(x) for x, y in alignment.to(page).pairs() if x.key is not None and x.key == y.key}
        left = [(at, part) for at, part in left if id(part) in same]
    return {at: part.key for at, part in left}


def merged(pages: list[str]) -> Part | None:
    """One tree of all distinct pages."""
    return merge(outline(parse(page)) for page in sorted(set(pages)))


def merge(trees: Iterable[Part]) -> Part | None:
    """One tree: aligned nodes are one, the others stand between their neighbours."""
    merging = iter(trees)
    tree = next(merging, None)
    alignment = None
    for other in merging:
        alignment = alignment or Alignment(tree)
        if _put_in(alignment.to(other).pairs()):
            alignment = None
    return tree


def _put_in(pairs: list[tuple[Part, Part]]) -> bool:
    """Adds the second tree of aligned pairs to the first; tells whether that has grown."""
    aligned, grown = {id(y): x for x, y in pairs}, False
    for x, y in pairs:
        if x.key is None or x.key == y.key or y.key is None:
            x.key, x.lead = y.key if x.key is None else x.key, x.lead + y.lead
        else:
            x.key, x.lead = x.key if x.lead >= y.lead else y.key, abs(x.lead - y.lead)
        x.pages, x.n, x.chars = x.pages + y.pages, x.n + y.n, x.chars + y.chars
        if all(id(child) in aligned for child in y.children):
            continue
        children, at, grown = [], 0, True
        for child in y.children:
            same = aligned.get(id(child))
            if same is None:
                children.append(child)
                continue
            while x.children[at] is not same:
                children.append(x.children[at])
                at += 1
            children.append(same)
            at += 1
        x.children = children + x.children[at:]
    return grown


def _parts(tree: Part) -> Iterator[Part]:
    """Every node after the one above it, in the order of the page."""
    todo = [tree]
    while todo:
        part = todo.pop()
        yield part
        todo.extend(reversed(part.children))


def _varying(tree: Part) -> dict[int, float]:
    """Characters of the slots in every subtree, what is set aside left out.

    Of the texts of a node most of which are the same only the others count.
    """
    found: dict[int, float] = {}
    for part in reversed(list(_parts(tree))):
        own = part.chars * (1 - part.lead / part.n) if part.n > 1 and 2 * part.lead > part.n else part.chars
        # What stands outside all tags is no part of a content.
        own = 0 if part is tree else own
        found[id(part)] = 0 if part.set_aside else own + sum(found[id(child)] for child in part.children)
    return found


def induce_content(pages: list[str] | Part) -> list | None:
    """The merged tree of a host's pages, or of pages given as such, in a flat form; None without a content.

    The form is the tags of all nodes, how many children each has, and which is the content. The
    way down ends at a marked article and above the blocks of a text, which belong together.
    """
    tree = pages if isinstance(pages, Part) else merged(pages)
    if tree is None or tree.pages < CONTENT_PAGES:
        return None
    varying = _varying(tree)
    part = tree
    while part.tag not in ("article", "main"):
        sizes = [varying[id(child)] for child in part.children]
        if not sizes or max(sizes) < max(1, CONTENT_SHARE * varying[id(part)]):
            break
        best = part.children[sizes.index(max(sizes))]
        beside = any(
            size and child.tag in TEXT_BLOCKS - {"ul", "ol"} and child.pages >= BESIDE_SHARE * tree.pages
            for child, size in zip(part.children, sizes)
            if child is not best
        )
        if best.tag in TEXT_BLOCKS or beside:
            break
        part = best
    if part.tag in ("#root", "html", "body"):
        return None
    parts = list(_parts(tree))
    return [" ".join(p.tag for p in parts), [len(p.children) for p in parts], next(at for at, p in enumerate(parts) if p is part)]


class Wrapper(Alignment):
    """A host's merged tree, and the way from its root to the content."""

    def __init__(self, tree: Part, content: Part):
        super().__init__(tree)
        above = {id(child): part for part in _parts(tree) for child in part.children}
        way = [content]
        while way[-1] is not tree:
            way.append(above[id(way[-1])])
        self.way = way[::-1]
        self.place = "".join(f"/{part.tag}" for part in self.way[1:])


def _as_part(found: list) -> Wrapper:
    tags, counts, content = found
    parts = _grown(tags, counts)
    return Wrapper(parts[0], parts[content])


def _grown(tags: str, counts: list[int]) -> list[Part]:
    """Nodes in the order of the page, each with its children."""
    parts: list[Part] = []
    waiting: list[tuple[Part, int]] = []
    for tag, count in zip(tags.split(" "), counts):
        part = Part(tag)
        if waiting:
            above, left = waiting.pop()
            above.children.append(part)
            if left > 1:
                waiting.append((above, left - 1))
        parts.append(part)
        if count:
            waiting.append((part, count))
    return parts


def packed(tree: Part) -> str:
    """A tree as JSON, column by column."""
    parts = list(_parts(tree))
    tags, counts = " ".join(p.tag for p in parts), [len(p.children) for p in parts]
    columns = zip(*((int(p.set_aside), p.pages, p.key, p.chars, p.n, p.lead) for p in parts))
    return json.dumps([tags, counts, *columns], separators=(",", ":"))


def unpacked(data: str) -> Part:
    tags, counts, *columns = json.loads(data)
    parts = _grown(tags, counts)
    for part, set_aside, pages, key, chars, n, lead in zip(parts, *columns):
        part.set_aside, part.pages, part.key = bool(set_aside), pages, key
        part.chars, part.n, part.lead = chars, n, lead
    return parts[0]


def content_of(root: Node, wrapper: Alignment | None) -> tuple[str, Node] | None:
    """The node of a page that simple tree matching puts on the wrapper's content."""
    if wrapper is None or wrapper.way[0].tag != root.tag:
        return None
    wrapper.to(root)
    node = root
    for above, part in zip(wrapper.way, wrapper.way[1:]):
        node = next((theirs for ours, theirs in wrapper.children(above, node) if ours is part), None)
        if node is None:
            return None
    return None if node.set_aside else (wrapper.place, node)


def node_key(place: str, text: str) -> int:
    """A 64-bit hash of a node's place and text."""
    return xxhash.xxh64_intdigest(f"{place}\n{text}".encode("utf-8", "surrogatepass")) - (1 << 63)


def node_keys(tree: Part) -> list[tuple[int, int]]:
    """The hashes of slot, and of place and text, of all nodes of a page that have a text, each once.

    A slot is a place and whether its text is short, as a container of paragraphs and a line of
    advertising may have the same tags above them. The page is given by its unpacked outline.
    """
    length = lambda part: "short" if part.chars <= ARTICLE_CHARS else "long"
    found, todo = set(), [("", tree)]
    while todo:
        path, part = todo.pop()
        if part.key is not None:
            found.add((node_key(path, length(part)), part.key))
        todo.extend((f"{path}/{child.tag}", child) for child in part.children)
    return sorted(found)


def extract(
    document: str | None,
    template: frozenset[tuple[str, str]],
    common: frozenset[int] = frozenset(),
    frequent: frozenset[int] = frozenset(),
    wrapper: Wrapper | None = None,
) -> str:
    """The main text of one page; empty for an empty or null document.

    ``template`` holds the constant nodes of the host, ``common`` the keys of its common ones, and
    ``frequent`` those of them that ``ARTICLE_PAGES`` hold. Inside a marked article only short
    ``frequent`` nodes are dropped. ``wrapper`` is the host's merged tree. Of several marked
    articles those in the content count, or all if it is one of them.
    """
    if not document:
        return ""
    root = parse(document)
    articles = _articles(root)
    marked = bool(articles)
    if not marked:
        articles = [(place, node) for place, node in places(root) if node.tag == "body"][:1] or [("", root)]
    if marked:
        template, common = frozenset(), frequent
    texts = [_text(node, place, template, common, marked) for place, node in articles]
    content = content_of(root, wrapper)
    if content is not None and not any(node is content[1] for _, node in articles):
        inside = {id(node) for _, node in places(content[1])}
        chosen = [(place, node) for place, node in articles if id(node) in inside] if marked else [content]
        held = [_text(node, place, template, common, marked) for place, node in chosen]
        if held and sum(map(len, held)) >= CONTENT_LEAST * sum(map(len, texts)):
            articles, texts = chosen, held
    if common and marked:
        whole = [_text(node, place, frozenset(), frozenset()) for place, node in articles]
        if sum(map(len, texts)) < (1 - TEMPLATE_SHARE) * sum(map(len, whole)):
            texts = whole
    return " ".join(text for text in texts if text)


def _articles(root: Node) -> list[tuple[str, Node]]:
    """The outermost articles; without one, the outermost main parts."""
    for wanted in ({"article"}, {"main"}):
        found, todo = [], [("", root)]
        while todo:
            path, node = todo.pop()
            is_main = node.tag in wanted or wanted == {"main"} and re.search(
                r"role\s*=\s*[\"']?main\b|itemprop\s*=\s*[\"']?articleBody\b", node.attributes, re.I
            )
            if node.set_aside:
                continue
            if is_main:
                found.append((path, node))
                continue
            todo.extend((f"{path}/{child.tag}", child) for child in reversed(node.elements()))
        if found:
            return found
    return []


def _text(
    node: Node, place: str, template: frozenset[tuple[str, str]], common: frozenset[int], marked: bool = False
) -> str:
    pieces: list[str] = []
    todo: list[tuple[str, Node | str]] = [(place, node)]
    while todo:
        path, item = todo.pop()
        if isinstance(item, str):
            pieces.append(item)
            continue
        if item is not node and item.set_aside:
            pieces.append(" ")
            continue
        pieces.append(" ")
        dropped = False
        if (template or common) and not (marked and item.tag in HEADINGS):
            text = own_text(item)
            dropped = not (marked and len(text) > ARTICLE_CHARS) and _in_wrapper(path, text, template, common)
        todo.append((path, " "))
        for child in reversed(item.children):
            if isinstance(child, Node):
                todo.append((f"{path}/{child.tag}", child))
            else:
                todo.append((path, " " if dropped else child))
    return " ".join("".join(pieces).split())


def _in_wrapper(place: str, text: str, template: frozenset[tuple[str, str]], common: frozenset[int]) -> bool:
    return bool(text) and ((place, text) in template or bool(common) and node_key(place, text) in common)


def outlines(pages: DataFrame) -> DataFrame:
    """``host, rank, outline`` of every distinct page that is not empty, all its nodes included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [packed(outline(parse(document))) for document in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("rank"), pa.array(found, pa.string())], names=["host", "rank", "outline"])

    full = pages.select("host", "rank", "html").where("html != ''")
    return full.mapInArrow(run, "host string, rank bigint, outline string").distinct()


def common_nodes(outlined: DataFrame) -> DataFrame:
    """``host, common, frequent``: the keys of the nodes of a host's template, by count.

    ``common`` are those that ``COMMON_SHARE`` of its distinct pages hold, and those of pools;
    ``frequent`` are the former as far as ``ARTICLE_PAGES`` pages hold them. Every node of every
    page counts, by its outline; only keys move, and a host's rows are summed up before. The
    shares bound what a host has by the nodes of a page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, ranks, found = [], [], []
            for host, rank, data in zip(*(batch.column(name).to_pylist() for name in ("host", "rank", "outline"))):
                keys = node_keys(unpacked(data))
                hosts += [host] * len(keys)
                ranks += [rank] * len(keys)
                found += keys
            columns = [pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in (ranks, [f[0] for f in found], [f[1] for f in found]))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "rank", "slot", "key"])

    nodes = outlined.mapInArrow(run, "host string, rank bigint, slot bigint, key bigint").distinct()
    # Written, as both sides of the join below need it.
    held = stored(nodes.groupBy("host", "slot", "key").agg(F.count("*").alias("n")), "nodes")
    pools = (
        held.groupBy("host", "slot")
        .agg(F.sum("n").alias("on_pages"), F.count("*").alias("texts"))
        .where(F.col("on_pages") >= POOL_PAGES * F.col("texts"))
        .select("host", "slot", F.lit(True).alias("is_pool"))
    )
    of_host = outlined.select("host", "rank").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    share = F.col("n") / F.col("pages")
    widely = share >= COMMON_SHARE
    return (
        held.where(F.col("n") >= COMMON_PAGES)
        .join(of_host, "host")
        .where(share >= POOL_SHARE)
        .join(pools, ["host", "slot"], "left")
        .where(widely | F.col("is_pool"))
        .groupBy("host")
        .agg(
            F.sort_array(F.collect_list("key")).alias("common"),
            F.sort_array(F.collect_list(F.when(widely & (F.col("n") >= ARTICLE_PAGES), F.col("key")))).alias("frequent"),
        )
    )


_TREES = "host string, part bigint, parts bigint, tree string, constant string"


def merged_trees(outlined: DataFrame) -> DataFrame:
    """``host, tree, constant``: the merged tree of all distinct pages of every host, and their constant nodes.

    Constant are the nodes of a host's first page by rank whose text every other page has too,
    where it is aligned with that page. A host's pages are dealt by rank to parts of some
    ``MERGED_PAGES`` each, which are aligned and merged apart; then the trees of so many parts are
    merged, and so on. No task holds more of a host than that many pages or trees, and what comes
    out doesn't depend on how the rows are dealt out.
    """
    hosts = outlined.groupBy("host").agg(F.min("rank").alias("first"), F.ceil(F.count("*") / MERGED_PAGES).alias("parts"))
    dealt = outlined.join(hosts, "host").select(
        "host", "parts", F.pmod("rank", "parts").alias("part"), F.lit(False).alias("reference"), "rank", "outline", (F.col("rank") == F.col("first")).alias("is_first")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    references = dealt.where("is_first").select("host", "parts", every, F.lit(True).alias("reference"), "rank", "outline")
    rows = dealt.drop("is_first").unionByName(references)

    def of_pages(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["rank", "outline"])
        is_reference = group["reference"]
        reference = unpacked(group["outline"][is_reference].iloc[0])
        pages = [unpacked(data) for data in group["outline"][~is_reference]]
        left = constants(reference, pages)
        return made(group, merge(pages), left)

    def of_trees(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) == 1:
            return group.assign(part=group["part"] // MERGED_PAGES)[names]
        group = group.sort_values("part")
        found = [dict(json.loads(data)) for data in group["constant"]]
        left = {at: key for at, key in found[0].items() if all(at in other for other in found)}
        return made(group.assign(part=group["part"] // MERGED_PAGES), merge(map(unpacked, group["tree"])), left)

    def made(group: pd.DataFrame, tree: Part | None, left: dict[int, int]) -> pd.DataFrame:
        host, part, parts = (group[name].iloc[0] for name in names[:3])
        # A part to which no page was dealt has only the reference.
        data = "" if tree is None else packed(tree)
        return pd.DataFrame([[host, part, parts, data, json.dumps(sorted(left.items()))]], columns=names)

    names = ["host", "part", "parts", "tree", "constant"]
    trees = stored(rows.groupBy("host", "part").applyInPandas(of_pages, _TREES).where("tree != ''"), "trees")
    most = hosts.agg(F.max("parts")).first()[0] or 1
    while most > 1:
        merging = trees.groupBy("host", F.floor(F.col("part") / MERGED_PAGES).alias("next"))
        trees = stored(merging.applyInPandas(of_trees, _TREES), "trees")
        most = -(-most // MERGED_PAGES)
    return trees.select("host", "tree", "constant")


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper``: content, constant and common nodes of every host's pages as JSON.

    ``pages`` has ``host``, ``rank`` (any hash of the page) and ``html``. All distinct pages of a
    host, with all their nodes, take part in the alignment, in the merged tree and in the count of
    common nodes.
    """
    prepare(pages.sparkSession)
    outlined = stored(outlines(pages), "outlines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data, left in zip(batch.column("tree").to_pylist(), batch.column("constant").to_pylist()):
                tree = unpacked(data)
                constant = sorted({key for _, key in json.loads(left)}) if tree.pages > 1 else []
                found.append(json.dumps({"constant": constant, "content": induce_content(tree)}))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(found, pa.string())], names=["host", "wrapper"])

    aligned = merged_trees(outlined).mapInArrow(run, "host string, wrapper string")
    common, frequent = (F.coalesce(F.to_json(name), F.lit("[]")) for name in ("common", "frequent"))
    wrapper = F.concat(F.lit('{"aligned":'), "wrapper", F.lit(',"common":'), common, F.lit(',"frequent":'), frequent, F.lit("}"))
    return aligned.join(common_nodes(outlined), "host", "left").select("host", wrapper.alias("wrapper"))


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page; a null or empty page has an empty text.

    Pages without a host (null url) share one wrapper. Repeated rows each give a row. Other
    columns are not read.
    """
    prepare(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("bigint"),
        "url",
        "html",
        F.coalesce(url_filter.host(F.col("url")), F.lit("")).alias("host"),
        F.xxhash64("html").alias("rank"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, tuple] = {None: (frozenset(),)}
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("page_id", "url", "html", "wrapper")]
            done = []
            for page_id, url, document, wrapper in zip(*columns):
                if wrapper not in known:
                    if len(known) > 500:
                        known = {None: (frozenset(),)}
                    parts = json.loads(wrapper)
                    aligned = parts["aligned"]
                    known[wrapper] = (
                        frozenset(),
                        frozenset(aligned["constant"] + parts["common"]),
                        frozenset(parts["frequent"]),
                        _as_part(aligned["content"]) if aligned["content"] else None,
                    )
                text = extract(document, *known[wrapper])
                done.append({"page_id": page_id, "url": url, "text": text, "n_chars": len(text)})
            yield pa.RecordBatch.from_pylist(done, schema=_TEXTS)

    found = stored(wrappers(rows), "wrappers")
    size = found.agg(F.sum(F.octet_length("host") + F.octet_length("wrapper"))).first()[0] or 0
    # Beyond the limit the pages move to the wrappers of their hosts.
    side = F.broadcast(found) if size <= BROADCAST_BYTES else found
    return (
        rows.select("page_id", "url", "html", "host")
        .join(side, "host", "left")
        .select("page_id", "url", "html", "wrapper")
        .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
    )
