"""Main text of web pages by wrapper induction.

Pages of one host come from a few templates. The shape that most pages of a host have is its reference, with which every
page's tree is aligned by simple tree matching: the largest set of pairs of equal tags that keeps parents and order.
So a text's place is the node of the reference it is aligned with, which is the same in layouts that differ in
classes or in optional parts; its path of tags and classes is another place, for what the reference does not have. The texts
at each place are counted over all pages of a host, and over those of each layout, which have the same elements
with text near the root. A text that stands in its place on nearly all of these different pages (those whose
texts differ) is part of the template; places whose text varies hold content. What is template in one layout
is so on the whole host. A page's text is then its content places, without the regions whose tag, role or class
says that they are a menu, header, footer, sidebar, notice, advert, form or readers' comments. Where a page marks articles or a
main part, all of these and nothing else are its text. Inside them names count only where a section's class says nothing
else, and template texts stay in an article. Time grows with the length of a page, however deep its elements nest.

White space in a block becomes one blank, and blocks are joined by line feeds; ``br`` is white space. Null or empty html
gives an empty text, a null url belongs to a host of its own, pages without closed tags are read to their end.
Rows may repeat; other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from html import unescape
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_parts, saved

#: Different pages a host or layout needs before anything counts as its template.
LEAST_PAGES = 3
#: Part of the pages that a template text stands on.
CONSTANT = 0.8
#: Elements of a path, from the root, that make the layout.
LAYOUT_DEPTH = 3
#: Deeper elements are aligned as texts of their ancestor at this depth.
DEEPEST = 100
#: Cells that a table of two nodes' children keeps; of a larger one some rows are kept and the others computed again.
MOST_CELLS = 4_000_000
#: Sizes of matches that a task keeps.
KNOWN_SIZES = 1_000_000
#: Answers that a task keeps.
KNOWN_SHAPES = 4096

# Names from the HTML standard, and words sites use in class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
DROPPED_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input iframe svg canvas "
    "object dialog menu title datalist".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notification alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget related recommended recommendations share sharing social footer masthead "
    "comment comments commentlist commentform commentarea disqus replies respond pagination pager copyright header "
    "siteheader pageheader topheader sitefooter pagefooter topbar toolbar topnav sidenav sidemenu mainmenu navmenu "
    "subnav search searchform searchbox adbox adslot adsense adunit cookiebar cookiebanner cookieconsent announcement".split()
)
#: Words before "header" in the name of an article's own heading.
OWN_HEADER = frozenset("post entry article story content".split())
#: Elements that a region inside an article can be, and words its name may have beside those above.
REGIONS = frozenset("div section ul ol dl table figure fieldset article".split())
PLAIN_WORDS = frozenset(
    "area bar block body box btn button buttons container content entry form group icon icons inline inner item items link links "
    "list main module outer panel post posts row section slot text thread title top bottom unit wrap wrapper".split()
)
#: Words that say an article is a reader's or another one, unless all articles of the page are such.
SIDE_WORDS = frozenset(
    "comment comments commentlist commentform commentarea disqus replies respond related recommended recommendations sidebar "
    "widget teaser teasers".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist commentform commentarea disqus replies respond".split())
LAYOUT_WORDS = frozenset("has with no without layout".split())
#: A start tag in this list closes an open element of its own kind of content.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
#: Elements that an implied end does not reach beyond.
_WALLS = frozenset("body article section div main ul ol dl table blockquote form nav aside header footer fieldset button".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>|</?([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Page:
    """The elements of a page in order, and its texts.

    Element i has a tag, the number of its parent (-1: none), attributes, and a signature of its path. ``events`` has
    (number, True) where an element starts, (number, False) where it ends and (number, text) for a text in it.
    """

    def __init__(self, html: str) -> None:
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.attributes: list[dict[str, str]] = []
        self.signatures: list[int] = []
        self.events: list[tuple[int, bool | str]] = []
        self._n_open: Counter[str] = Counter()
        self._parse(html)

    def _parse(self, html: str) -> None:
        open_: list[int] = []
        at = 0
        events = self.events
        while at < len(html):
            found = _TAG.search(html, at)
            begin = found.start() if found else len(html)
            if begin > at:
                events.append((open_[-1] if open_ else -1, html[at:begin]))
            if not found:
                break
            at = found.end()
            name = found[1] or found[3]
            if not name:
                continue
            name = name.lower()
            if html[begin + 1] == "/":
                self._close(open_, name)
                continue
            self._imply(open_, name)
            self._open(open_, name, found[2] or found[4] or "")
            if name in RAW:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                at = end.start() if end else len(html)
            elif name in VOID:
                self._end(open_, len(open_) - 1)
        self._end(open_, 0)

    def _end(self, open_: list[int], k: int) -> None:
        """Ends the open elements from place k on."""
        while len(open_) > k:
            self._n_open[self.tags[open_[-1]]] -= 1
            self.events.append((open_.pop(), False))

    def _open(self, open_: list[int], name: str, rest: str) -> None:
        attributes = {}
        for key, value in _ATTRIBUTE.findall(rest) if rest else ():
            attributes.setdefault(key.lower(), unescape(value.strip("\"'")))
        parent = open_[-1] if open_ else -1
        kind = f"{name}.{' '.join(sorted(attributes.get('class', '').split()))}"
        self.tags.append(name)
        self.parents.append(parent)
        self.attributes.append(attributes)
        above = self.signatures[parent] if open_ else 0
        self.signatures.append(zlib.crc32(kind.encode("utf-8", "surrogatepass"), above))
        self.events.append((len(self.tags) - 1, True))
        open_.append(len(self.tags) - 1)
        self._n_open[name] += 1

    def _close(self, open_: list[int], name: str) -> None:
        """Ends the last open element of that name and all in it; a stray end tag does nothing."""
        if not self._n_open[name]:
            return
        for k in range(len(open_) - 1, -1, -1):
            if self.tags[open_[k]] == name:
                self._end(open_, k)
                return
            if self.tags[open_[k]] in _WALLS and name in INLINE | {"p"}:
                return

    def _imply(self, open_: list[int], name: str) -> None:
        closes = CLOSES.get(name) or ({"p"} if name not in INLINE and name not in DROPPED_TAGS - _WALLS else None)
        if not closes or not any(self._n_open[c] for c in closes):
            return
        for k in range(len(open_) - 1, -1, -1):
            tag = self.tags[open_[k]]
            if tag in closes:
                self._end(open_, k)
                if closes == {"p"}:
                    return
            elif tag in _WALLS:
                return

    def regions(self) -> tuple[list[bool], list[bool], list[bool]]:
        """Of each element: whether it is in a dropped region, in a marked main part, and in a marked article."""
        n = len(self.tags)
        side, marked = [False] * n, [False] * n
        for i in range(n):
            parent = self.parents[i]
            side[i] = (parent >= 0 and side[parent]) or self._is_side(i)
            marked[i] = not side[i] and (self.is_main(i, "article") or self.is_main(i, "main"))
        if not any(marked):
            marked = [self.is_main(i, "article") or self.is_main(i, "main") for i in range(n)]
        holds_main = list(marked)
        for i in range(n - 1, -1, -1):
            if holds_main[i] and self.parents[i] >= 0:
                holds_main[self.parents[i]] = True
        out, inside, article = [False] * n, [False] * n, [False] * n
        for i, tag in enumerate(self.tags):
            parent = self.parents[i]
            within = parent >= 0 and inside[parent]
            inside[i] = within or marked[i]
            article[i] = (parent >= 0 and article[parent]) or (marked[i] and tag == "article")
            out[i] = (
                (parent >= 0 and out[parent])
                # A form around the article is the page's own, not one to fill in.
                or (tag in DROPPED_TAGS and not (tag == "form" and holds_main[i]))
                or (tag == "header" and not within)
                or self._names_other(i, holds_main[i] and not marked[i], within)
            )
        return out, inside, article

    def _is_side(self, i: int) -> bool:
        own = self.attributes[i]
        return bool(own) and self.tags[i] not in ("html", "body") and any(
            words[0] not in LAYOUT_WORDS and SIDE_WORDS.intersection(words)
            for words in map(_words, f"{own.get('class', '')} {own.get('id', '')}".split())
            if words
        )

    def _names_other(self, i: int, holds_main: bool, inside: bool) -> bool:
        own = self.attributes[i]
        if not own or self.tags[i] in ("html", "body"):
            return False
        if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(own.get("style", "")):
            return True
        if holds_main:
            return False
        if own.get("role", "").lower() in DROPPED_ROLES:
            return True
        if inside:
            return self._names_other_inside(own, self.tags[i])
        for name in f"{own.get('class', '')} {own.get('id', '')}".split():
            words = _words(name)
            if not words or words[0] in LAYOUT_WORDS or words[-1] == "free":
                continue
            found = DROPPED_WORDS.intersection(words)
            if found == {"header"} and OWN_HEADER.intersection(words):
                continue
            if found:
                return True
        return False

    @staticmethod
    def _names_other_inside(own: dict[str, str], tag: str) -> bool:
        """In an article: a section whose class holds nothing but such words, or whose id says comments."""
        if tag not in REGIONS:
            return False
        for name in own.get("class", "").split():
            words = _words(name)
            found = DROPPED_WORDS.intersection(words) - {"header", "footer"}
            if found and DROPPED_WORDS.union(PLAIN_WORDS).issuperset(words):
                return True
        return any(COMMENT_WORDS.intersection(_words(name)) for name in own.get("id", "").split())

    def is_main(self, i: int, kind: str) -> bool:
        return self.tags[i] == kind or (kind == "main" and self.attributes[i].get("role", "").lower() == "main")

    def blocks(self, dropped: list[bool]) -> Iterator[tuple[int, str, int]]:
        """(element, text, characters in links) of each block with text outside dropped regions."""
        block_of: list[int] = []
        for i, tag in enumerate(self.tags):
            parent = self.parents[i]
            block_of.append(i if tag not in INLINE else block_of[parent] if parent >= 0 else -1)
        linked = [False] * len(self.tags)
        for i, tag in enumerate(self.tags):
            linked[i] = tag == "a" or (self.parents[i] >= 0 and linked[self.parents[i]])
        parts: list[str] = []
        in_links = 0
        here = -1
        for i, what in self.events:
            if isinstance(what, str):
                if i < 0 or not dropped[i]:
                    text = unescape(what)
                    if not parts:
                        here = block_of[i] if i >= 0 else -1
                    parts.append(text)
                    if i >= 0 and linked[i]:
                        in_links += len("".join(text.split()))
                continue
            if self.tags[i] == "br":
                parts and parts.append(" ")
            elif block_of[i] == i and parts:
                text = " ".join("".join(parts).split())
                if text:
                    yield here, text, in_links
                parts, in_links = [], 0
        text = " ".join("".join(parts).split())
        if text:
            yield here, text, in_links


def _words(name: str) -> list[str]:
    return [word.lower() for word in _CAMEL.findall(name)]


class Tree:
    """The elements that lead to a page's texts, by their tags; like siblings without children stand as one node.

    ``shape`` spells the tree: depth and tag of each node, in order. Nodes are numbered in that order; ``node_of`` tells the
    node of each block. Elements deeper than DEEPEST stand as their ancestor at that depth.
    """

    def __init__(self, page: Page, blocks: Sequence[tuple[int, str, int]]) -> None:
        parents = page.parents
        depth, top = [0] * len(parents), list(range(len(parents)))
        for i, parent in enumerate(parents):
            if parent >= 0:
                depth[i] = depth[parent] + 1
                if depth[i] >= DEEPEST:
                    top[i] = top[parent]
        wanted: set[int] = set()
        for i, _, _ in blocks:
            k = top[i] if i >= 0 else -1
            while k >= 0 and k not in wanted:
                wanted.add(k)
                k = parents[k]
        leaf = wanted - {parents[k] for k in wanted}
        number: dict[int, int] = {-1: -1}
        nodes: list[str] = []
        last: dict[int, tuple[str, int]] = {}  # parent: tag and node of its last child, if that is a leaf
        for k in sorted(wanted):
            tag, parent = page.tags[k], parents[k]
            if k in leaf and last.get(parent, ("", 0))[0] == tag:
                number[k] = last[parent][1]
                continue
            number[k] = len(nodes)
            nodes.append(f"{depth[k]}{tag}")
            last[parent] = (tag if k in leaf else "", number[k])
        self.shape = " ".join(nodes)
        self.node_of = [number[top[i]] if i >= 0 else -1 for i, _, _ in blocks]


class Node:
    """A node of a shape: its number, tag, children, the number of nodes in it, and what tells it from others."""

    __slots__ = ("number", "tag", "children", "size", "key")

    def __init__(self, number: int, tag: str) -> None:
        self.number, self.tag = number, tag
        self.children: list[Node] = []
        self.size, self.key = 1, 0


_SHAPED = re.compile(r"([0-9]+)(\S*)")


def parse_shape(shape: str, keys: dict[tuple, int]) -> Node:
    """The tree a shape spells. Equal subtrees get equal keys, which ``keys`` hands out."""
    root = Node(-1, "")
    path, depths = [root], [-1]
    done: list[Node] = []
    for number, word in enumerate(shape.split()):
        depth, tag = _SHAPED.fullmatch(word).groups()
        while depths[-1] >= int(depth):
            path.pop()
            depths.pop()
        node = Node(number, tag)
        path[-1].children.append(node)
        path.append(node)
        depths.append(int(depth))
        done.append(node)
    for node in [*reversed(done), root]:
        node.size = 1 + sum(child.size for child in node.children)
        node.key = keys.setdefault((node.tag, *(child.key for child in node.children)), len(keys))
    return root


class Matcher:
    """Simple tree matching of pages with their host's reference tree; equal questions are answered once."""

    def __init__(self) -> None:
        self._keys: dict[tuple, int] = {}
        self._weights: dict[tuple[int, int], int] = {}
        self._found: dict[tuple[str, str], list[int]] = {}

    def __call__(self, reference: str, shape: str) -> list[int]:
        """For each node of ``shape`` the matched node of ``reference``, or -1."""
        found = self._found.get((reference, shape))
        if found is None:
            if len(self._found) >= KNOWN_SHAPES:
                self._keys, self._weights, self._found = {}, {}, {}
            own, other = parse_shape(shape, self._keys), parse_shape(reference, self._keys)
            found = [-1] * (own.size - 1)
            self._pairs(own, other, found)
            self._found[reference, shape] = found
        return found

    def size(self, a: Node, b: Node) -> int:
        """The number of pairs in the largest match of two trees that keeps roots, parents and order."""
        if a.tag != b.tag:
            return 0
        if a.key == b.key:
            return a.size
        size = self._weights.get((a.key, b.key))
        if size is None:
            same, rows, columns = _ends_alike(a.children, b.children)
            size = 1 + sum(x.size for x, _ in same)
            if rows and columns:
                size += _Alignment(self, columns).largest(rows)
            if len(self._weights) >= KNOWN_SIZES:
                self._weights.clear()
            self._weights[a.key, b.key] = size
        return size

    def _pairs(self, a: Node, b: Node, found: list[int]) -> None:
        if a.number >= 0:
            found[a.number] = b.number
        same, rows, columns = _ends_alike(a.children, b.children)
        if rows and columns:
            same += _Alignment(self, columns).pairs(rows)
        for x, y in same:
            self._pairs(x, y, found)


class _Alignment:
    """Largest matches of lists of siblings with given ones, the columns, in order.

    ``best[i][j]`` is that of the first i rows and j columns; a row of this table follows from the one above it.
    """

    def __init__(self, matcher: Matcher, columns: list[Node]) -> None:
        self.matcher, self.columns = matcher, columns
        kinds: dict[int, int] = {}
        self.place = np.array([kinds.setdefault(x.key, len(kinds)) for x in columns])
        first = {x.key: x for x in reversed(columns)}
        self.kinds = [first[key] for key in kinds]
        self.known: dict[int, np.ndarray] = {}

    def below(self, above: np.ndarray, x: Node) -> np.ndarray:
        """The table's row of a sibling."""
        sizes = self.known.get(x.key)
        if sizes is None:
            if len(self.known) * len(self.kinds) >= KNOWN_SIZES:
                self.known.clear()
            sizes = self.known[x.key] = np.array([self.matcher.size(x, y) for y in self.kinds], np.int32)
        best = np.zeros(len(above), np.int32)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + sizes[self.place]), out=best[1:])
        return best

    def largest(self, rows: list[Node]) -> int:
        best = np.zeros(len(self.columns) + 1, np.int32)
        for x in rows:
            best = self.below(best, x)
        return int(best[-1])

    def pairs(self, rows: list[Node]) -> list[tuple[Node, Node]]:
        """The pairs of a largest match, from the last; the same ones however many rows of the table are kept."""
        n = len(rows)
        stride = n if n * len(self.columns) <= MOST_CELLS else isqrt(n)
        starts = range(0, n, stride)
        kept = [np.zeros(len(self.columns) + 1, np.int32)]
        for start in starts[:-1]:
            best = kept[-1]
            for x in rows[start : start + stride]:
                best = self.below(best, x)
            kept.append(best)
        found, i, j = [], n, len(self.columns)
        for start in reversed(starts):
            table = [kept.pop()]
            for x in rows[start:i]:
                table.append(self.below(table[-1], x))
            while i > start and j:
                here, above = table[i - start], table[i - start - 1]
                if here[j] == above[j]:
                    i -= 1
                elif here[j] == here[j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    found.append((rows[i], self.columns[j]))
            if not j:
                break
        return found


def _ends_alike(a: list[Node], b: list[Node]) -> tuple[list[tuple[Node, Node]], list[Node], list[Node]]:
    """Equal subtrees at both ends, which some largest match pairs, and what is between."""
    start, most = 0, min(len(a), len(b))
    while start < most and a[start].key == b[start].key:
        start += 1
    end = 0
    while end < most - start and a[-1 - end].key == b[-1 - end].key:
        end += 1
    pairs = [*zip(a[:start], b[:start]), *zip(a[len(a) - end :], b[len(b) - end :])]
    return pairs, a[start : len(a) - end], b[start : len(b) - end]


def _blocks(html: str) -> tuple[Page, tuple[list[bool], list[bool], list[bool]], list[tuple[int, str, int]]]:
    page = Page(html)
    regions = page.regions()
    return page, regions, list(page.blocks(regions[0]))


@dataclass
class Parts:
    """What a page's texts are known by: its layout and shape, and of each block the node, the path and a hash of the text."""

    layout: int
    shape: str
    nodes: list[int]
    paths: list[int]
    texts: list[int]

    def numbers(self, reference: str, matcher: Matcher) -> list[tuple[int, int | None]]:
        """Of each block: its place by path, and by the node of the reference that it is aligned with."""
        aligned = matcher(reference, self.shape)
        nodes = (aligned[n] if n >= 0 else -1 for n in self.nodes)
        return [
            (path << 31 ^ text, -1 - (node << 32 ^ text) if node >= 0 else None)
            for path, text, node in zip(self.paths, self.texts, nodes, strict=True)
        ]

    def places(self, reference: str, matcher: Matcher) -> list[int]:
        """The different places by path and by node, in order."""
        return sorted({place for both in self.numbers(reference, matcher) for place in both if place is not None})


def _parts(page: Page, blocks: list[tuple[int, str, int]]) -> Parts:
    tree = Tree(page, blocks)
    depth, top = [0] * len(page.tags), list(range(len(page.tags)))
    for i, parent in enumerate(page.parents):
        if parent >= 0:
            depth[i] = depth[parent] + 1
            if depth[i] >= LAYOUT_DEPTH:
                top[i] = top[parent]
    near = {page.signatures[top[i]] for i, _, _ in blocks if i >= 0}
    return Parts(
        zlib.crc32(repr(sorted(near)).encode()),
        tree.shape,
        tree.node_of,
        [page.signatures[i] if i >= 0 else 0 for i, _, _ in blocks],
        [zlib.crc32(text.encode("utf-8", "surrogatepass")) for _, text, _ in blocks],
    )


def parts_of(html: str) -> Parts:
    page, _, blocks = _blocks(html)
    return _parts(page, blocks)


def main_text(html: str, template: Iterable[int] = (), reference: str = "", matcher: Matcher | None = None) -> str:
    """The page's content without the texts of its host's template."""
    page, (_, inside, article), blocks = _blocks(html)
    template = frozenset(template)
    if template:
        numbers = _parts(page, blocks).numbers(reference, matcher or Matcher())
        blocks = [
            block
            for block, (place, slot) in zip(blocks, numbers, strict=True)
            if (block[0] >= 0 and article[block[0]]) or not (place in template or slot in template)
        ]
    main = [text for i, text, _ in blocks if i >= 0 and inside[i]]
    if main:
        return "\n".join(main)
    # No article is marked: blocks that are little more than links are menus.
    return "\n".join(text for _, text, links in blocks if 2 * links <= len("".join(text.split())))


def reference_of(shapes: Iterable[str]) -> str:
    """The most frequent shape of a host's pages, of equals the greatest."""
    counts = Counter(shapes)
    return max(counts, key=lambda shape: (counts[shape], shape.encode()), default="")


def induce(pages: Sequence[str]) -> tuple[str, list[int]]:
    """The reference of pages of one host, and their template: what nearly all of them or of one layout share."""
    every, matcher = [parts_of(page) for page in pages], Matcher()
    reference = reference_of(parts.shape for parts in every)
    groups: dict[int | None, list[tuple[int, ...]]] = {}
    for layout, found in {(parts.layout, tuple(parts.places(reference, matcher))) for parts in every}:
        groups.setdefault(None, []).append(found)
        groups.setdefault(layout, []).append(found)
    template: set[int] = set()
    for group in groups.values():
        counts = Counter(place for found in group for place in found)
        if len(group) >= LEAST_PAGES:
            template.update(place for place, n in counts.items() if n >= CONSTANT * len(group))
    return reference, sorted(template)


def host(url: Column) -> Column:
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1))


_PARTS = "host string, layout bigint, shape string, nodes array<int>, paths array<bigint>, texts array<bigint>"


def page_parts(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The parts of every page with html, and its host."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        kinds = (pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32()), longs, longs)
        out = pa.schema(list(zip(("host", "layout", "shape", "nodes", "paths", "texts"), kinds, strict=True)))

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for name, html in zip(batch["host"], batch["html"], strict=True):
                p = parts_of(html.as_py())
                yield name.as_py(), p.layout, p.shape, p.nodes, p.paths, p.texts

        for batch in batches:
            yield from in_parts(rows(batch), out, 1000)

    rows = pages.select(host(F.col(f"`{url_col}`")).alias("host"), F.col(f"`{html_col}`").alias("html"))
    return rows.where("html is not null").mapInArrow(run, _PARTS)


def references(parts: DataFrame) -> DataFrame:
    """Rows (host, reference): the shape that most of a host's pages have, as ``reference_of`` over all of them."""
    counts = parts.groupBy("host", "shape").agg(F.count("*").alias("n"))
    return counts.groupBy("host").agg(F.max(F.struct("n", "shape"))["shape"].alias("reference"))


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (host, reference, template), one for each host with pages; as ``induce`` over all of them.

    Every page counts, of pages with equal texts one. Pages are parsed once, and only their parts meet the
    reference of their host. Counts are summed in each task before the shuffle.
    """
    parts = saved(page_parts(pages, url_col, html_col), "page-parts")
    known = saved(references(parts), "references")
    rows = parts.join(known, "host")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("host", pa.string()), ("layout", pa.int64()), ("places", pa.list_(pa.int64()))])
        matcher = Matcher()

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            columns = (batch[c] for c in ("host", "layout", "shape", "nodes", "paths", "texts", "reference"))
            for row in zip(*columns, strict=True):
                name, *parts, reference = (value.as_py() for value in row)
                yield name, parts[0], Parts(*parts).places(reference, matcher)

        for batch in batches:
            yield from in_parts(rows(batch), out, 1000)

    schema = "host string, layout bigint, places array<bigint>"
    found = rows.mapInArrow(run, schema).withColumn("page", F.xxhash64("places"))
    once = found.groupBy("host", "layout", "page").agg(F.first("places").alias("places"))
    once = saved(once, "page-places")

    def constant(*group: str) -> DataFrame:
        n_pages = once.groupBy(*group).agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= LEAST_PAGES)
        counts = once.select(*group, F.explode("places").alias("place")).groupBy(*group, "place").count()
        counts = counts.where(F.col("count") >= CONSTANT * LEAST_PAGES)
        return counts.join(n_pages, [*group]).where(F.col("count") >= CONSTANT * F.col("n_pages")).select("host", "place")

    both = constant("host").union(constant("host", "layout"))
    found = both.groupBy("host").agg(F.sort_array(F.collect_set("place")).alias("template"))
    none = F.array().cast("array<bigint>")
    return known.join(found, "host", "left").select("host", "reference", F.coalesce("template", none).alias("template"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (id, url, text), one for each row of ``pages``."""
    known = saved(templates(pages, url_col, html_col), "templates")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"),
        host(F.col(f"`{url_col}`")).alias("host"),
    )
    rows = rows.join(known, "host", "left").select("id", "url", "html", "reference", "template")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher()
        for batch in batches:
            out = pa.schema([batch.schema.field("id"), batch.schema.field("url"), pa.field("text", pa.string())])

            def found(batch: pa.RecordBatch = batch) -> Iterator[tuple]:
                for i in range(len(batch)):
                    html, reference, template = (batch[c][i].as_py() for c in ("html", "reference", "template"))
                    text = main_text(html or "", template or (), reference or "", matcher)
                    yield batch["id"][i].as_py(), batch["url"][i].as_py(), text

            yield from in_parts(found(), out, 1000)

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, url string, text string")
