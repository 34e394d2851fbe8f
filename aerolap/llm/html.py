"""Main text of web pages by tree scoring.

A page becomes a tree of block elements. Each run of text in a block is a
paragraph; its points (one, one per comma, up to three for length) pass to the
enclosing elements, whole to the nearest, half to the next and less further
up. A container's points are discounted by the share of its text that lies in
links, and raised or lowered by what its tag and class names say. The best
container says where the main text is. Inside an article or main element
that whole element is kept, with what reads like text beside it. Without one
the best container is kept and, on the way up from it, siblings that are not
mostly links; but a plain container (a div or cell) under other class or id
names than the one on the way is another part of the page, and stays only if
its score is a fifth of the best (and 10), or its names are an article's. Below
the nearest ancestor named as an article, all siblings but links stay. Menus, headers, footers, sidebars, notices, adverts,
forms, scripts and reader comments are taken out of the tree before, known by
tag, role or whole class and id names, and hidden elements; but not an element
that holds most of the page's unlinked text while no other article has any.
Where an element ends is the same for them as for others, end tags left out
included.

Pages are independent of each other: one Arrow map pass, no shuffle. The time
for a page grows with its length, however deep its elements are nested: open
elements are found by tag and by pointers to the nearest one that ends an
implied close, sums are made bottom-up, ranges of paragraphs by prefix sums.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from operator import add, mul

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aerolap.llm.common import mapped, quoted

# HTML element names by what they do here.
BLOCKS = frozenset("""
    address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
    section summary table tbody td tfoot th thead tr ul caption
    """.split())
ROWS = frozenset("thead tbody tfoot tr".split())
CELLS = frozenset("td th".split())
IN_ITEMS = frozenset("address div p".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object canvas audio video textarea title select".split())
UNWANTED_TAGS = frozenset("nav header footer aside form menu dialog button fieldset head".split())
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
UNWANTED_NAMES = frozenset("""
    ad ads adv advert adverts advertisement advertisements adbox adsense banner breadcrumb breadcrumbs
    comment comments commentlist consent cookie cookies disclaimer discussion disqus footer footnote
    gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices
    notification pagination pager popup promo promoted recommended related replies reply respond search
    share sharing sidebar sidebars signup social sponsor sponsored subscribe toolbar topbar widget widgets
    """.split())
# Words that leave the meaning of an unwanted one beside them in a name, and other unwanted names.
NEUTRAL_WORDS = frozenset("""
    area bar block bottom box button buttons container global group inner item items left link links list
    lower outer primary right secondary section site top upper wrap wrapper
    """.split())
UNWANTED_COMPOUNDS = frozenset("""
    article-comments entry-comments post-comments main-menu main-nav main-navigation page-footer
    related-articles related-posts related-stories
    """.split())
WANTED_NAMES = frozenset("article body content entry main page post story text".split())
ARTICLE_NAMES = WANTED_NAMES - {"body", "main", "page"}       # may not enclose the whole page
PLAIN_CONTAINERS = frozenset("center div td th".split())
# Share of a paragraph's points, in 180ths, for the nearest element and those further up.
LEVELS = (180, 90, 30, 20, 15, 12)
LEAST_SCORE, SIBLING_SHARE = 10, 0.2
TAG_POINTS = {"article": 30, "main": 25, "div": 5, "pre": 3, "td": 3, "blockquote": 3,
              "ol": -3, "ul": -3, "dl": -3, "li": -3, "h1": -5, "h2": -5, "h3": -5, "th": -5}

# One piece of markup: a comment, a declaration, an end tag or a start tag.
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*?)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HIDDEN_STYLE = re.compile(r"(?<![\w-])(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
_PART = re.compile(r"[a-z]+", re.I)
_DIGITS = re.compile(r"\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "children", "points", "length", "linked", "bonus", "first", "last", "own",
                 "inline", "unwanted", "hidden", "links", "names", "named", "block", "item", "cell")

    def __init__(self, tag: str, parent: Node | None, bonus: float = 0.0, inline: bool = False):
        self.tag, self.parent, self.bonus, self.inline = tag, parent, bonus, inline
        self.children: list[Node] = []
        self.own: list[int] = []          # paragraphs of no element below
        self.points = 0.0                 # from paragraphs below
        self.length = self.linked = 0     # code points of text, and in links
        self.first = self.last = 0        # range of paragraphs
        self.unwanted = self.hidden = self.named = False
        self.names: frozenset[str] = frozenset()
        self.links = 0                    # open <a> elements before an unwanted one
        # this element, or the nearest around it, that is no inline one; that
        # a list item and a table cell cannot end beyond
        self.block = parent.block if inline else self
        self.item = parent.item if inline or tag in IN_ITEMS and parent else self
        self.cell = self if tag in CELLS or tag in ROWS or tag == "table" or parent is None else parent.cell
        if parent is not None:
            parent.children.append(self)


def _unwanted_name(name: str, words: list[str], alone: bool) -> bool:
    """Whether a whole class or id name is an unwanted one; unless ``alone``,
    neutral words may stand beside it."""
    if name.lower() in UNWANTED_NAMES or name.lower() in UNWANTED_COMPOUNDS:
        return True
    return not alone and any(w in UNWANTED_NAMES for w in words) \
        and all(w in UNWANTED_NAMES or w in NEUTRAL_WORDS for w in words)


def _judge(tag: str, rest: str, code: bool) -> tuple[bool, bool, float, bool, frozenset[str]]:
    """(whether the element may hold main text, whether it is hidden, points of
    its names, whether they are an article's, the names without digits). Names
    of elements in ``code`` say nothing about the page."""
    wanted, hidden, bonus, article, names = tag not in UNWANTED_TAGS, False, 0.0, False, set()
    for m in _ATTRIBUTE.finditer(rest) if rest else ():
        attribute, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if attribute == "hidden":
            hidden |= value.strip().lower() != "false"
        elif attribute == "aria-hidden":
            hidden |= value.strip().lower() == "true"
        elif attribute == "style":
            hidden |= _HIDDEN_STYLE.search(value) is not None
        elif attribute == "role":
            role = value.strip().lower()
            wanted &= role not in UNWANTED_ROLES
            bonus += 25 if role in ("main", "article") else 0
            article |= role in ("main", "article")
        elif attribute in ("class", "id") and not code:
            named, unwanted = False, False
            for name in value.split():
                words = [w.lower() for w in _PART.findall(_CAMEL.sub(" ", name))]
                named = named or not WANTED_NAMES.isdisjoint(words)
                article = article or not ARTICLE_NAMES.isdisjoint(words)
                unwanted = unwanted or _unwanted_name(name, words, tag in ("article", "main"))
                names.add(_DIGITS.sub("", name.lower()))
            wanted &= not unwanted or named and tag in ("article", "main")
            bonus += 25 if named else 0
    return wanted and not hidden, hidden, bonus, article, frozenset(names)


class _Page:
    def __init__(self):
        self.root = self.at = Node("#root", None)
        self.open: dict[str, list[Node]] = {}        # open elements by tag, innermost last
        self.paragraphs: list[str] = []
        self.linked: list[int] = []       # code points in links, by paragraph
        self.run: list[str] = []
        self.links = 0                    # open <a> elements
        self.run_linked = 0
        self.inline = 0                   # open inline nodes: an unwanted one and those in it
        self.pres = self.codes = 0        # open <pre>, and <code> of this block

    def text(self, s: str) -> None:
        if s:
            self.run.append(s)
            if self.links:
                self.run_linked += len(s)

    def flush(self) -> None:
        """End the run of text: a paragraph of the element now open."""
        if not self.run:
            return
        raw = "".join(self.run)
        words = (unescape(raw) if "&" in raw else raw).split()
        linked, self.run, self.run_linked = self.run_linked, [], 0
        if not words:
            return
        s = " ".join(words)
        self.paragraphs.append(s)
        self.linked.append(min(linked, len(s)))
        self.at.own.append(len(self.paragraphs) - 1)

    def start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self.run.append(" ")
            return
        if tag == "a":
            self.links += 1
            return
        self.codes += tag == "code"
        block = tag in BLOCKS
        if not block and tag != "button" and tag != "head" and not rest and not self.inline:
            return
        wanted, hidden, bonus, named, names = _judge(tag, rest, not block and self.pres + self.codes > 0)
        wanted = wanted or tag in ("html", "body")
        if tag in VOID:
            if block or not wanted:
                self.flush()
            return
        if wanted and not block:
            if self.inline and not rest.endswith("/"):
                self._push(Node(tag, self.at, inline=True))
            return
        self.flush()
        if block:
            self._close_implied(tag)
        node = Node(tag, self.at, TAG_POINTS.get(tag, 0) + bonus, inline=not block)
        node.unwanted, node.hidden, node.links = not wanted, hidden, self.links
        node.named, node.names = named, names
        self._push(node)

    def _push(self, node: Node) -> None:
        node.first = len(self.paragraphs)
        self.open.setdefault(node.tag, []).append(node)
        self.inline += node.inline
        self.pres += node.tag == "pre"
        self.codes *= node.inline
        self.at = node

    def _close_implied(self, tag: str) -> None:
        """An open <p> or <head> ends at any block; list items, cells and rows
        end at the next, whatever inline elements are open in them."""
        head = self.open.get("head")
        if head and head[-1].block is self.at.block:
            self._pop_to(head[-1])
        elif self.at.block.tag == "p":
            self._pop_to(self.at.block)
        if tag in ("li", "dt", "dd"):
            if self.at.item.tag in (("li",) if tag == "li" else ("dt", "dd")):
                self._pop_to(self.at.item)
        elif tag in ROWS or tag in CELLS:
            same = CELLS if tag in CELLS else CELLS | {"tr"} if tag == "tr" else CELLS | ROWS
            while self.at.cell.tag in same:
                self._pop_to(self.at.cell)

    def _pop_to(self, node: Node) -> None:
        """End ``node`` and the elements open in it."""
        while self.at is not node:
            self._pop()
        self._pop()

    def _pop(self) -> None:
        node = self.at
        self.open[node.tag].pop()
        node.last = len(self.paragraphs)
        self.inline -= node.inline
        self.pres -= node.tag == "pre"
        self.codes *= node.inline
        if node.unwanted:
            self.links = node.links
        self.at = node.parent

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
            return
        if tag == "code":
            self.codes = max(0, self.codes - 1)
        if tag not in BLOCKS and not self.inline:
            return
        node = self.open[tag][-1] if self.open.get(tag) else None
        if tag not in BLOCKS and (node is None or node.block is not self.at.block):
            return                        # an inline element ends in the block it is in
        if tag in BLOCKS or node.unwanted:
            self.flush()
        if node is not None:
            self._pop_to(node)

    def done(self) -> None:
        self.flush()
        while self.at.parent is not None:
            self._pop()
        self.root.last = len(self.paragraphs)
        self._drop()
        self._score()

    def _drop(self) -> None:
        """Take the unwanted elements out of the tree, with their paragraphs.

        An unwanted element with most of the page's unlinked text may stay
        (``_is_the_text``). Such elements lie in each other, so what was looked
        through around the outer one (``seen``) is not looked through again.
        """
        gone, todo, seen = bytearray(len(self.paragraphs)), [self.root], self.root
        plain = [len(s) - linked for s, linked in zip(self.paragraphs, self.linked)]
        before = [0, *accumulate(plain)]
        some = [0, *accumulate(n > 0 for n in plain)]
        while todo:
            node = todo.pop()
            for child in node.children:
                if child.unwanted and 2 * (before[child.last] - before[child.first]) > before[-1]:
                    child.unwanted = not self._is_the_text(child, seen, plain, some)
                    seen = child
                if child.unwanted:
                    gone[child.first: child.last] = b"\1" * (child.last - child.first)
            node.children = [child for child in node.children if not child.unwanted]
            todo += node.children
        # the ranges that are left keep their ends: dropped paragraphs are empty
        for i, out in enumerate(gone):
            if out:
                self.paragraphs[i], self.linked[i] = "", 0

    def _is_the_text(self, node: Node, seen: Node, plain: list[int], some: list[int]) -> bool:
        """Whether an element with most of the page's unlinked text stays: no
        other article or main has any (those outside ``seen`` have none). A
        hidden one needs most paragraphs too."""
        if node.hidden and 2 * (some[node.last] - some[node.first]) <= some[-1]:
            return False
        inner = node
        while inner is not seen:
            todo = [(child, False) for child in inner.parent.children if child is not inner and not child.unwanted]
            while todo:
                at, inside = todo.pop()
                inside = inside or at.tag in ("article", "main")
                if inside and any(plain[i] > 0 for i in at.own):
                    return False
                todo += [(child, inside) for child in at.children if not child.unwanted]
            inner = inner.parent
        return True

    def _score(self) -> None:
        """Lengths and points of all elements, from the innermost up."""
        nodes = [self.root]
        for node in nodes:
            nodes += node.children
        sums: dict[Node, list[int]] = {}  # points by distance, times 100
        for node in reversed(nodes):
            here = sums.pop(node, None) or [0] * len(LEVELS)
            for i in node.own:
                s = self.paragraphs[i]
                if s:
                    here[0] += 100 + 100 * s.count(",") + min(len(s), 300)
                    node.length += len(s)
                    node.linked += self.linked[i]
            node.points = sum(map(mul, here, LEVELS)) / (100 * LEVELS[0])
            up = node.parent
            if up is not None:
                up.length += node.length
                up.linked += node.linked
                there = sums.get(up)
                if there is None:
                    sums[up] = [0, *here[:-2], here[-2] + here[-1]]
                else:
                    sums[up] = [there[0], *map(add, there[1:], here[:-1])]
                    sums[up][-1] += here[-1]


def parse(page: str) -> _Page:
    out, at, size = _Page(), 0, len(page)
    lower = None
    endless = set()                       # raw elements with no end tag ahead
    find = _MARKUP.search
    while True:
        m = find(page, at)
        if m is None:
            break
        if m.start() > at:
            out.text(page[at: m.start()])
        at = m.end()
        tag = m["start"]
        if tag:
            tag = tag.lower()
            if tag in RAW:
                if lower is None:
                    lower = page.lower() if len(page.lower()) == size else None
                where = -1 if tag in endless else (lower or page).find(f"</{tag}", at)
                if where < 0:
                    endless.add(tag)
                    # no end: a raw element runs to the end of the page
                    at = size if tag in ("script", "style", "textarea", "title") else at
                else:
                    close = page.find(">", where)
                    at = size if close < 0 else close + 1
                if tag not in ("script", "style", "title"):
                    out.text(" ")
            else:
                out.start(tag, m["rest"])
        elif m["end"]:
            out.end(m["end"].lower())
    if at < size:
        out.text(page[at:])
    out.done()
    return out


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _score(node: Node) -> float:
    return (node.points + node.bonus) * (1 - _density(node))


def _text_like(linked: int, length: int) -> bool:
    return 2 * linked < length


def _kept(tree: _Page, best: Node) -> list[int]:
    """Paragraphs of the best container's article or main, or of the best
    container and the siblings of the elements on the way up from it."""
    node, top, core = best, None, None
    while node is not None:
        if node.tag in ("article", "main"):
            core, top = node if core is None or node.tag == "article" else core, node
        node = node.parent
    kept = bytearray(len(tree.paragraphs))

    def keep(node: Node) -> None:
        kept[node.first: node.last] = b"\1" * (node.last - node.first)

    least = max(LEAST_SCORE, SIBLING_SHARE * _score(best))
    node = core or best
    named = core or best                  # the nearest element that is or is named an article
    while core is None and named is not None and (not named.named or named.tag in ("html", "body")):
        named = named.parent
    apart = named is None or named is node          # names tell siblings apart from here on
    keep(node)
    while node is not (top or tree.root):
        inner, node = node, node.parent
        for other in node.children:
            if other is not inner and _text_like(other.linked, other.length) and not (
                    apart and top is None and other.tag in PLAIN_CONTAINERS and other.names
                    and other.names != inner.names and not other.named and _score(other) < least):
                keep(other)
        for i in node.own:
            kept[i] |= _text_like(tree.linked[i], len(tree.paragraphs[i]))
        apart = apart or node is named
    if top is not None and top.parent is not None:   # what reads like text beside an article or main
        for other in top.parent.children:
            prose = other.tag in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", top.tag)
            if other is not top and _density(other) < 0.25 and (prose or _score(other) >= LEAST_SCORE):
                keep(other)
    return [i for i, kept_one in enumerate(kept) if kept_one]


def main_text(page: str) -> str:
    """The paragraphs around the best container."""
    tree = parse(page)
    best, todo = None, [tree.root]
    while todo:
        node = todo.pop()
        todo += reversed(node.children)
        if node.length and node.tag != "p" and (best is None or _score(node) > _score(best)):
            best = node
    if best is None:
        return ""
    return "\n".join(tree.paragraphs[i] for i in _kept(tree, best) if tree.paragraphs[i])


def _extract(batches: Iterator[pa.RecordBatch], html_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x) if x else "" for x in batch.column(html_at).to_pylist()]
        columns = [batch.column(i) for i in range(batch.num_columns) if i != html_at]
        names = [n for i, n in enumerate(batch.schema.names) if i != html_at]
        yield pa.record_batch([*columns, pa.array(texts, pa.string())], names=[*names, "text"])


def extract(pages: DataFrame) -> DataFrame:
    """Replace ``html`` by ``text``, the page's main text.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by a line feed in page order. Null or empty html,
    and pages without text, give an empty string. Markup that is not closed
    ends with its parent. Rows are independent (repeats give equal rows); a
    column ``text`` in ``pages`` is replaced; an empty table stays empty.
    """
    source = pages.select(*quoted(c for c in pages.columns if c != "text"))
    at = source.columns.index("html")
    schema = T.StructType([*(f for f in source.schema if f.name != "html"), T.StructField("text", T.StringType())])
    return mapped(source, lambda it: _extract(it, at), schema)
