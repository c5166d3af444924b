"""Main text of web pages by tag-path ratios.

A page is read once into text nodes, each under its root-to-leaf tag path (tags with their class and
id words; end tags that pages leave out are implied). Per path the text length, the punctuation and
the number of nodes are summed. A path's ratios, text per node and punctuation per node, are fused
into one weight with how much the node lengths vary and with what its words say (an article or main
element counts more, link text less, and what is named like a menu, a sidebar, an advert or comments hardly).
The weights are smoothed along the page, and nodes below a share of the mean
weight are cut. The smallest element that holds nearly all text left is the article.

Names only weigh: where next to no text is left beside the elements that their names speak against, the
page's text outvotes the name of the largest one, and its insides are judged without it. Only elements that are by their tag
or role no article (navigation, footer, aside, form, hidden or silent ones) are out from the start. Inside the article the ratios
of block paths decide once more: blocks of links go, and so do generic blocks whose path has little text per
block against the article's mean and no sentence in any.

Character references are decoded, white space in a block is one space, and blocks are joined in
page order by one space. Null or empty html, or a page without such text: the empty text. Broken and
cut-off html is read as far as it goes. Repeated rows: one result each. Empty table: empty result.
Whole pages are read, elements nested to any depth; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowwarden.llm.textblocks import blocks

SILENT = frozenset("script style noscript template head title iframe object svg math canvas audio video map select option datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
SCOPE = frozenset("html body article section div main aside nav header footer form table td th tr ul ol dl blockquote figure fieldset details dialog".split())
CLOSED_BY = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
NOTHING = frozenset("nav footer aside form button textarea dialog menu".split())  # tags whose text is never article
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOTHING_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_NOTHING_WORDS = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager topbar toolbar masthead "
    "footer colophon copyright sidebar aside widget widgets related recommended recommendations trending popular "
    "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup paywall "
    "comment comments commentlist reply replies respond discussion disqus share sharing social tags toc skip login search form"
)
NOTHING_WORDS = frozenset(_NOTHING_WORDS.split())
MAIN_WORDS = frozenset("article content post story entry main text body".split())
WORD = re.compile(r"[a-z]+")
SENTENCE = re.compile(r"[.,;!?…。，、！？；]")
GENERIC = frozenset("div section span p center font main article body html".split()) | {""}
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")

MAIN_WEIGHT = 2.0
LINK_WEIGHT = 0.1
KERNEL = (0.1, 0.2, 0.4, 0.2, 0.1)
CUT = 0.25  # of the text-weighted mean
HELD = 0.9  # share of the text left that the article's element holds
LINK_LIST = 0.6  # share of link text that makes a list, or a block path, one of links
DOUBT_WEIGHT = 0.1
OUTVOTED = 0.2  # text beside doubtful elements, as a share of the largest one's, below which its name is outvoted
CHAIN = 0.9  # share of an element's text that one inside holds, to be outvoted with it
INSIDE = 0.35  # of the article's mean, for generic blocks without a sentence


class Element:
    __slots__ = ("tag", "parent", "path", "nothing", "main", "link", "depth", "listed", "doubt", "holder")

    def __init__(self, tag: str, parent: Element | None, path: int, nothing: bool, main: bool, doubt: bool = False):
        self.tag, self.parent = tag, parent
        self.path = path  # the number of its tag path on the page
        self.nothing = nothing or bool(parent and parent.nothing)
        self.main = main or bool(parent and parent.main)
        self.link = tag == "a" or bool(parent and parent.link)
        self.depth = parent.depth + 1 if parent else 0
        self.doubt = self if doubt else parent.doubt if parent else None  # the innermost element named like none of an article
        self.holder = self if tag not in INLINE or not parent else parent.holder  # the block that the text stands in
        self.listed = self if tag in ("ul", "ol") else parent.listed if parent else None


class Reader(HTMLParser):
    """Text nodes of a page: (element, block number, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.paths: dict[tuple[int, str], int] = {}  # of a parent's path and a label
        self.open = [Element("", None, -1, False, False)]
        # places of open elements by tag, of those that aren't inline, and of those in SCOPE
        self.at: dict[str, list[int]] = {}
        self.blocks, self.scopes = [0], [0]
        self.nodes: list[tuple[Element, int, str]] = []
        self.block, self.silent = 0, 0

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.block += 1
            self._imply_ends(tag)
        if tag in VOID:
            return
        above = self.open[-1]
        # names say something only on containers; a body or html class names the whole page
        named = {} if tag in ("html", "body") else {k: v.lower() for k, v in attrs if v and k in ("class", "id", "role")}
        names = f"{named.get('class', '')} {named.get('id', '')}"
        words = set(WORD.findall(names)) | set(WORD.findall(re.sub("[-_]", "", names)))  # side-bar is a sidebar too
        nothing = tag in SILENT or tag in NOTHING or named.get("role") in NOTHING_ROLES or any(k == "hidden" for k, _ in attrs)
        doubt = bool(words & NOTHING_WORDS) and tag not in MAIN | HEADINGS | {"p"}
        if tag == "article" and words & {"comment", "reply"} or tag == "p" and words & {"ad", "ads", "advert", "advertisement", "notice", "comment", "copyright"}:
            doubt = True
        if tag == "header" or "header" in words and tag not in HEADINGS:
            doubt = doubt or not above.main  # an article's own header holds its headline
        main = tag in MAIN or named.get("role") in ("main", "article") or bool(words & MAIN_WORDS and not nothing and not doubt and tag not in INLINE)
        label = f"{tag}.{'.'.join(sorted(words))}" if words else tag
        place = len(self.open)
        self.open.append(Element(tag, above, self.paths.setdefault((above.path, label), len(self.paths)), nothing, main, doubt))
        self.at.setdefault(tag, []).append(place)
        if tag not in INLINE:
            self.blocks.append(place)
        if tag in SCOPE:
            self.scopes.append(place)
        if tag in SILENT:
            self.silent += 1

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag in INLINE:
            self.block += tag not in INLINE
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.block += 1
        place = self._last((tag,))
        bar = self.blocks[-1] if tag in INLINE else self.scopes[-1] if tag not in SCOPE else 0
        if place > bar:
            self._close(place)

    def handle_data(self, data):
        if not self.silent and data:
            self.nodes.append((self.open[-1], self.block, data))

    def _last(self, tags) -> int:
        """The place of the innermost open element with one of the tags (0: none)."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def _close(self, i: int):
        for e in self.open[i:]:
            self.silent -= e.tag in SILENT
            self.at[e.tag].pop()
        for places in (self.blocks, self.scopes):
            while places[-1] >= i:
                places.pop()
        del self.open[i:]

    def _imply_ends(self, tag: str):
        targets, stop = CLOSED_BY.get(tag, ("p", SCOPE | {"li", "dd"}))
        targets = targets.split()
        if tag == "body" and self.silent:  # a head left open
            targets, stop = ["head"], frozenset()
        place = self._last(targets)
        if place and place >= self._last(stop):
            self._close(place)


def read(html: str) -> list[tuple[Element, int, str]]:
    reader = Reader()
    reader.feed(html)
    reader.close()
    return reader.nodes


def path_weights(nodes: list[tuple[Element, str]]) -> dict[int, float]:
    """Fused ratio of every path among the given (element, text) nodes."""
    sums: dict[int, list] = {}
    for element, text in nodes:
        own = sums.setdefault(element.path, [element, 0, 0, 0, 0])
        n = len(text)
        own[1] += 1
        own[2] += n
        own[3] += n * n
        own[4] += len(PUNCTUATION.findall(text))
    out = {}
    for path, (element, count, length, squares, marks) in sums.items():
        mean = length / count
        spread = math.sqrt(max(squares / count - mean * mean, 0))
        weight = math.sqrt(mean * (1 + marks / count)) * math.log(math.e + spread)
        out[path] = weight * (MAIN_WEIGHT if element.main else 1) * (LINK_WEIGHT if element.link else 1)
    return out


def outvoted(nodes: list[tuple[Element, str]]) -> set[int]:
    """Doubtful elements (by id) whose names the text outvotes."""
    mass: dict[int, int] = {}  # text of each doubtful element, what lies in doubtful ones inside it included
    inner: dict[int, Element] = {}
    clear = 0
    for e, text in nodes:
        if e.doubt is None:
            clear += len(text)
        else:
            mass[id(e.doubt)] = mass.get(id(e.doubt), 0) + len(text)
            inner[id(e.doubt)] = e.doubt
    own = dict(mass)
    above: dict[int, Element | None] = {}
    todo = list(inner.values())
    while todo:  # doubtful elements around the ones with text of their own
        e = todo.pop()
        if id(e) not in above:
            up = above[id(e)] = e.parent.doubt if e.parent else None
            if up is not None and id(up) not in inner:
                inner[id(up)], own[id(up)], mass[id(up)] = up, 0, 0
                todo.append(up)
    inside: dict[int, list[Element]] = {}
    for e in sorted(inner.values(), key=lambda e: -e.depth):
        if above[id(e)] is not None:
            mass[id(above[id(e)])] += mass[id(e)]
            inside.setdefault(id(above[id(e)]), []).append(e)
    out: set[int] = set()
    tops = [e for e in inner.values() if above[id(e)] is None]
    while tops:
        e = max(tops, key=lambda e: mass[id(e)])
        if clear >= OUTVOTED * mass[id(e)]:
            break
        tops.remove(e)
        while True:
            out.add(id(e))
            clear += own[id(e)]
            within = inside.get(id(e), [])
            main = max(within, key=lambda x: mass[id(x)], default=None)
            tops += [x for x in within if x is not main]
            if main is None:
                break
            if mass[id(main)] < CHAIN * mass[id(e)]:
                tops.append(main)
                break
            e = main
    return out


def block_paths(nodes: list[tuple[Element, int, str]]) -> dict[int, bool]:
    """Whether each path of blocks among the given (element, block number, text) nodes of an article is part of it.

    Ratios are per block: its text, its share of link text and its sentence marks, summed over the path.
    """
    sums: dict[int, list] = {}
    for e, number, text in nodes:
        own = sums.setdefault(e.holder.path, [e.holder, set(), 0, 0, 0])
        own[1].add(number)
        own[2] += len(text)
        own[3] += len(text) * e.link
        own[4] += len(SENTENCE.findall(text))
    weight = {p: math.sqrt(size / len(parts) * (1 + marks / len(parts))) for p, (_, parts, size, _, marks) in sums.items()}
    total = sum(own[2] for own in sums.values())
    mean = sum(weight[p] * own[2] for p, own in sums.items()) / total if total else 0.0
    out = {}
    for p, (e, _, size, linked, marks) in sums.items():
        links = linked >= LINK_LIST * size and e.tag not in HEADINGS
        out[p] = not links and not (e.tag in GENERIC and not marks and weight[p] < INSIDE * mean)
    return out


def _article(nodes: list[tuple[Element, str]], kept: list[bool]) -> Element | None:
    """The deepest element that holds HELD of the kept text."""
    held: dict[int, list] = {}
    total = 0
    for (element, text), keep in zip(nodes, kept):
        if keep:
            total += len(text)
            e = element
            while e is not None and id(e) not in held:
                held[id(e)] = [e, 0]
                e = e.parent
            held[id(element)][1] += len(text)
    for e, _ in sorted(held.values(), key=lambda h: -h[0].depth):  # children before their parents
        if e.parent is not None:
            held[id(e.parent)][1] += held[id(e)][1]
    fit = [e for e, n in held.values() if n >= HELD * total]
    return _container(max(fit, key=lambda e: e.depth, default=None))


def _container(element: Element | None) -> Element | None:
    """The article, main or named element around the given one, or else the block that holds it."""
    if element is None:
        return None
    up = []
    e = element
    while e is not None:
        up.append(e)
        e = e.parent
    for e in up:
        if e.tag == "article":
            return e
    named = [e for e in up if e.main]
    if named:
        return next((e for e in named if e.tag == "main"), named[-1] if named[0].tag not in SCOPE else named[0])
    return next((e for e in up if e.tag in SCOPE or not e.tag), element)


def main_text(html: str) -> str:
    """The article's text of one page."""
    raw = read(html)
    nodes, numbers = [], []
    for element, block, text in raw:
        if text.strip() and not element.nothing:
            nodes.append((element, " ".join(text.split())))
            numbers.append(block)
    if not nodes:
        return ""
    free = outvoted(nodes)
    doubted: dict[int, bool] = {}

    def doubtful(e: Element) -> bool:
        """Whether a name speaks against the text, and is not outvoted."""
        up = []
        d = e.doubt
        while d is not None and id(d) not in doubted and id(d) in free:
            up.append(id(d))
            d = d.parent.doubt if d.parent else None
        found = d is not None and doubted.get(id(d), True)
        doubted.update(dict.fromkeys([*up, id(d)] if d is not None else up, found))
        return found

    weights = path_weights(nodes)
    against = [doubtful(e) for e, _ in nodes]
    line = np.array([weights[e.path] * (DOUBT_WEIGHT if a else 1) for (e, _), a in zip(nodes, against)])
    size = np.array([len(t) for _, t in nodes])
    half = len(KERNEL) // 2
    smooth = np.convolve(np.pad(line, half, "edge"), KERNEL, "valid")
    bar = CUT * float((smooth * size).sum() / size.sum())
    kept = [s >= bar and w > 0 and not a for s, w, a in zip(smooth, line, against)]
    article = _article(nodes, kept)
    if article is None:
        return ""
    inside: dict[int, bool] = {}

    def within(e: Element | None) -> bool:
        up = []
        while e is not None and e is not article and id(e) not in inside:
            up.append(id(e))
            e = e.parent
        found = e is not None and (e is article or inside[id(e)])
        inside.update(dict.fromkeys(up, found))
        return found

    links: dict[int, list[int]] = {}
    for element, text in nodes:
        if element.listed is not None:
            own = links.setdefault(id(element.listed), [0, 0])
            own[element.link] += len(text)
    whole = article.main or article.tag not in ("", "html", "body")
    of_article = [k for k, (element, _) in enumerate(nodes) if not against[k] and (whole or kept[k]) and within(element)]
    part = block_paths([(nodes[k][0], numbers[k], nodes[k][1]) for k in of_article])
    good = set()
    for k in of_article:
        element = nodes[k][0]
        if not part[element.holder.path]:
            continue
        if element.listed is not None and within(element.listed):
            plain, linked = links[id(element.listed)]
            if linked >= LINK_LIST * (plain + linked):
                continue
        good.add((id(element), numbers[k]))
    parts: list[str] = []
    last = None
    for element, block, text in raw:
        if (id(element), block) in good or not text.strip() and not element.nothing and within(element):
            if block != last:
                parts.append(" ")
            parts.append(text)
            last = block
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, main text and its code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, html):
            texts = [main_text(block.text(i)) for i in range(len(block))]
            yield pa.RecordBatch.from_arrays(
                [block.column(key), block.column(url), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    picked = pages.select(pages[key].cast("long").alias(key), pages[url].cast("string").alias(url), pages[html])
    return picked.mapInArrow(run, "page_id long, url string, text string, n_chars long")
