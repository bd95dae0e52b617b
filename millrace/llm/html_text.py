"""Main text of web pages: flat text blocks, told apart by a decision tree.

A page is cut at block elements. Each block has its words, the share of them in links, the same of its neighbours, and whether
the elements around it speak for the article or for what surrounds one. A decision tree trained on the small labelled table
below says which blocks are the article's.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import named

# Fixed values of HTML: elements without an end tag, without running text, and those inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head title template noscript textarea select option button svg math iframe object canvas audio video datalist".split())
RAW = frozenset("script style title textarea noscript iframe template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold the running text of what they stand in.
RUNNING = frozenset("p li ul ol dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr td th caption hgroup".split()) | HEADING
#: What does not end a head that is left open.
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template noframes html".split())
#: Elements, and the words of their class, id or role, that surround an article, and those that hold one.
AROUND = frozenset("nav footer aside dialog menu header address".split())
AROUND_NAMES = frozenset(
    "ad ads adv advert advertisement banner breadcrumb comment commentform commentlist consent contact cookie copyright disclaimer disqus foot footer gdpr "
    "header hidden legal login masthead menu modal nav navbar navigation newsletter notice pager pagination popup privacy promo related reply respond search "
    "searchbox searchform share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar alert bottom complementary contentinfo".split()
)
#: Of these, those that also say what an article is about: they count alone, as the last word of a class, or before a word for a box.
WEAK_NAMES = frozenset("alert bottom consent contact copyright legal login notice privacy promo related search share social tags".split())
BOXES = frozenset(
    "area articles bar block box button buttons card container footer form header icons info inner line links list message notice panel policy popup posts "
    "section text widget wrap wrapper".split()
)
#: Last words of a class that speaks of a kind or a state of the page.
STATES = frozenset("active closed collapsed disabled enabled expanded layout open opened page pages shown template view visible".split())
#: Those that a content name on the same element, or an article element, does not outweigh; and beginnings of class names that
#: speak of the layout, not of what the element is.
OTHERS_WORDS = frozenset("comment disqus reply respond".split())
#: Whole classes or ids of reader comments.
OTHERS = re.compile(r"(?:user|reader|visitor|guest|member)s?[-_]?(?:post|comment|response|opinion)s?|(?:discussion|response|replies|talkback)s?(?:[-_]?(?:list|area|section|thread|container|wrapper))?")
LAYOUT = frozenset("has with without no overflow margin padding border align".split())
WITHIN = frozenset("article main".split())
WITHIN_NAMES = frozenset("article content entry main post story".split())

# The labelled table: pages as lists of blocks (where it stands, words, words in links, 1 for the article's).
# "+" is an element that holds an article, "-" one that surrounds it, "." neither, "h" a heading besides.
PAGES: list[list[tuple[str, int, int, int]]] = [
    [("-", 6, 6, 0), ("-", 7, 0, 0), ("+h", 9, 0, 1), ("+", 60, 2, 1), ("+", 8, 0, 1), ("-", 12, 1, 0)],
    [("-", 3, 3, 0), ("-", 40, 0, 0), ("+h", 3, 0, 1), ("+", 1, 0, 1), ("+", 120, 0, 1), ("-", 60, 0, 0), ("-", 25, 20, 0)],
    [("-", 2, 2, 0), ("+h", 6, 0, 1), ("+", 45, 40, 1), ("+", 5, 0, 1), ("-", 90, 0, 0), ("-", 5, 0, 0)],
    [(".", 1, 1, 0), (".", 2, 2, 0), (".", 1, 1, 0), (".h", 8, 0, 1), (".", 75, 3, 1), (".", 50, 0, 1), (".", 33, 1, 1), (".", 4, 3, 0), (".", 3, 3, 0)],
    [(".", 5, 5, 0), (".", 4, 4, 0), (".h", 5, 0, 1), (".", 30, 2, 1), (".", 12, 0, 1), (".", 64, 0, 1), (".", 9, 2, 0), (".", 2, 2, 0), (".", 6, 0, 0)],
    [("-", 12, 0, 0), (".", 3, 3, 0), (".h", 7, 0, 1), (".", 41, 0, 1), (".", 19, 1, 1), (".", 88, 6, 1), ("-", 30, 0, 0), ("-", 55, 1, 0), (".", 7, 1, 0)],
    [(".", 6, 6, 0), (".", 22, 20, 0), (".", 90, 1, 1), (".", 15, 0, 1), (".", 70, 0, 1), (".", 3, 0, 0), (".", 18, 15, 0), (".", 2, 2, 0)],
    [("-", 1, 0, 0), ("-", 200, 0, 0), ("+", 300, 5, 1), ("+", 2, 0, 1), ("+h", 4, 0, 1), ("+", 15, 15, 1), ("-", 2, 2, 0), ("-", 1, 1, 0)],
    [(".h", 4, 4, 0), (".", 3, 3, 0), (".", 2, 1, 0), (".", 4, 4, 0), (".h", 3, 3, 0), (".", 5, 5, 0), (".", 10, 9, 0)],
    [(".", 4, 4, 0), (".h", 6, 0, 1), (".", 55, 1, 1), (".", 5, 0, 1), (".", 62, 0, 1), (".", 4, 0, 1), (".", 47, 2, 1), (".", 3, 3, 0), (".", 5, 0, 0)],
    [(".", 3, 0, 0), (".", 5, 0, 0), (".", 2, 0, 0), (".", 4, 2, 0), (".", 6, 0, 0), (".", 3, 1, 0)],
    [("-", 9, 9, 0), ("-", 1, 0, 0), ("-h", 3, 0, 0), ("-", 35, 2, 0), ("-", 4, 0, 0)],
]

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?][^>]*+(?:>|\Z)|<[A-Za-z][^>]*+(?:>|\Z)""",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


class Block:
    """Text of a block, its words and how many are in links, what stands around it, and the numbers of its form and container."""

    __slots__ = ("text", "words", "linked", "side", "heading", "form", "container")

    def __init__(self, text: str, words: int, linked: int, side: int, heading: bool, form: int = 0, container: int = 0):
        self.text, self.words, self.linked, self.side, self.heading, self.form, self.container = text, words, linked, side, heading, form, container


def _names(word: str) -> str:
    """The entry of AROUND_NAMES that a whole word is, or its plural or numbered form; else empty."""
    word = word.rstrip("0123456789")
    return next((w for w in (word, word.removesuffix("s")) if w in AROUND_NAMES), "")


def _around(words: Sequence[str], within: bool) -> set[str]:
    """The entries of AROUND_NAMES that a class of these words names. A header inside an article is the article's."""
    found = set()
    for word, after in zip(words, [*words[1:], ""]):
        n = _names(word)
        if n and not (within and n == "header") and (n not in WEAK_NAMES or not after or after in BOXES or after.isdigit()):
            found.add(n)
    return found


def _side(tag: str, attributes: str, within: bool) -> int:
    """1: the element holds an article, -1: it surrounds one, 0: neither. A header inside an article is the article's.

    A class or id that is a content name and has no word of AROUND_NAMES outweighs other classes, but not the element's own
    kind or role, nor that it is a comment.
    """
    around, holds, content, others = tag in AROUND and not (within and tag == "header"), tag in WITHIN, False, False
    kind = around
    for name, *values in _NAMED.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return -1
        if name not in ("class", "id", "role"):
            continue
        for part in value.split():
            words = re.split(r"[^a-z0-9]+", part)
            if words[0] in LAYOUT or ":" in part:  # as in has-sidebar, overflow-hidden, md:hidden
                continue
            found = set() if words[-1] in STATES else _around(words, within)
            around |= bool(found)
            kind |= bool(found) and name == "role"
            others |= words[0].removesuffix("s") in OTHERS_WORDS or OTHERS.fullmatch(part) is not None
            named = not WITHIN_NAMES.isdisjoint(words)
            holds |= named
            content |= named and not found
    if tag in ("body", "html"):
        return 1 if holds else 0
    if others and not (tag in WITHIN and content):
        return -1
    if around and tag not in WITHIN and (kind or not content):
        return -1
    return 1 if holds else 0


#: An open element of these ends where another of the same kind, or for "p" any block, begins.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}

#: Parts of a form that are left open end where one of these begins.
_IN_FORM = ("button", "select", "option", "datalist")
_PARTS = frozenset("article main section nav header footer aside form p table ul ol button select".split()) | HEADING


class _Open:
    """The open elements, each with the side of all that stands in it."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.pushed, self.containers = 0, [0]  # numbers of the open elements that texts share, the page itself first
        self.count: Counter[str] = Counter()  # of each kind, so that a stray end tag looks at no element
        self.blocks: list[int] = []  # places of the elements that are not inside a line
        self.silent = 0

    def push(self, tag: str, side: int) -> None:
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
            if tag not in RUNNING:
                self.pushed += 1
                self.containers.append(0 if tag in ("html", "body") else self.pushed)
        self.stack.append((tag, side))
        self.count[tag] += 1
        self.silent += tag in SILENT

    def pop_to(self, i: int) -> None:
        while len(self.stack) > i:
            tag, _ = self.stack.pop()
            self.count[tag] -= 1
            self.silent -= tag in SILENT
            if tag not in INLINE and tag not in RUNNING:
                self.containers.pop()
        while self.blocks and self.blocks[-1] >= i:
            self.blocks.pop()

    def end(self, tag: str) -> None:
        """Close the innermost element of a kind and all in it; one inside a line closes no block."""
        if not self.count[tag]:
            return
        least = self.blocks[-1] + 1 if tag in INLINE and self.blocks else 0
        i = len(self.stack) - 1
        while i >= least and self.stack[i][0] != tag:
            i -= 1
        if i >= least:
            self.pop_to(i)

    def end_head(self) -> None:
        """HTML lets the end tag of a head be left out: what cannot stand in a head begins the body."""
        if self.count["head"]:
            self.end("head")

    def make_room(self, tag: str) -> None:
        """End what cannot hold an element of this kind."""
        if self.silent and tag in _PARTS:
            for part in _IN_FORM:
                self.end(part)
        if tag not in INLINE and self.blocks:
            i = self.blocks[-1]
            if self.stack[i][0] == "p" or self.stack[i][0] in _ENDS.get(tag, ()):
                self.pop_to(i)

    @property
    def side(self) -> int:
        return self.stack[-1][1] if self.stack else 0


def _settle_forms(found: list[Block], whole: set[int]) -> None:
    """What is in a form surrounds the article, unless the form holds the article: it has an element or a heading of the first
    order that says so (``whole``), or over half of the page's words."""
    words: Counter[int] = Counter()
    for b in found:
        words[b.form] += b.words
    total = words.total()
    for b in found:
        if b.form and b.form not in whole and 2 * words[b.form] <= total:
            b.side = -1


def blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked, in_link, heading, forms, form = 0, False, False, 0, 0
    whole: set[int] = set()

    def close() -> None:
        nonlocal linked, in_link
        words = html.unescape("".join(parts)).split() if parts else []
        if words:
            out.append(Block(" ".join(words), len(words), min(linked, len(words)), open_.side, heading, form, open_.containers[-1]))
        parts.clear()
        linked, in_link = 0, False

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        piece = page[at : m.start() if m else size]
        if open_.silent and open_.stack[-1][0] == "head" and piece.strip():
            open_.end_head()
        if piece and not open_.silent:
            parts.append(piece)
            if in_link:
                linked += len(html.unescape(piece).split())
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, ends = m[2].lower(), bool(m[1])
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not ends
        if tag not in INLINE:
            close()
            heading = tag in HEADING and not ends
        if ends:
            open_.end(tag)
        else:
            if tag not in IN_HEAD:
                open_.end_head()
            if tag in VOID or (m[3].endswith("/") and tag not in RAW and tag not in INLINE and tag in ("svg", "path")):
                continue
            open_.make_room(tag)
            if tag in INLINE and not m[3]:
                continue  # says nothing about what is in it
            over = open_.side
            side = _side(tag, m[3], over > 0)
            if tag in RAW:  # text up to the end tag, whatever it looks like
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
                continue
            if tag == "form":
                forms += 1
                form = forms
            elif form and (tag in ("article", "main", "h1") or side > 0) and side >= 0:
                whole.add(form)
            open_.push(tag, side or over)
        if form and not open_.count["form"]:
            form = 0
    close()
    _settle_forms(out, whole)
    return out


def features(found: Sequence[Block]) -> np.ndarray:
    """Per block: words, share in links, both of the one before and the one after, around, within, heading."""
    words = np.array([0, *(b.words for b in found), 0], np.float64)
    linked = np.array([0, *(b.linked for b in found), 0], np.float64)
    density = linked / np.maximum(words, 1)
    side = np.array([b.side for b in found])
    heading = np.array([b.heading for b in found])
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], side < 0, side > 0, heading]).astype(np.float64)


def grow_tree(x: np.ndarray, y: np.ndarray, least: int = 2, depth: int = 6) -> object:
    """A decision tree by Gini impurity: a share of ones, or (feature, threshold, at most, above)."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return share
    best, least_cost = None, share * (1 - share) * len(y) - 1e-9
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            if least <= low.sum() <= len(y) - least:
                a, b = y[low], y[~low]
                cost = a.mean() * (1 - a.mean()) * len(a) + b.mean() * (1 - b.mean()) * len(b)
                if cost < least_cost:
                    best, least_cost = (f, float(cut), low), cost
    if best is None:
        return share
    f, cut, low = best
    return f, cut, grow_tree(x[low], y[low], least, depth - 1), grow_tree(x[~low], y[~low], least, depth - 1)


def decide(tree: object, row: Sequence[float]) -> float:
    while not isinstance(tree, float):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def train(pages: Sequence[Sequence[tuple[str, int, int, int]]] = PAGES) -> object:
    """The tree for a labelled table of pages."""
    x, y = [], []
    for page in pages:
        found = [Block("", words, linked, {"+": 1, "-": -1, ".": 0}[where[0]], "h" in where) for where, words, linked, _ in page]
        x.append(features(found))
        y += [label for *_, label in page]
    return grow_tree(np.concatenate(x), np.array(y))


def _complete(found: Sequence[Block], kept: list[bool]) -> list[bool]:
    """Short paragraphs, captions and list items of an article go with it: where the blocks taken from a container hold most of
    its words, so do the others in it that are not mostly links. Of the page itself only those between two taken."""
    words, taken, first, last = Counter(), Counter(), {}, {}
    for i, (b, k) in enumerate(zip(found, kept)):
        words[b.container] += b.words
        if k:
            taken[b.container] += b.words
            last[b.container] = i
            first.setdefault(b.container, i)

    def joins(i: int, b: Block) -> bool:
        most = 2 * taken[b.container] > words[b.container] and b.side >= 0 and 2 * b.linked < b.words
        return most and (b.container > 0 or first[0] < i < last[0])

    return [k or joins(i, b) for i, (b, k) in enumerate(zip(found, kept))]


def main_text(page: str, tree: object) -> str:
    found = blocks(page)
    rows = features(found).tolist() if found else []
    kept = _complete(found, [decide(tree, row) >= 0.5 for row in rows])
    return " ".join(b.text for b, k in zip(found, kept) if k)


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    ``text`` is the article of the page: blocks in page order, joined by a space, character references decoded, white space
    within a block one space. It is empty for a null or empty page and for one without an article; ``n_chars`` counts code
    points. Broken markup never fails: an element left open ends with the one around it, a tag or comment left open with the
    page. Repeated rows come back as often as they were given. No rows: no rows.
    """
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [main_text(p, tree) for p in b.column(2).to_pylist()]
            n = pa.array([len(t) for t in found], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string()), n], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(named(page_id).cast("long"), named(url).cast("string"), F.coalesce(named(page).cast("string"), F.lit("")))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
