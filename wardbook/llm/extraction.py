"""Main text of web pages, by minimum cut.

A page is cut into blocks of text. A classifier gives each block a cost for either label,
content or boilerplate; these are the capacities to the two terminals. Blocks that follow
each other, and blocks of one parent element, are tied by edges that are dearer the
nearer they are in the document tree. The minimum cut, found by maximum flow, is the
labelling of lowest total cost, so a short line in an article follows its neighbours.

Pages are independent: each Spark task reads its own, and nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.tables import bound_batches
from wardbook.llm.words import pieces

# Elements that begin and end a block of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
# Elements without end tag, elements whose content is no text of the page, those of
# them that hide nothing if they never end, and elements that are no part of an article.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style svg template textarea iframe select datalist".split())
ENDED_TAGS = frozenset("svg iframe select datalist".split())
ASIDE_TAGS = frozenset("nav footer aside form head title menu dialog fieldset search".split())
# An element that one of these begins closes an open paragraph or list item.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "body": ("head",)}
# Words in class, id and role that name boilerplate, and that name content.
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "social share sharing related recommended recommendations sidebar side widget widgets menu nav navigation navbar "
    "breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar comment comments reply replies "
    "disqus respond copyright legal contentinfo complementary search hidden".split()
)
CONTENT_NAMES = frozenset("article content main post entry story text body prose".split())
# Words that say of a part where or in which form it is, and words that say of
# something else that it has such a part.
PLACE_NAMES = frozenset(
    "article area bar bottom box block button buttons card column container content desktop form global group icon "
    "icons inner item items js left link links list main mobile outer page panel post posts primary right row "
    "secondary section site slot top unit wrap wrapper".split()
)
HAVING_NAMES = frozenset("has have with without no not non".split())

# A quote begins a value after = only, and the value, however long, ends at the next such quote
# that another attribute or the tag's end follows. Other quotes are characters like any other.
_VALUE_OVER = r"""(?=[\s/>]|[^\s"'<>/=]++=)"""
_ATTRIBUTES = (
    r"(?:[^<>=/]++|/(?!>)|=\s*+(?:"
    r'"[^"]*+"' + _VALUE_OVER + r"|'[^']*+'" + _VALUE_OVER + r"""|[^\s<>"'][^\s<>]*+)?)*+"""
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*>"
    r"|</?[a-zA-Z][^<>]*\Z"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>" + _ATTRIBUTES + r")(?:(?P<empty>/?)>|(?P<open>))",
    re.DOTALL | re.IGNORECASE,
)
_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in (*RAW_TAGS, "button")}
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class CutRules:
    """Weights of the classifier, whose sum is the log odds of content, and of the edges."""

    start: float = -1.0
    boilerplate: float = -9.0  # inside an element that is no part of an article
    hinted: float = -3.0  # inside one of a name that has a boilerplate name in it
    buttons: float = -9.0  # times the square of the share of characters in buttons
    named_content: float = 1.5  # inside an element with a content name
    article: float = 4.0  # inside article or main
    page_header: float = -5.0  # inside a header outside of an article
    paragraph: float = 1.0
    length: float = 0.6  # times the logarithm of the words
    sentence: float = 0.5  # ends as a sentence does
    links: float = -4.0  # times the share of linked characters
    adjacent: float = 0.8  # tie of blocks that follow each other
    sibling: float = 0.6  # tie of blocks of one parent
    fade: float = 0.5  # a tie halves or so with each step in the tree


def named_boilerplate(name: str) -> float:
    """How far a class, id or role says that its element is boilerplate: 0, 0.5 or 1.

    1 if all words of the name are boilerplate names or places, as in site-footer, and 0.5
    if some are, as in share-price. has-sidebar tells of the rest of the page, and
    article-header has an article's title.
    """
    words = [w.lower() for w in _WORD.findall(name)]
    found = BOILERPLATE_NAMES.intersection(words)
    if not found or words[0] in HAVING_NAMES:
        return 0.0
    if found == {"header"} and not {"article", "content", "post", "entry", "story"}.isdisjoint(words):
        return 0.0
    return 1.0 if all(w in found or w in PLACE_NAMES for w in words) else 0.5


class _Element:
    __slots__ = ("article", "boilerplate", "depth", "header", "hinted", "named", "parent", "tag")

    def __init__(self, tag: str, attributes: str, parent: _Element | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.article = tag in ("article", "main") or bool(parent and parent.article)
        self.header = tag == "header" or bool(parent and parent.header)
        self.boilerplate = tag in ASIDE_TAGS or bool(parent and parent.boilerplate)
        self.hinted = bool(parent and parent.hinted)
        self.named = bool(parent and parent.named)
        if attributes and "=" in attributes:
            names = [name for _, *values in _NAMES.findall(attributes) for name in "".join(values).split()]
            words = {w.lower() for name in names for w in _WORD.findall(name)}
            # The names of the whole page tell what it has, not what it is.
            whole = tag in ("html", "body", "main")
            if tag == "article":
                whole = words.isdisjoint(("comment", "comments", "reply", "ad", "related", "sponsored"))
            if not whole and not self.boilerplate:
                told = max(map(named_boilerplate, names), default=0.0)
                self.boilerplate, self.hinted = told == 1.0, self.hinted or told == 0.5
            self.named = self.named or (tag not in ("html", "body") and not words.isdisjoint(CONTENT_NAMES))
        if attributes and _HIDDEN.search(attributes):
            self.boilerplate = True


@dataclass
class Block:
    """A block's text, white space already single, its element, and its characters in links and buttons."""

    text: str
    element: _Element
    linked: int
    pressed: int = 0


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page, in order: runs of text between block elements."""
    root = _Element("#page", "", None)
    top, found = root, []
    parts: list[str] = []
    linked, pressed, in_link, at = 0, 0, False, 0
    buttons_to = 0
    opened: Counter[str] = Counter()
    never_end: set[str] = set()

    def close() -> None:
        nonlocal linked, pressed
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(text, top, linked, pressed))
            parts.clear()
        linked = pressed = 0

    def up() -> None:
        nonlocal top
        opened[top.tag] -= 1
        top = top.parent

    def add(raw: str) -> None:
        nonlocal linked, pressed
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if in_link:
            linked += len(text.strip())
        if at < buttons_to:
            pressed += len(text.strip())

    while m := _TAG.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        if m["open"] is not None:
            add(m[0])
            continue
        tag = tag.lower()
        if tag in RAW_TAGS:
            # <svg/> is empty, and the rest of the page is no part of an unclosed svg.
            if not m["end"] and not (tag in ENDED_TAGS and m["empty"] or tag in never_end):
                stop = _END[tag].search(page, at)
                if stop:
                    at = stop.end()
                elif tag in ENDED_TAGS:
                    never_end.add(tag)
                else:
                    at = len(page)
        elif tag == "button":
            if at > buttons_to and not m["end"] and tag not in never_end:
                stop = _END[tag].search(page, at)
                if stop:
                    buttons_to = stop.start()
                else:
                    never_end.add(tag)
        elif tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not m["end"]
        elif tag in BLOCK_TAGS:
            close()
            in_link = False
            if m["end"]:
                if opened[tag]:
                    while top.tag != tag:
                        up()
                    up()
                continue
            if top.tag == "p":
                up()
            closes = CLOSES.get(tag)
            if closes and top.tag in closes:
                up()
                if tag == "tr" and top.tag == "tr":
                    up()
            if tag not in VOID_TAGS:
                top = _Element(tag, m["attributes"], top)
                opened[tag] += 1
    if at < len(page):
        add(page[at:])
    close()
    return found


def log_odds(block: Block, rules: CutRules) -> float:
    """The classifier: how much likelier content is than boilerplate."""
    e, words = block.element, block.text.count(" ") + 1
    total = rules.start + rules.length * log1p(words)
    if e.boilerplate:
        total += rules.boilerplate
    elif e.hinted:
        total += rules.hinted
    if e.article:
        total += rules.article
    elif e.header:
        total += rules.page_header
    if e.named:
        total += rules.named_content
    if e.tag in ("p", "blockquote", "pre"):
        total += rules.paragraph
    if block.text[-1] in ".!?…。！？:\"'”’»)":
        total += rules.sentence
    total += rules.buttons * min(1.0, block.pressed / len(block.text)) ** 2
    return total + rules.links * min(1.0, block.linked / len(block.text))


def _steps(a: _Element, b: _Element) -> int:
    """Steps in the tree between two elements."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def ties(blocks: list[Block], rules: CutRules) -> list[tuple[int, int, float]]:
    """Edges between blocks: to the next one, and to the next one of the same parent."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            near = exp(-rules.fade * _steps(blocks[i - 1].element, block.element))
            edges.append((i - 1, i, rules.adjacent * near))
        parent = id(block.element.parent)
        if parent in last:
            edges.append((last[parent], i, rules.sibling))
        last[parent] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node, whether it is on the source's side of the minimum cut.

    A node's capacity from the source is its log odds if positive, to the sink if
    negative: a common part of both cannot change the cut. Flow is sent along shortest
    paths, level by level, until no path is left.
    """
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    of: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        of[a].append(len(to))
        to.append(b)
        room.append(there)
        of[b].append(len(to))
        to.append(a)
        room.append(back)

    for a, b, weight in edges:
        edge(a, b, weight, weight)
    for i, odd in enumerate(odds):
        if odd > 0:
            edge(source, i, odd, 0.0)
        elif odd < 0:
            edge(i, sink, -odd, 0.0)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = [source]
        for a in queue:
            for e in of[a]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                back = 0
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if room[e] <= least and not back:
                        back = k + 1
                del path[back - 1 :]
                a = to[path[-1]] if path else source
                continue
            while turn[a] < len(of[a]):
                e = of[a][turn[a]]
                if room[e] > least and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(of[a]):
                path.append(of[a][turn[a]])
                a = to[path[-1]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
            else:
                break


def main_text(page: str | None, rules: CutRules = CutRules()) -> str:
    """The page's content blocks, joined by \\n."""
    blocks = blocks_of(page or "")
    odds = [log_odds(b, rules) for b in blocks]
    if not any(x > 0 for x in odds):
        return ""
    content = minimum_cut(odds, ties(blocks, rules))
    return "\n".join(b.text for b, keep in zip(blocks, content, strict=True) if keep)


def extracted(pages: DataFrame, rules: CutRules = CutRules()) -> DataFrame:
    """pages' columns but html, with text and n_chars, its number of code points.

    The whole html is read; null counts as empty, and a page without content has text ''.
    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined by \\n in page order. Comments and the content of script, style,
    template, textarea, svg, iframe, select and datalist are no text; unclosed ones end with
    the page, but the last four hide nothing if unclosed. A button is part of its line, and
    a line of buttons alone is boilerplate. A page takes time linear in its tags. Rows are
    independent, repeated ones alike; other columns are carried along, and ones called text
    or n_chars replaced. An empty table gives one.
    """
    bound_batches(pages.sparkSession)
    carried = [c for c in pages.columns if c.lower() not in ("html", "text", "n_chars")]
    rows = pages.select(*[F.col(f"`{c}`") for c in carried], "html")
    kept = rows.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html"):
            texts = [main_text(page, rules) for page in piece.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(c) for c in carried],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                [*carried, "text", "n_chars"],
            )

    return rows.mapInArrow(run, kept)
