"""HTML extraction: main text and boilerplate told apart by a minimum cut.

A page is read as a sequence of blocks of text with the elements around them. A linear classifier
gives every block a cost for either label, which become the capacities to the two terminals.
Blocks that follow each other, and blocks of the same element, are joined by edges that cost
something to cut, the more the nearer they are in the document tree. The minimum cut is the
labelling of smallest total cost; the blocks on the content side are the text.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Elements of HTML by what they do to text.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")
# Elements whose contents are parsed but are no text of the page.
SILENT = ("template", "svg", "math", "select", "datalist", "object", "canvas", "audio", "video")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr label".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An element on the left is ended by the start of one on the right.
ENDED_BY = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
        " footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}
CONTAINERS = frozenset("article aside body div main nav section table td ul ol dl header footer form".split())

# The classifier, in hundredths: what speaks for content and what against it.
BIAS, PER_DOUBLING, MOST_DOUBLINGS, SENTENCE, LINKED = -220, 40, 8, 60, -420
OF_TAG = {"p": 120, "blockquote": 100, "pre": 100, "h1": 60, "h2": 60, "h3": 60, "h4": 40, "h5": 40,
          "h6": 40, "li": -20, "td": -20, "th": -40, "figcaption": 0}
OF_ELEMENT = {"article": 320, "main": 240, "nav": -900, "aside": -900, "footer": -900, "header": -900,
              "form": -900, "menu": -900, "dialog": -900, "button": -900, "fieldset": -600, "head": -900,
              "address": -200, "figure": -60, "details": -100, "option": -900}
HEADER_OF_ARTICLE = -200
GOOD_NAME, BAD_NAME, HIDDEN = 180, -900, -1200
GOOD = re.compile(r"article|content|main|post|entry|story|text|body")
BAD = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs bottom byline"
    " comment comments commentlist consent contentinfo complementary cookie cookies copyright dialog"
    " disclaimer disqus feedback foot footer footnav gdpr head header legal links login masthead menu"
    " menubar meta modal nav navbar navigation newsletter notice notices notification overlay pager"
    " pagination paywall popup privacy promo promotion promoted rail recommend recommended register"
    " related replies reply respond search share sharing side sidebar signup sitemap skip social sponsor"
    " sponsored subscribe tags teaser toolbar topbar trending warning alert widget discussion reviews".split()
)
# Words that name the box and not what is in it; names that say what an article is about; names
# that are a phrase; and words of a heading, which an article has too.
BOX = frozenset(
    "wrapper wrap inner outer container section box area list block item items slot unit panel bar row"
    " col column group form zone holder frame top left right".split()
)
TOPIC = re.compile(r"(?:category|cat|tags?|topic|label|term|tax|taxonomy|author|format|status|keyword)[-_]", re.I)
PHRASE = re.compile(r"side[-_]by[-_]side|head[-_]to[-_]head|(?:has|with|without|no)[-_]", re.I)
HEADING = frozenset(["head", "header"])
# Edges: following blocks of one element, of elements a few steps apart, and the next of the
# same element behind something else.
BESIDE, APART, RESUMED = 90, 45, 60

# A tag with quoted values and no "<" in them; the beginning of any other, whose end is found by
# ``_tag_end``; markup that is no element; an unfinished tag.
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+>|(?=[^<>]*+[<>]))"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"[\s/]*+=?[^\s/<>=]++(?:\s*+=\s*+(?:([\"'])|[^\s<>]*+))?+|[\s/]*+=")
_CLOSED = re.compile(r"[\s/]*+>")
_STRAY = re.compile(r"[^<>]*+>")
_MARKUP = re.compile(r"</[^>]*(?:>|\Z)")
_PAIR = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE = re.compile(r"[.!?…。]['\"”’)]*\s|[.!?…。]['\"”’)]*$")


class Block(NamedTuple):
    text: str
    element: int
    depth: int
    cost: int


class _Element:
    __slots__ = ("tag", "number", "cost", "article")

    def __init__(self, tag: str, number: int, cost: int, article: bool) -> None:
        self.tag, self.number, self.cost, self.article = tag, number, cost, article


def _name_cost(name: str) -> int:
    """What one class, identifier or role says: a word against content counts at the beginning of
    the name or at its end, words for boxes aside; inside a longer name it is part of a topic."""
    if TOPIC.match(name) or PHRASE.match(name):
        return 0
    words = [w.lower() for w in _WORD.findall(name)]
    while len(words) > 1 and words[-1] in BOX:
        words.pop()
    if not words:
        return 0
    good = GOOD.search(words[0])
    if words[-1] in BAD:
        return HEADER_OF_ARTICLE if good and words[-1] in HEADING else BAD_NAME
    if words[0] in BAD and (len(words) < 3 or words[0] != "side"):
        return BAD_NAME
    return GOOD_NAME if GOOD.search(name.lower()) else 0


def _named(attributes: str) -> int:
    """The cost of an element by its own attributes, the first of each name."""
    own: dict[str, str] = {}
    for name, *values in _PAIR.findall(attributes):
        own.setdefault(name.lower(), "".join(values))
    unseen = "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(own.get("style", ""))
    names = " ".join(own.get(n, "") for n in ("class", "id", "role")).split()
    costs = [_name_cost(n) for n in names]
    against = min(costs, default=0)
    return (HIDDEN if unseen else 0) + (against if against < 0 else max(costs, default=0))


def _element(tag: str, attributes: str, number: int, parent: _Element) -> _Element:
    own = OF_ELEMENT.get(tag, 0)
    if tag == "header" and parent.article:
        own = HEADER_OF_ARTICLE
    if attributes and tag not in ("body", "html"):
        own += _named(attributes)
    # What speaks against an element speaks against all in it; what speaks for it counts once.
    cost = parent.cost + own if own < 0 else max(parent.cost, own) if parent.cost >= 0 else parent.cost
    return _Element(tag, number, cost, parent.article or tag in ("article", "main"))


def _block_cost(text: str, linked: int, tag: str, element: _Element) -> int:
    words = text.count(" ") + 1
    cost = BIAS + element.cost + OF_TAG.get(tag, 0) + PER_DOUBLING * min(MOST_DOUBLINGS, words.bit_length())
    if _SENTENCE.search(text):
        cost += SENTENCE
    if linked:
        cost += LINKED * linked // max(linked, len(text))
    if text[0] == "©":
        cost += BAD_NAME
    return cost


def _silent_ends(html: str, tag: str) -> dict[int, int]:
    """Where each element of a silent tag ends, by where its start tag does; without an end tag of
    its own it is not there, and holds nothing."""
    ends, open_at = {}, []
    for found in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>", html, re.I):
        if found.group(1):
            if open_at:
                ends[open_at.pop()] = found.end()
        elif not found.group().endswith("/>"):
            open_at.append(found.end())
    return ends


def _tag_end(html: str, at: int, known: dict[int, int]) -> int:
    """Where the tag ends whose attributes begin at ``at``, 0 if nowhere.

    A value may hold anything but its quote. ``known`` has the answer for every value met so far
    in the page, so a page is read a bounded number of times however its quotes are nested.
    """
    first, met, end = at, [], 0
    while found := _ATTRIBUTE.match(html, at):
        at = found.end()
        if found.group(1):
            if at in known:
                end = known[at]
                break
            met.append(at)
            at = html.find(found.group(1), at) + 1
            if not at:
                break
    else:
        if closed := _CLOSED.match(html, at):
            end = closed.end()
    known.update(dict.fromkeys(met, end))
    if not end and (closed := _STRAY.match(html, first)):
        return closed.end()
    return end


def page_blocks(html: str) -> list[Block]:
    """The blocks of a page in order, white space made single spaces, references decoded."""
    root = _Element("html", 0, 0, False)
    stack, blocks, number = [root], [], 0
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked, links = 0, 0
    at, size = 0, len(html)
    known: dict[int, int] = {}
    silent: dict[str, dict[int, int]] = {}

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                top = stack[-1]
                holder = top
                if top.tag not in CONTAINERS:
                    holder = next((e for e in reversed(stack) if e.tag in CONTAINERS), root)
                blocks.append(Block(text, holder.number, len(stack), _block_cost(text, linked, top.tag, top)))
            parts.clear()
        linked = 0

    while at < size:
        token = _TOKEN.search(html, at)
        if not token:
            parts.append(html[at:])
            break
        if token.start() > at:
            run = html[at : token.start()]
            parts.append(run)
            if links:
                linked += len(run)
        at = token.end()
        tag = token.group(2)
        if not tag:
            continue
        tag = tag.lower()
        end = token.group(1)
        attributes = token.group(3)
        if not attributes:
            if found := _tag_end(html, at, known):
                attributes, at = html[at:found], found
            elif end:
                at = _MARKUP.match(html, token.start()).end()
                continue
            else:  # no tag, so its "<" is text
                parts.append("<")
                linked += 1 if links else 0
                at = token.start() + 1
                continue
        if not end and tag in RAW:
            close_tag = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            if not attributes.endswith("/>"):
                at = close_tag.end() if close_tag else size
            continue
        if tag in SILENT:
            if not end:
                if tag not in silent:
                    silent[tag] = _silent_ends(html, tag)
                at = silent[tag].get(at, at)
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if end else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        close()
        if end:
            while opened[tag]:
                last = stack.pop().tag
                opened[last] -= 1
                if last == tag:
                    break
            links = 0
        elif tag not in VOID:
            while len(stack) > 1 and tag in ENDED_BY.get(stack[-1].tag, ()):
                opened[stack.pop().tag] -= 1
            number += 1
            opened[tag] += 1
            stack.append(_element(tag, attributes, number, stack[-1]))
    close()
    return blocks


def page_edges(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness: each block with the one before it, and with the last one of its element."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            before = blocks[i - 1]
            if before.element == block.element:
                edges.append((i - 1, i, BESIDE))
            else:
                edges.append((i - 1, i, APART // (1 + abs(before.depth - block.depth))))
                if block.element in last:
                    edges.append((last[block.element], i, RESUMED))
        last[block.element] = i
    return edges


def _settled(costs: list[int], edges: list[tuple[int, int, int]]):
    """Labels that hold whatever the neighbours are, found first: a block whose own cost outweighs
    all its edges keeps its side, and each of its edges then only adds to its neighbour's cost."""
    costs = list(costs)
    near: list[dict[int, int]] = [{} for _ in costs]
    for u, v, c in edges:
        near[u][v] = near[u].get(v, 0) + c
        near[v][u] = near[v].get(u, 0) + c
    label: list[bool | None] = [None] * len(costs)
    queue = deque(range(len(costs)))
    while queue:
        u = queue.popleft()
        if label[u] is None and abs(costs[u]) >= sum(near[u].values()):
            label[u] = costs[u] > 0
            for v, c in near[u].items():
                costs[v] += c if label[u] else -c
                del near[v][u]
                queue.append(v)
            near[u] = {}
    return costs, near, label


def minimum_cut(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The labelling of smallest cost: ``costs[i]`` is lost if block i is not content, the negative
    of a negative one if it is, and the capacity of an edge if its ends differ. Of equally good
    labellings the one with the fewest content blocks."""
    costs, near, label = _settled(costs, edges)
    free = [u for u, own in enumerate(label) if own is None]
    if not free:
        return [bool(own) for own in label]
    source, sink = len(costs), len(costs) + 1
    rest: dict[int, dict[int, int]] = {u: dict(near[u]) for u in free}
    rest[source], rest[sink] = {}, {}
    for u in free:
        if costs[u] > 0:
            rest[source][u], rest[u][source] = costs[u], 0
        elif costs[u] < 0:
            rest[u][sink], rest[sink][u] = -costs[u], 0
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, c in rest[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return [u in level if own is None else own for u, own in enumerate(label)]
        untried = {u: iter(list(rest[u])) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(rest[x][y] for x, y in zip(path, path[1:]))
                for x, y in zip(path, path[1:]):
                    rest[x][y] -= flow
                    rest[y][x] += flow
                cut = next(i for i, (x, y) in enumerate(zip(path, path[1:])) if not rest[x][y])
                del path[cut + 1 :]
                untried[path[-1]] = iter(list(rest[path[-1]]))
                continue
            for v in untried[u]:
                if rest[u][v] > 0 and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()
                if path:
                    level[u] = -1


def main_text(html: str | None) -> tuple[str, int, int]:
    """The text, the number of blocks of the page and how many of them the text has.

    A page none of whose blocks is content, like one with a single short line, is judged again
    without the bias against short blocks; what is named or tagged as something else stays out.
    """
    if not html:
        return "", 0, 0
    blocks = page_blocks(html)
    costs, edges = [b.cost for b in blocks], page_edges(blocks)
    content = minimum_cut(costs, edges)
    if not any(content):
        content = minimum_cut([c - BIAS for c in costs], edges)
    kept = [b.text for b, own in zip(blocks, content) if own]
    return "\n\n".join(kept), len(blocks), len(kept)


def extracted(html: Column) -> Column:
    """A struct of ``text``, ``blocks`` and ``kept`` for a column of pages."""

    @F.pandas_udf("text string, blocks int, kept int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages in batches:
            yield pd.DataFrame([main_text(p) for p in pages], columns=["text", "blocks", "kept"])

    return run(html)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text``, ``n_chars``, ``n_blocks`` and ``n_kept`` in place of ``html``.

    Blocks of the text are joined by two line ends. A page that is null, empty or has no main
    text has the text ``''``. Markup may be broken anywhere; an unfinished tag or comment at the
    end is no text. Repeated rows are treated alike; columns of ``pages`` named like the results
    are replaced. Every page is read whole, and each is a task's own work.
    """
    found = pages.withColumn("_found", extracted(F.col(html))).drop(html)
    results = {
        "text": F.col("_found.text"),
        "n_chars": F.char_length("_found.text").cast("long"),
        "n_blocks": F.col("_found.blocks"),
        "n_kept": F.col("_found.kept"),
    }
    return found.withColumns(results).drop("_found")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
