"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of running text, each with the chain of elements it stands in. A linear classifier over the
elements' names, their class, id and role words, and the block's text gives each block a cost of being called
boilerplate and one of being called content; these are the capacities from the source and to the sink. Neighbouring
blocks, and blocks that follow each other below one parent, are tied by smoothness edges whose capacity falls with
their distance in the tree. The minimum cut, found by maximum flow, separates content from boilerplate. Blocks whose
own cost outweighs all their edges are settled first, which does not change the cut.

White space is what Unicode calls so. ``<br>`` and every block element end a block. Scripts, styles, titles, comments,
form fields and hidden elements never give blocks; an embedded element (frame, drawing, list of choices, ..) without an
end tag of its own is passed over, but not what comes after it.

One word in a name says little. Where all words of a name are of page furniture (``cookie-notice``, ``sidebar``) it counts
in full; a name that merely contains one (``social-history``), or that stands at a paragraph, counts little below an
article or main element, so that sentences outweigh it there.

Defined results: a null or empty page, and one without content, has an empty text; broken and cut-off markup is read as
far as it goes; equal rows give equal rows; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import tidy

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>"'<]+|"[^"]*"|'[^']*'|["'<])*?)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""")
SKIPPED = frozenset("script style title textarea".split())
"""Elements whose content is no markup, passed over to their end tag."""
EMBEDDED = frozenset("template noscript select option optgroup datalist iframe object svg math canvas audio video".split())
"""Elements passed over to the end tag that belongs to them, if there is one."""
UNSEEN = frozenset({"head"})
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var wbr img input".split()
)
ENDS_ITSELF = {
    "p": frozenset({"p"}), "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "body": frozenset({"head"}), "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
}
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
HOLDS = frozenset("article aside body div footer header main nav ol section table td th ul form fieldset blockquote".split())
"""Elements through which a missing end tag is not guessed."""

# Weights of the classifier: above zero speaks for content.
ELEMENT = {
    "article": 3.0, "main": 2.5, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0,
    "button": -9.0, "fieldset": -6.0, "header": -7.0, "figcaption": -0.5, "address": -2.0, "p": 0.8, "blockquote": 0.6,
    "pre": 0.6, "h1": 0.8, "h2": 0.5, "h3": 0.4,
}
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner breadcrumb breadcrumbs captcha "
    "comment comments consent cookie cookies copyright dialog disclaimer discussion disqus footer form gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall "
    "popup privacy promo promoted promotion recommended related replies reply respond share sharing sidebar signin "
    "signup skip social sponsor sponsored subscribe subscription tags toolbar topbar tracking widget widgets alert "
    "contentinfo complementary search searchbox".split()
)
FURNITURE = BOILERPLATE | frozenset(
    "area bar block bottom box container content global inner item items label left link links list main message outer "
    "page panel post primary region right row secondary section site slot text the title top unit wrap wrapper".split()
)
"""Words that take nothing from a name of page furniture."""
ASIDES = frozenset("ad advert comment comments promo promoted recommended related replies reply respond sponsored".split())
"""Words that make even an article element no main text."""
CONTENT = frozenset("article articlebody body content entry main post story text".split())
HIDDEN_WEIGHT, BOILERPLATE_WEIGHT, CONTENT_WEIGHT = -20.0, -8.0, 1.5
HINT_WEIGHT = -2.0
RUNNING = frozenset("p li dd dt blockquote pre h1 h2 h3 h4 h5 h6".split())
"""Elements of running text."""
WORDS_WEIGHT, SHORT_WEIGHT, LINKS_WEIGHT, SENTENCE_WEIGHT, RIGHTS_WEIGHT, PRIOR = 1.6, -0.8, -4.0, 0.4, -3.0, -0.6
RIGHTS = re.compile(r"©|\(c\)\s*\d{4}|all rights reserved", re.I)
SAME_ELEMENT, SAME_PARENT, FARTHER, SIBLING = 2.0, 1.5, 0.4, 0.5
SCALE = 1000


@dataclass(slots=True)
class Node:
    number: int
    tag: str
    parent: int
    weight: float
    """Of the element with all those it stands in."""
    unseen: bool
    inside: bool
    """Below an article or main element."""


@dataclass(slots=True)
class Block:
    text: str
    node: Node
    linked: int


@lru_cache(1 << 14)
def attributes_weight(tag: str, source: str, inside: bool = False) -> float:
    """What class, id, role and visibility add for an element, which may be ``inside`` an article."""
    total = 0.0
    named: set[str] = set()
    names: list[set[str]] = []
    for name, *values in ATTRIBUTE.findall(source):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            total += HIDDEN_WEIGHT
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            total += HIDDEN_WEIGHT
        elif name in ("class", "id", "role", "itemprop", "aria-label"):
            names += [{w for w in re.split(r"[^a-z]+", n) if w} for n in value.split()]
            named.update(*names)
    against = named & BOILERPLATE
    whole = any(n & against and n <= FURNITURE for n in names)
    if tag in ("html", "body", "main"):
        against = set()
    elif tag == "article":
        against &= ASIDES
    elif named & CONTENT:
        against -= {"header"}  # the heading of the article
    if against:
        hint = inside and (tag in RUNNING or not whole)
        total += HINT_WEIGHT if hint else BOILERPLATE_WEIGHT
    elif named & CONTENT:
        total += CONTENT_WEIGHT
    return total


def own_ends(page: str, tag: str) -> dict[int, int]:
    """Where each element of a tag ends, by the place after its start tag; elements without an end tag are left out."""
    found, opened = {}, []
    for m in re.finditer(rf"<(/?){tag}\b[^>]*(?:>|\Z)", page, re.I):
        if not m[1]:
            opened.append(m.end())
        elif opened:
            found[opened.pop()] = m.end()
    return found


def blocks(page: str) -> list[Block]:
    """Blocks of running text in page order."""
    ends: dict[str, dict[int, int]] = {}
    found: list[Block] = []
    root = Node(0, "", -1, 0.0, False, False)
    stack, number = [root], 0
    parts: list[str] = []
    linked, link_depth = 0, 0  # characters in links of the block at hand; depth at which the link was opened
    at, end = 0, len(page)

    def text(raw: str) -> None:
        nonlocal linked
        if not stack[-1].unseen:
            raw = html.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            linked += len(raw) if link_depth else 0

    def flush() -> None:
        nonlocal linked
        if parts:
            if joined := " ".join("".join(parts).split()):
                found.append(Block(joined, stack[-1], min(linked, len(joined))))
            parts.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal link_depth
        del stack[depth:]
        if link_depth > len(stack):
            link_depth = 0

    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            text(page[at:])
            break
        if mark > at:
            text(page[at:mark])
        m = MARKUP.match(page, mark)
        if not m:  # a sign, not markup
            text("<")
            at = mark + 1
            continue
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in INLINE and tag != "input":
            if tag == "a":
                link_depth = 0 if m[1] else len(stack)
            continue
        flush()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if stack[depth].tag in ("td", "th", "table") and tag not in HOLDS:
                    break
            continue
        if tag in VOID:
            continue
        if tag in SKIPPED and not m[3].rstrip().endswith("/"):
            after = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(page, at)
            at = after.end() if after else end
            continue
        if tag in EMBEDDED:
            if tag not in ends:
                ends[tag] = own_ends(page, tag)
            if not m[3].rstrip().endswith("/"):
                at = ends[tag].get(at, at)
            continue
        if tag in CLOSES_P or tag in ENDS_ITSELF:
            closed = ENDS_ITSELF.get(tag, frozenset()) | ({"p"} if tag in CLOSES_P else set())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in closed:
                    close(depth)
                    break
                if stack[depth].tag in HOLDS:
                    break
        above = stack[-1]
        number += 1
        own = ELEMENT.get(tag, 0.0) + (attributes_weight(tag, m[3], above.inside) if m[3] else 0.0)
        if tag == "header" and above.inside:
            own += 5.5  # the heading of the article, not of the page
        inside = above.inside or tag in ("article", "main")
        stack.append(Node(number, tag, above.number, above.weight + own, above.unseen or tag in UNSEEN, inside))
    flush()
    return found


def score(block: Block) -> float:
    """Above zero: rather content."""
    n = block.text.count(" ") + 1
    share = block.linked / len(block.text)
    total = PRIOR + block.node.weight + WORDS_WEIGHT * min(n / 20, 1.5) + LINKS_WEIGHT * share
    if n < 4:
        total += SHORT_WEIGHT
    if block.text[-1] in ".!?…:;\"'”»":
        total += SENTENCE_WEIGHT
    if RIGHTS.search(block.text):
        total += RIGHTS_WEIGHT
    return total


def edges(found: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges: neighbours in the page, and followers below one parent."""
    ties, last = [], {}
    for i, block in enumerate(found):
        if i:
            before = found[i - 1].node
            if before.number == block.node.number:
                tie = SAME_ELEMENT
            elif before.parent == block.node.parent:
                tie = SAME_PARENT
            else:
                tie = FARTHER
            ties.append((i - 1, i, int(SCALE * tie)))
        k = last.get(block.node.parent)
        if k is not None and k < i - 1:
            ties.append((k, i, int(SCALE * SIBLING)))
        last[block.node.parent] = i
    return ties


def content_side(cost: list[int], ties: list[tuple[int, int, int]]) -> list[bool]:
    """The source's side of a minimum cut: ``cost`` above zero is capacity from the source, below zero to the sink."""
    n = len(cost)
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, b, c in ties:
        near[a].append((b, c))
        near[b].append((a, c))
    cost, side, todo = list(cost), [None] * n, deque(range(n))
    weight = [sum(c for _, c in near[i]) for i in range(n)]
    while todo:  # a block that outweighs its edges is on its own side in some minimum cut
        i = todo.popleft()
        if side[i] is None and abs(cost[i]) >= weight[i]:
            side[i] = cost[i] > 0
            for j, c in near[i]:
                if side[j] is None:
                    cost[j] += c if side[i] else -c
                    weight[j] -= c
                    todo.append(j)
    open_ = [i for i in range(n) if side[i] is None]
    if open_:
        for i, s in zip(open_, minimum_cut(open_, cost, ties, side), strict=True):
            side[i] = s
    return side


def minimum_cut(open_: list[int], cost: list[int], ties: list[tuple[int, int, int]], side: list[bool | None]) -> list[bool]:
    """Maximum flow over the blocks that are not settled: shortest augmenting levels, then what the source reaches."""
    at = {block: k for k, block in enumerate(open_)}
    source, sink = len(open_), len(open_) + 1
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    head: list[int] = []
    room: list[int] = []

    def arc(a: int, b: int, there: int, back: int) -> None:
        graph[a].append(len(head))
        head.append(b)
        room.append(there)
        graph[b].append(len(head))
        head.append(a)
        room.append(back)

    for block, k in at.items():
        if cost[block] > 0:
            arc(source, k, cost[block], 0)
        elif cost[block] < 0:
            arc(k, sink, -cost[block], 0)
    for a, b, c in ties:
        if side[a] is None and side[b] is None:
            arc(at[a], at[b], c, c)
    while True:
        level = [-1] * len(graph)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] and level[head[e]] < 0:
                    level[head[e]] = level[a] + 1
                    queue.append(head[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(len(open_))]
        turn, path = [0] * len(graph), []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                k = next(k for k, e in enumerate(path) if not room[e])
                a = head[path[k] ^ 1]
                del path[k:]
                continue
            if turn[a] < len(graph[a]):
                e = graph[a][turn[a]]
                if room[e] and level[head[e]] == level[a] + 1:
                    path.append(e)
                    a = head[e]
                else:
                    turn[a] += 1
            elif a == source:
                break
            else:
                e = path.pop()
                a = head[e ^ 1]
                turn[a] += 1


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    cost = [int(SCALE * score(b)) for b in found]
    side = content_side(cost, edges(found))
    return "\n".join(b.text for b, s in zip(found, side, strict=True) if s)


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; nothing is shuffled."""
    given = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x) for x in part["html"].to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()), sizes],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return given.mapInArrow(run, "page_id long, url string, text string, n_chars long")
