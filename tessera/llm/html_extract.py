"""Main text of HTML pages by minimum-cut labelling.

A page is cut into blocks of text. A linear classifier over tags, names, link share and wording gives
each block a cost for either label: these are the capacities to the two terminals. Neighbouring blocks,
and blocks that follow each other under one parent, are tied by smoothness edges that weigh more the
closer they are in the tree. The maximum flow separates content from boilerplate. A page is one row, so
everything about it happens in the task that reads it; time and memory follow its length.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_slices
from tessera.session import ship_package

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<""", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements whose inside is no markup; without an end tag they reach to the end of the page.
RAW = frozenset("script style title textarea xmp".split())
#: Elements whose inside is no text of the page. A start tag that has no end tag is passed over, as if it held nothing.
SILENT = frozenset("noscript template svg iframe object select button datalist noembed noframes audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike "
                   "strong sub sup time tt u var wbr br input math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover "
                   "munderover mtable mtr mtd mspace mpadded mphantom semantics annotation".split())
#: How much an element speaks for (+) or against (-) being content.
TAG_PRIOR = {"article": 6.0, "main": 4.0, "nav": -8.0, "menu": -8.0, "header": -5.0, "footer": -6.0, "aside": -6.0, "form": -7.0, "dialog": -6.0,
             "fieldset": -6.0, "address": -2.0}
#: A form can be around the whole page, so what it says is a cost that elements inside win back.
BOUNDED = frozenset(["form", "fieldset"])
AGAINST = frozenset("nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising banner promo "
                    "promotion sponsor sponsored cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe "
                    "subscription signup login share sharing social related recommended breadcrumb breadcrumbs search widget pagination pager "
                    "toolbar disclaimer copyright complementary contentinfo form".split())
#: Of these, the ones that an article may well be about.
TOPICS = frozenset("search related social form copyright navigation share sharing".split())
READERS = frozenset("comment comments reply replies respond responses disqus".split())
FOR = frozenset("article content story post entry body main text".split())
#: ``has-sidebar`` and the like tell of the page, not of the element: a name counts up to such a word only.
FLAGS = frozenset("has have no not with without hide hides hidden show shows".split())
#: Last parts that leave the meaning of a name to the part before them.
VAGUE = frozenset("wrap wrapper container inner outer box area list item items link links section block holder group buttons bar panel content text "
                  "body posts left right top bottom primary secondary".split())
HEADS = frozenset("header banner masthead".split())
_NOTICE = re.compile(r"©|\(c\)\s*\d{4}|copyright|all rights reserved|cookies?\b|privacy policy|terms of (?:use|service)|subscribe|sign up|log in", re.I)
_STOP = re.compile(r"[.!?…:;]")
#: A page-wide form holds this share of the page's text and so many paragraphs of so many words.
WIDE, PROSE_BLOCKS, PROSE_WORDS = 0.5, 2, 25
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def _heading(name: str) -> bool:
    return name[:1] == "h" and name[1:].isdigit()


@dataclass
class Block:
    text: str
    tag: str
    context: float
    linked: int
    parent: int
    depth: int
    form: int = 0  # number of the outermost form around it
    free: float = 0.0  # the context if that form said nothing


def _name_prior(name: str, inside: float) -> tuple[float, bool]:
    """What one class, id or role name says, and whether it names what readers wrote. The last part that is not
    vague decides; a name of several parts says less against its element than a whole one."""
    parts = [p.lower() for p in _PART.findall(name)]
    parts = parts[:next((i for i, p in enumerate(parts) if p in FLAGS), len(parts))]
    last = len(parts) - 1
    while last > 0 and (parts[last] in VAGUE or len(parts[last]) == 1 or parts[last].isdigit()):
        last -= 1
    if last < 0:
        return 0.0, False
    speaks = any(p in FOR for p in parts)
    if parts[last] in READERS:
        return -6.0, True
    if parts[last] in AGAINST:
        if parts[last] in HEADS and inside > 0:
            return -0.5, False  # the head of an article holds its title
        if inside > 0:  # within an article a name alone does not outweigh long prose
            return (-2.0 if parts[last] in TOPICS or any(p in FOR for p in parts[:last]) else -2.5), False
        return (-6.0 if last == len(parts) - 1 == 0 else -2.0 if any(p in FOR for p in parts[:last]) else -4.0), False
    return (2.0 if speaks and not any(p in AGAINST or p in READERS for p in parts) else 0.0), False


def _own_prior(tag: str, attributes: str, inside: float) -> tuple[float, bool]:
    """How much the element speaks for or against being content, and whether that is final: the tag's and
    readers' verdicts against are, that of other names is a cost that elements inside can win back."""
    prior = TAG_PRIOR.get(tag, 0.0)
    if tag == "header" and inside > 0:
        prior = -0.5  # the head of an article holds its title
    if attributes and tag not in ("html", "body") and tag not in INLINE:
        said = [_name_prior(n, inside) for m in _NAMED.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").split()]
        if any(readers for _, readers in said):
            return min(prior, -6.0), True
        against = min((x for x, _ in said), default=0.0)
        if prior <= 0 and against < 0:
            return min(prior, against), prior < -1 and tag not in BOUNDED
        if prior == 0 and any(x > 0 for x, _ in said):
            return 2.0, False
    return prior, prior < -1 and tag not in BOUNDED


def _context(around: float, final: bool, prior: float, own: bool) -> tuple[float, bool]:
    """Context of an element in another. The inner one decides against; inside boilerplate by tag nothing speaks for
    content again, a cost by name is won back."""
    if prior < -1:
        return min(around, prior), final or own
    if around < 0:
        return (around if final else around + max(prior, 0.0)), final
    return (max(around, prior) if prior > 0 else around + prior), final


@dataclass
class _Open:
    """An open element."""

    name: str
    context: float
    number: int
    final: bool
    form: int
    free: float
    free_final: bool


def _matched(html: str, name: str) -> dict[int, int]:
    """Where each start tag of ``name`` that has an end tag ends with it, by the start tag's place."""
    out, open_ = {}, []
    for m in re.finditer(rf"<(/?){name}\b[^>]*>", html, re.I):
        if not m[1]:
            open_.append(m.start())
        elif open_:
            out[open_.pop()] = m.end()
    return out


def blocks_of(html: str) -> list[Block]:
    """Blocks of text in page order; markup, scripts, styles and form controls hold none. Time follows the length of the
    page: what is open is counted by name, and where no tag can end any more the rest is text."""
    out: list[Block] = []
    stack = [_Open("", 0.0, 0, False, 0, 0.0, False)]
    block_places = [0]  # of the open elements that are not inline
    counts: dict[str, int] = {}  # open elements by name; inline ones since the last other element
    inline_counts: list[dict[str, int]] = [{}]
    parts: list[str] = []
    linked, links, number, at = 0, 0, 0, 0
    last_end, ends = html.rfind(">"), {}

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                i = block_places[-1]
                top = stack[-1]
                out.append(Block(text, stack[i].name, top.context, linked, stack[i - 1].number if i else 0, i, top.form, top.free))
        parts.clear()
        linked = 0

    def pop_to(i: int) -> None:
        nonlocal links
        for e in reversed(stack[i:]):
            links -= e.name == "a"
            if e.name in INLINE:
                inline_counts[-1][e.name] -= 1
            else:
                counts[e.name] -= 1
                inline_counts.pop()
                block_places.pop()
        del stack[i:]

    def say(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(text.strip())

    while at < len(html):
        if at > last_end and not html.startswith("<!--", at):
            say(unescape(html[at:]))
            break
        start, m = at, _TOKEN.match(html, at)
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if (s := m[0])[0] != "<" or s == "<":
                say(unescape(s))
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if name not in INLINE:
                flush()
            if (inline_counts[-1] if name in INLINE else counts).get(name, 0):
                i = len(stack) - 1
                while stack[i].name != name:
                    i -= 1
                pop_to(i)
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if name in SILENT:
            if name not in ends:
                ends[name] = _matched(html, name)
            at = max(at, ends[name].get(start, at))
            continue
        if name == "br":
            parts.append(" ")
        if name not in INLINE:
            flush()
            i = block_places[-1]
            top = stack[i].name
            if top == "p" or top in _SAME.get(name, ()) or _heading(top) and _heading(name):
                pop_to(i)  # its end tag was left out
        if name in VOID or attributes.endswith("/"):
            continue
        around = stack[-1]
        prior, own = _own_prior(name, attributes, around.context)
        context, final = _context(around.context, around.final, prior, own)
        form, free, free_final = around.form, around.free, around.free_final
        number += 1
        if name == "form" and not form:
            form = number
        else:
            free, free_final = _context(free, free_final, *(_own_prior(name, attributes, free) if free != around.context else (prior, own)))
        if name in INLINE:
            inline_counts[-1][name] = inline_counts[-1].get(name, 0) + 1
        else:
            counts[name] = counts.get(name, 0) + 1
            inline_counts.append({})
            block_places.append(len(stack))
        stack.append(_Open(name, context, number, final, form, free, free_final))
        links += name == "a"
    flush()
    _free_wide_forms(out)
    return out


def _free_wide_forms(blocks: list[Block]) -> None:
    """A form around most of the page with its prose is a wrapper: its blocks take the context they have without it."""
    total = sum(len(b.text) for b in blocks)
    held: dict[int, list[int]] = {}
    for b in blocks:
        if b.form:
            own = held.setdefault(b.form, [0, 0])
            own[0] += len(b.text)
            own[1] += b.text.count(" ") >= PROSE_WORDS and b.linked < len(b.text) / 2
    wide = {f for f, (n, prose) in held.items() if n >= WIDE * total and prose >= PROSE_BLOCKS}
    for b in blocks:
        if b.form in wide:
            b.context = b.free


def cost(b: Block) -> float:
    """Log-odds that the block is content."""
    n = len(b.text)
    words = b.text.count(" ") + 1
    x = b.context - 1.0 + 0.6 * np.log1p(words)
    x -= 4.0 * min(1.0, b.linked / n)
    if _STOP.search(b.text):
        x += 0.6
    if b.tag in ("p", "blockquote", "pre") or _heading(b.tag):
        x += 0.8
    elif b.tag in ("li", "td", "th", "dt", "dd", "option"):
        x -= 0.4
    if b.context <= 0 and words < 40 and _NOTICE.search(b.text):
        x -= 2.5
    return float(x)


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: node i has capacity ``costs[i]`` from it (or to the sink where
    negative), and the undirected ``edges`` theirs. Maximum flow along shortest paths (Dinic)."""
    n = len(costs)
    if not any(c > 0 for c in costs):
        return [False] * n
    to: list[int] = []
    cap: list[float] = []
    links: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        links[a].append(len(to))
        to.append(b)
        cap.append(w)
        links[b].append(len(to))
        to.append(a)
        cap.append(w)
    supply, eps = list(costs), 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i] > eps)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            if supply[i] < -eps:
                reached = True
                continue
            for e in links[i]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        turn = [0] * n
        for s in [i for i in range(n) if supply[i] > eps]:
            path: list[int] = []
            i = s
            while supply[s] > eps:
                if supply[i] < -eps:
                    flow = min(supply[s], -supply[i], *(cap[e] for e in path)) if path else 0.0
                    for e in path:
                        cap[e] -= flow
                        cap[e ^ 1] += flow
                    supply[s] -= flow
                    supply[i] += flow
                    path, i = [], s
                    continue
                while turn[i] < len(links[i]):
                    e = links[i][turn[i]]
                    if cap[e] > eps and level[to[e]] == level[i] + 1:
                        break
                    turn[i] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    i = to[e ^ 1]
                    turn[i] += 1
                    continue
                path.append(e)
                i = to[e]


def label(blocks: list[Block], smooth: float = 0.8) -> list[bool]:
    """True for the blocks that the cut leaves with content."""
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            distance = abs(a.depth - b.depth) + (0 if a.parent == b.parent else 2)
            edges.append((i - 1, i, smooth / (1 + distance)))
        if (j := last.get(b.parent)) is not None and j < i - 1:
            edges.append((j, i, smooth / 2))
        last[b.parent] = i
    return minimum_cut([cost(b) for b in blocks], edges)


def main_text(html: str | None) -> str:
    """The content blocks in page order, joined by a line feed; empty for a null, empty or textless page."""
    blocks = blocks_of(html or "")
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks)) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row, from the whole html. Repeated rows are extracted each;
    an empty table gives none. Characters are code points."""
    ship_package(pages.sparkSession)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in text_slices(batches, "html"):
            b["text"] = [main_text(h) for h in b.pop("html")]
            b["n_chars"] = b["text"].map(len).astype("int64")
            yield b

    d = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    got = d.mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return got.withColumn("page_id", F.col("page_id").cast("long"))
