"""Main text of HTML pages by minimum cut.

A page is read into text blocks.  A linear classifier over tag, class, link and
text features gives each block a cost of being content and one of being
boilerplate; they become its capacities to the two terminals.  Edges between
neighbouring blocks and between blocks close in the element tree make it dear to
label them differently.  The maximum flow gives the cheapest labelling; the
blocks on the content side are the text.  A name or a tag of boilerplate on an element
counts for all blocks in it, unless the element is the layout around the content.  All
weights lie in the range of the edges' capacities, so neighbours can outweigh what speaks
against a block, as for a paragraph of links inside an article.

Each page is a small graph of its own, solved in the task that reads it: nothing
is shuffled and a batch is all that is held in memory.

Defined results: null or empty html gives an empty text; a page without a
content block too; null ids stay; repeated rows are read each; other columns are
ignored; an empty table gives no row.  Unclosed and stray tags, comments and quotes never
fail.  A very long or deeply nested page is read whole; a block keeps three numbers of the
elements around it, not all of them.  Of equally cheap cuts the one with the fewest content
blocks counts.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--(?:>|->)?(?P<comment>.*?)(?:--!?>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

#: elements whose content is no text of the page
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes plaintext".split())
DROPPED = frozenset("head template svg math object video audio canvas map select datalist button".split())
#: what a head may hold, beside raw and void elements; anything else closes it
IN_HEAD = frozenset("head template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul caption".split())
#: a start tag closes an open element of these up to the nearest fence
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
FENCE = frozenset("ul ol dl table html body article section div nav aside main header footer form blockquote".split())

#: class, id and role words that mark boilerplate and content
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "contentinfo cookie cookies copyright disclaimer discussion discussions disqus feedback footer form gdpr guestbook header "
    "login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related reply replies respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser teasers toolbar topbar widget "
    "complementary".split())
#: before one of these words in a name: it tells of a part, as ``has-sidebar`` does, and marks nothing
OF_PARTS = frozenset("has have with without no not hide hides show shows".split())
GOOD_WORDS = frozenset("article body content entry main post story text".split())
#: of these, the names of a whole content
WHOLE_WORDS = frozenset("article content entry main post story".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog header search".split())

#: weights of the classifier: positive speaks for content
WEIGHTS = {"bias": -1.2, "log_words": 0.9, "link_share": -4.0, "sentence": 0.8, "heading": 0.6, "paragraph": 0.9,
           "item": -0.5, "good_tag": 3.0, "good_word": 1.0, "bad": -10.0}
#: capacities of the smoothness edges: between neighbours, and between those under the same nearest element
ADJACENT, NEAR = 0.5, 2.0


HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class Block:
    __slots__ = ("text", "tag", "number", "opened", "bad", "good", "goodword", "linked")

    def __init__(self, tag, number, opened, bad, good, goodword):
        self.text, self.linked = [], 0
        #: ``opened``: numbers of blocks that stood before each of the nearest block elements, nearest first
        self.tag, self.number, self.opened, self.bad, self.good, self.goodword = tag, number, opened, bad, good, goodword


def _attributes(raw: str) -> tuple[bool, bool, bool, bool]:
    """(names boilerplate, names content, names a whole content, hidden) by a tag's attributes."""
    bad = good = whole = hidden = False
    for m in _ATTR.finditer(raw):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            for part in value.split():
                words = [w.lower() for w in _NAME.findall(part)]
                first = next((i for i, w in enumerate(words) if w in BAD_WORDS), None)
                bad = bad or first is not None and OF_PARTS.isdisjoint(words[:first])
                good = good or not GOOD_WORDS.isdisjoint(words)
                whole = whole or not WHOLE_WORDS.isdisjoint(words)
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = hidden or name == "hidden" and raw[m.start() - 1:m.start()].isspace()
        elif name == "style":
            hidden = hidden or bool(re.search(r"display\s*:\s*none", value))
    return bad, good, whole and not bad, hidden


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    # (tag, nearest block element's tag and the numbers of blocks before it and those around it, elements around that
    # mark boilerplate, inside an article, names content, dropped)
    stack = [("", ("", ()), (), False, False, False)]
    # marks around each main, article and named content; marks with other marks below them; marks inside articles
    mains, articles, named, frames, within = [], [], [], set(), set()
    block = None
    links = serial = pos = 0
    end = len(page)
    while pos < end:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        if (text := m["text"]) is not None:
            if stack[-1][0] == "head" and not text.isspace():
                stack.pop()
            top = stack[-1]
            if top[5]:
                continue
            if "&" in text:
                text = entities.unescape(text)
            if block is None:
                if not text or text.isspace():
                    continue
                block = Block(top[1][0], len(out), top[1][1], top[2], top[3], top[4])
                out.append(block)
            block.text.append(text)
            if links:
                block.linked += len(text)
            continue
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"] or m["close2"]:
            if tag in BLOCK:
                block = None
            if tag == "br" and block is not None:
                block.text.append(" ")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    links -= sum(s[0] == "a" for s in stack[i:])
                    del stack[i:]
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, pos) if tag != "plaintext" else None
            pos = close.end() if close else end
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in BLOCK:
            block = None
        elif tag in ("br", "img", "input") and block is not None:
            block.text.append(" ")
        if tag in VOID:
            continue
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in CLOSES[tag]:
                    links -= sum(s[0] == "a" for s in stack[i:])
                    del stack[i:]
                    if tag not in ("dd", "dt", "tr", "td", "th", "li"):
                        break
                    if not any(s[0] in CLOSES[tag] for s in stack[max(1, i - 1):]):
                        break
                elif stack[i][0] in FENCE:
                    break
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            stack.pop()
        up = stack[-1]
        bad, good, whole, hidden = _attributes(attrs) if attrs else (False, False, False, False)
        if tag in ("article", "main") and not (up[5] or bad or hidden):
            (mains if tag == "main" else articles).append(up[2])
        if tag in ("article", "main", "body", "html"):
            bad = False
        # a heading group inside the article is its own, not the page's
        bad = bad or tag in BAD_TAGS and not (tag == "header" and up[3])
        marks = up[2]
        if bad:
            serial += 1
            frames.update(marks)
            marks += (serial,)
            if up[3]:
                within.add(serial)
        elif whole and tag in BLOCK and not (up[5] or hidden):
            named.append(marks)
        links += tag == "a"
        near = (tag, (len(out), *up[1][1][:2])) if tag in BLOCK else up[1]
        stack.append((tag, near, marks, up[3] or tag in ("article", "main"), up[4] or good, up[5] or hidden or tag in DROPPED))
    for b in out:
        raw = "".join(b.text)
        b.text = " ".join(raw.split())
        b.linked = min(1.0, b.linked / max(1, len(raw)))
    out = [b for b in out if b.text]
    if any(b.bad for b in out):
        _settle_marks(out, mains, articles, named, frames, within)
    return out


def _settle_marks(blocks: list[Block], mains: list[tuple], articles: list[tuple], named: list[tuple], frames: set[int],
                  within: set[int]) -> None:
    """``bad`` of each block, so far the elements around it that mark boilerplate by a name or their tag:
    True if one of them is boilerplate, not the layout that holds the content.

    Layout is what stands around a ``main``; what stands around an ``article``, when
    none is outside and the marked part has more content than the rest.  On a page whose content is all
    marked it is also an element with all of it that has other boilerplate in it, lies inside an article, or
    holds an element named as content."""
    marks = [b.bad for b in blocks]
    for b in blocks:
        b.bad = False
    size = [len(b.text) if score(b) > 0 and b.tag not in HEADINGS else 0 for b in blocks]
    outside = sum(n for n, m in zip(size, marks) if not m)
    inside = lambda layout: sum(n for n, m in zip(size, marks) if m and layout.issuperset(m))
    layout = {x for m in mains for x in m}
    if not mains and articles:
        first = set(min(articles, key=len))  # the first of those with the fewest marks
        if inside(first) > outside:
            layout = first
        else:
            layout = set()
    common = lambda tops: set.intersection(*map(set, tops)) if tops else set()
    if not outside and not any(n and layout.issuperset(m) for n, m in zip(size, marks)):
        inner = common([m for n, m, b in zip(size, marks, blocks) if n and b.good])
        whole = common([m for n, m in zip(size, marks) if n])
        layout = layout | inner & within | whole & (frames | {x for m in named for x in m})
    for b, m in zip(blocks, marks):
        b.bad = not layout.issuperset(m)


def score(b: Block) -> float:
    """The classifier's log odds that a block is content."""
    w = WEIGHTS
    s = w["bias"] + w["log_words"] * min(4.0, math.log2(1 + b.text.count(" ") + 1)) + w["link_share"] * b.linked
    if b.text[-1] in ".!?…\"”»:":
        s += w["sentence"]
    if b.tag in HEADINGS:
        s += w["heading"]
    elif b.tag in ("p", "blockquote", "pre"):
        s += w["paragraph"]
    elif b.tag in ("li", "td", "th", "dt", "dd", "option"):
        s += w["item"]
    if b.good:
        s += w["good_tag"]
    if b.goodword:
        s += w["good_word"]
    return s + w["bad"] if b.bad else s


def max_flow_side(n: int, source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut: True for the nodes on the source's side.

    ``source[i]`` and ``sink[i]`` are capacities to the terminals, ``edges`` have
    the same capacity both ways.  Flow that crosses a single node is sent first;
    the rest goes along shortest paths (blocking flows, level by level).
    """
    eps = 1e-12
    first = [min(a, b) for a, b in zip(source, sink)]
    s_left = [a - f for a, f in zip(source, first)]
    t_left = [b - f for b, f in zip(sink, first)]
    to, cap, adj = [], [], [[] for _ in range(n)]
    for a, b, c in edges:
        adj[a].append(len(to))
        to.append(b)
        cap.append(c)
        adj[b].append(len(to))
        to.append(a)
        cap.append(c)
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if s_left[i] > eps)
        for i in queue:
            level[i] = 0
        found = False
        while queue:
            u = queue.popleft()
            found = found or t_left[u] > eps
            for e in adj[u]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if not found:
            return [x >= 0 for x in level]
        at = [0] * n
        for root in range(n):
            while s_left[root] > eps and level[root] == 0:
                path, u = [], root
                while t_left[u] <= eps:
                    while at[u] < len(adj[u]):
                        e = adj[u][at[u]]
                        if cap[e] > eps and level[to[e]] == level[u] + 1:
                            break
                        at[u] += 1
                    if at[u] < len(adj[u]):
                        path.append(adj[u][at[u]])
                        u = to[path[-1]]
                    elif path:
                        e = path.pop()
                        u = to[e ^ 1]
                        at[u] += 1
                    else:
                        break
                if t_left[u] <= eps:
                    break
                push = min([s_left[root], t_left[u]] + [cap[e] for e in path])
                s_left[root] -= push
                t_left[u] -= push
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push


def label(blocks: list[Block]) -> list[bool]:
    """True for the content blocks: the minimum cut of costs and smoothness."""
    odds = [score(b) for b in blocks]
    soft = lambda x: x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))
    edges = []
    for i, (a, b) in enumerate(zip(blocks, blocks[1:])):
        # neighbours under one of the nearest elements are closer, the less the higher it stands
        near = next((NEAR / (1 << up) for up, before in enumerate(b.opened) if a.number >= before), 0.0)
        edges.append((i, i + 1, ADJACENT + near))
    return max_flow_side(len(blocks), [soft(x) for x in odds], [soft(-x) for x in odds], edges)


def main_text(page: str | None) -> str:
    """Content blocks in page order, one a line."""
    blocks = blocks_of(page) if page else []
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks)) if keep) if blocks else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, main text and its length in code points of each page."""
    def run(batches):
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"])

    one = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    return one.mapInArrow(run, "id long, url string, text string, n_chars long").withColumnsRenamed(
        {"id": id_col, "url": url_col})
