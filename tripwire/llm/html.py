"""Main text of web pages by minimum-cut labelling of text blocks.

A page is read once into text blocks with their element paths. Each block gets
a cost of being called boilerplate and one of being called content from a
log-linear classifier over its path and text; they are the capacities of its
edges to the two terminals. Smoothness edges join blocks that are adjacent
and blocks that share a container, weaker the farther their paths part. The
maximum flow between the terminals gives the labelling of least total cost; the
blocks left on the content side are the text.

Pages are independent: the work is a narrow map over Arrow batches.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES of HTML: elements without content, with raw text, that end an open
# paragraph, and that are inline.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
#: Raw elements that end at once with a self-closing sign: HTML honours it on foreign elements only.
FOREIGN = frozenset(("svg", "math"))
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output "
                   "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements of an own kind that close an open one when they begin.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Containers that such a beginning does not reach beyond.
SCOPE = frozenset("html body table ul ol dl select article section main aside nav div form header footer blockquote td th".split())

# The classifier's weights (logits for content). Evidence of a path counts at each
# of its elements, evidence of a name at each class or id.
TAG_WEIGHT = {"article": 3.0, "main": 2.5, "p": 0.8, "h1": 0.8, "h2": 0.6, "h3": 0.5, "h4": 0.4, "blockquote": 0.8, "pre": 0.8, "td": -0.1,
              "figcaption": 0.5, "nav": -8.0, "header": -3.0, "footer": -8.0, "aside": -8.0, "form": -8.0, "button": -8.0, "select": -8.0,
              "menu": -8.0, "dialog": -8.0, "label": -3.0, "fieldset": -5.0, "address": -1.0, "option": -8.0, "head": -20.0}
# Names (each class, id and role) are read word by word.
GOOD_WORD = re.compile(r"article|content|entry|post|story|main|body|text")
BAD_WORD = re.compile(r"ads?|adsense|adbox|adslot|adunit|advert\w*|banner\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header\w*|masthead|"
                      r"footer\w*|foot|copyright|sidebar\w*|side|rail|widget\w*|related\w*|recommend\w*|share|sharing|social\w*|comment\w*|replies|reply|"
                      r"discussion|disqus\w*|respond|cookie\w*|consent|notice\w*|gdpr|popup\w*|modal\w*|overlay|newsletter\w*|subscribe|subscription|signup|"
                      r"login|search\w*|form|toolbar|pager|pagination|tags?|skip|legal|alert\w*")
#: Bad words that name no topic of a text: bad whatever stands beside them.
SURE_WORD = re.compile(r"adsense|adbox|adslot|adunit|breadcrumbs?|masthead|footer\w*|sidebar\w*|disqus\w*|gdpr|popup\w*|newsletter\w*|pagination|signup|login|navbar|navlinks?")
#: Words of layout; a name of bad words and these (related-posts, search-box) is a part of the page, not a topic.
LAYOUT_WORD = re.compile(r"bar|box|list|links?|block|wrap\w*|container|area|section|inner|outer|top|bottom|left|right|items?|button|buttons|btn|panel|"
                         r"page|site|posts|articles|stories|news|primary|secondary|title|head|heading|row|col|column|grid|group|widget|module|unit|slot|"
                         r"thread|count|meta|icons?|input|field|holder|region|zone|layout|fixed|sticky|global|mobile|desktop|user|reader|readers|js|the|new|[a-z]|\d+")
#: A name of both kinds is boilerplate (post-comments, comment-body), but for these: a
#: column's frame or neighbour (content-sidebar-wrap, main-with-sidebar), a headline's box (entry-header).
NEUTRAL_NAME = re.compile(r"(?:^|-)(?:with|without|has|no)-(?:\w+-)*(?:sidebar\w*|side|rail)(?:-|$)|(?:sidebar\w*|side|rail)-(?:wrap\w*|container|layout|inner|row|grid)$|"
                          r"^(?:article|content|entry|post|story)-header$")
#: Weights of a name: good, bad, and bad words beside words of a topic, which ends
#: in a bad word (acme-comments, binary-search) or not (side-effects, related-work).
GOOD, BAD, ENDS_BAD, HAS_BAD = 1.0, -8.0, -3.0, -1.5
BIAS, LINK_WEIGHT, LONG_WEIGHT, END_WEIGHT = -0.4, -3.5, 0.6, 0.4
#: A headline is often one link to its own page.
TITLE_LINK = 0.25
#: Smoothness: between neighbours, halved for each step of path between them. Beyond
#: FAR steps the edge is under 1e-9 and left out.
ADJACENT, SIBLING, FAR = 1.2, 0.6, 32

# Every alternative matches to the end of the page if its own end is missing, so
# each character is read once. A quote opens a value only after "=" and only if it is closed.
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*+(?:>|$)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|$)|"
                   r"<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|$)", re.S)
ATTR = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+))?+)?+")
EVIDENCE = frozenset("class id role hidden aria-hidden style".split())
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|$)", re.I) for t in RAW}
WHITE = re.compile(r"[ \t\n\r\f\v]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Element:
    """An open element. What it and the block elements around it say is summed up when it opens, so that a
    block of text needs no copy of its path: the strongest sign of content, all signs of boilerplate, hidden."""
    __slots__ = ("tag", "inline", "up", "depth", "good", "bad", "hidden")

    def __init__(self, tag: str, up: Element | None, weight: float, hidden: bool):
        self.tag, self.inline, self.up = tag, tag in INLINE, up
        self.depth = up.depth + 1 if up else 1
        self.good = max(up.good if up else 0.0, weight)
        self.bad = (up.bad if up else 0.0) + min(weight, 0.0)
        self.hidden = hidden or bool(up and up.hidden)


class Block:
    """A run of text between block-level tags: its text, the share of characters
    inside links, and the innermost block element around it (None: none)."""
    __slots__ = ("text", "linked", "at")

    def __init__(self, text: str, linked: int, at: Element | None):
        self.text, self.linked, self.at = text, linked, at


def name_weight(value: str) -> float:
    """Evidence of a class, id or role. Its names are judged one by one: a name whose words are all bad, good
    or of layout is boilerplate if one is bad; bad words beside words of a topic weigh little, for headings'
    anchors look like that. Good and bad names together tell nothing."""
    good, worst = False, 0.0
    for name in value.lower().replace("_", "-").split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        is_bad = [bool(BAD_WORD.fullmatch(w)) for w in words]
        is_good = [bool(GOOD_WORD.fullmatch(w)) for w in words]
        if not any(is_bad):
            good |= any(is_good)
        elif any(is_good) and NEUTRAL_NAME.search(name):
            continue
        elif any(map(SURE_WORD.fullmatch, words)) or all(b or g or LAYOUT_WORD.fullmatch(w) for w, b, g in zip(words, is_bad, is_good)):
            worst = min(worst, BAD)
        else:
            last = next(b for w, b in zip(reversed(words), reversed(is_bad)) if b or not LAYOUT_WORD.fullmatch(w))
            worst = min(worst, ENDS_BAD if last else HAS_BAD)
    return GOOD if good and not worst else 0.0 if good else worst


def _element(tag: str, attrs: str, up: Element | None) -> Element:
    weight, hidden = TAG_WEIGHT.get(tag, 0.0), False
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name not in EVIDENCE:
            continue
        if name in ("class", "id", "role"):
            if tag not in ("html", "body"):  # a page's own classes tell what it has beside
                weight += name_weight(value)
        elif name == "style":
            hidden |= bool(HIDDEN.search(value))
        else:
            hidden |= value.lower() != "false"
    return Element(tag, up, weight, hidden)


class _Open:
    """The stack of open elements with the places of each tag, so that no tag searches it."""

    def __init__(self) -> None:
        self.all: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.block: list[int] = []
        self.scope: list[int] = []

    def last(self, *tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.all))
        if not e.inline:
            self.block.append(len(self.all))
        if e.tag in SCOPE:
            self.scope.append(len(self.all))
        self.all.append(e)

    def pop(self) -> None:
        e = self.all.pop()
        self.places[e.tag].pop()
        if not e.inline:
            self.block.pop()
        if e.tag in SCOPE:
            self.scope.pop()

    def home(self) -> Element | None:
        return self.all[self.block[-1]] if self.block else None


def blocks(html: str) -> list[Block]:
    """Text blocks of a page in order, in time linear in its length. Unclosed,
    crossed and truncated markup is read as far as it goes; a closing tag without
    an open element is ignored. Character references are decoded in each run of
    text between tags. Inside a block HTML's white space (and vertical tabs)
    folds into one space; no-break and other Unicode spaces are text there and
    trimmed at its ends only."""
    out: list[Block] = []
    stack = _Open()
    text: list[str] = []
    linked = at = 0

    def add(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        if stack.places.get("a"):
            linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if text:
            s = WHITE.sub(" ", "".join(text)).strip()
            if s:
                out.append(Block(s, linked, stack.home()))
            text.clear()
        linked = 0

    def close(i: int) -> None:
        if stack.block and stack.block[-1] >= i:
            flush()
        while len(stack.all) > i:
            stack.pop()

    while m := TOKEN.search(html, at):
        if m.start() > at:
            add(unescape(html[at: m.start()]))
        at = m.end()
        if m[1] is not None:
            text.append(m[1])
        elif m[2]:
            tag = m[2].lower()
            i = stack.last(tag)
            # an inline end does not close a block
            if i >= 0 and not (tag in INLINE and stack.block and stack.block[-1] > i):
                close(i)
            if tag not in INLINE:
                flush()
        elif m[3]:
            tag, attrs = m[3].lower(), m[4]
            closed = attrs.endswith("/")
            if tag in RAW:
                # a slash right after an unquoted value is the value's and closes nothing
                if not (tag in FOREIGN and closed and not any(a[4] and a.end() == len(attrs) for a in ATTR.finditer(attrs))):
                    end = RAW_END[tag].search(html, at)
                    at = end.end() if end else len(html)
                if tag not in INLINE and tag != "noscript":
                    text.append(" ")
                continue
            if tag == "br":
                text.append("\n")
                continue
            if tag not in INLINE:
                flush()
                open_p = stack.last("p")
                if open_p >= 0:
                    close(open_p)
                i = stack.last(*CLOSES.get(tag, ()))
                if i >= 0 and i >= (stack.scope[-1] if stack.scope else -1):
                    close(i)
            if tag in VOID or closed:
                continue
            stack.push(_element(tag, attrs, stack.home()))
    if at < len(html):
        add(unescape(html[at:]))
    flush()
    return out


def logit(b: Block) -> float:
    """Log odds of content: evidence of the path, link share, length, sentence end."""
    good, bad = (b.at.good, b.at.bad) if b.at else (0.0, 0.0)
    if b.at and b.at.hidden:
        return -20.0
    # the strongest sign of content on the path counts, but every sign of boilerplate
    z = BIAS + good + bad
    z += LINK_WEIGHT * min(1.0, b.linked / len(b.text)) * (TITLE_LINK if b.at and b.at.tag == "h1" else 1.0)
    z += LONG_WEIGHT * math.log2(1 + len(b.text) / 40)
    return max(-20.0, min(20.0, z + END_WEIGHT * (b.text[-1] in ".!?:;\"'”»…")))


def _near(a: Element | None, b: Element | None) -> int:
    """Steps of path from a up to the last shared element and down to b, over FAR if it is far."""
    steps = 0
    while a is not b and steps <= FAR:
        if b is None or a is not None and a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        steps += 1
    return steps


def smooth_edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours in page order, and each block with the last one before it that
    ends in the same container (DOM proximity)."""
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            steps = _near(found[i - 1].at, b.at)
            if steps <= FAR:
                edges.append((i - 1, i, ADJACENT * 0.5 ** max(0, steps - 2)))
        home = b.at.up if b.at else None
        if home in last and last[home] != i - 1:
            edges.append((last[home], i, SIBLING))
        last[home] = i
    return edges


def min_cut(costs: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: costs[i] = (cost of boilerplate, cost of content).

    Shortest augmenting paths level by level (Dinic). Flow that can go straight
    from terminal to terminal through one block is taken off beforehand. True:
    reachable from the content terminal in the residual graph."""
    n = len(costs)
    surplus = [a - b for a, b in costs]  # capacity left from the source (> 0) or to the sink (< 0)
    graph: list[list[list]] = [[] for _ in range(n)]  # [to, capacity, reverse edge]
    for u, v, c in edges:
        if c > 1e-9:
            e, r = [v, c, None], [u, c, None]
            e[2], r[2] = r, e
            graph[u].append(e)
            graph[v].append(r)
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if surplus[i] > 1e-9)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            u = queue.popleft()
            reached |= surplus[u] < -1e-9
            for e in graph[u]:
                if e[1] > 1e-9 and level[e[0]] < 0:
                    level[e[0]] = level[u] + 1
                    queue.append(e[0])
        if not reached:
            return [x >= 0 for x in level]
        pointer = [0] * n
        for s in range(n):
            while surplus[s] > 1e-9 and level[s] == 0:
                path, u = [], s
                while surplus[u] >= -1e-9 or u == s:
                    if pointer[u] < len(graph[u]):
                        e = graph[u][pointer[u]]
                        if e[1] > 1e-9 and level[e[0]] == level[u] + 1:
                            path.append(e)
                            u = e[0]
                        else:
                            pointer[u] += 1
                    elif path:
                        u = path.pop()[2][0]
                        pointer[u] += 1
                    else:
                        break
                if not path:
                    break
                f = min(surplus[s], -surplus[u], min(e[1] for e in path))
                for e in path:
                    e[1] -= f
                    e[2][1] += f
                surplus[s] -= f
                surplus[u] += f


def main_text(html: str | None) -> str:
    """The content blocks of a page, joined by line feeds; empty if none."""
    found = blocks(html) if html else []
    if not found:
        return ""
    costs = []
    for b in found:
        z = logit(b)
        costs.append((max(z, 0.0), max(-z, 0.0)))
    labels = min_cut(costs, smooth_edges(found))
    return "\n".join(b.text for b, keep in zip(found, labels) if keep)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for each input row. Null or empty html has empty
    text; repeated rows and null ids stay; other columns are not read."""
    @F.pandas_udf("string")
    def run(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in pages:
            yield pd.Series([main_text(h) for h in s], dtype=object)

    out = df.select(F.col(id_col), F.col(url_col), run(F.col(html_col).cast("string")).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
