"""Operator 9: main text of web pages by a tree-structured graphical model.

Every element of a page is a node that is content or not. A node has a score from its tag, its class and
id words, its text and its links; parent and child have potentials for agreeing. Sum-product messages go
up the tree and down again and give each node's content marginal. The weights are fitted by gradient steps
on the likelihood of labelled pages (exact, from the same messages), around stated prior weights, so that
hints rare in the sample keep a sensible weight. Each labelled page is learned from twice: as it is, and with its
article made a plain division without class or id, so that the weights also hold for pages that mark no article.
There the prose itself tells: paragraphs of some length that are not links, and headings above them.

Text of content nodes is cut into blocks at block elements, character references are decoded, white space
inside a block becomes one space, and blocks are joined by a line feed.

Cases: null or empty html, or a page without content: empty text; broken or cut-off markup is read as far
as it goes (unclosed elements end where HTML says or at the end; an unclosed button, select or noscript at the
next block element, so that it hides no paragraphs); a tag cut off by the end is dropped; very
long and very deep pages are read whole, without recursion; equal pages give equal texts; an empty table
gives an empty table; other columns pass through (one named like the output is replaced).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.llm.common import PerWorker, add_columns, draw

# Fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes xmp".split())
#: Elements whose whole content is no text of the page; those of SEALED hide it though they aren't closed.
SKIPPED, SEALED = frozenset("noscript template svg select button".split()), frozenset(("svg", "template"))
HIDDEN = RAW | SKIPPED | {"head", "option"}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rt rp s "
                   "samp small span strike strong sub sup time tt u var wbr br input nobr object "
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover "
                   "munderover mmultiscripts mprescripts mtable mtr mtd maction semantics annotation annotation-xml".split())
PHRASE = INLINE | HIDDEN | VOID | {"optgroup"}
#: In svg and math a '/' closes an element and nothing is raw, but for the content of HOSTS; HTML ends both before the tags of LEAVES.
FOREIGN = frozenset(("svg", "math"))
HOSTS = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
LEAVES = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
                   "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
CLOSES = {  # a start tag ends these open elements
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
    "tfoot": ("tr", "td", "th", "thead", "tbody"),
}
SCOPE = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
         "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}
NEGATIVE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
POSITIVE_TAGS = frozenset("article main".split())
NEGATIVE_WORDS = frozenset(
    "nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement sponsor sponsored promo "
    "banner cookie cookies consent notice popup modal overlay comment comments disqus reply replies respond share social "
    "related recommended breadcrumb breadcrumbs widget widgets toolbar pagination pager subscribe newsletter signup login "
    "search form copyright legal masthead tags alert".split())
POSITIVE_WORDS = frozenset("article content main post entry story body text page".split())
#: Words that say no more of a part than the listed word beside them does ("site-footer", "comment-list").
PLAIN_WORDS = frozenset(
    "area bar block bottom box btn button buttons card container global group holder inner item items left link links list "
    "listing message module news outer panel policy posts articles right row section site slot social stories thread title top "
    "unit user wrap wrapper".split())

_TAG = re.compile(r"""<(?:(?P<skip>!--(?:.*?-->|.*\Z)|[!?][^>]*(?:>|\Z))|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"""
                  r"""(?P<attrs>(?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)(?P<shut>>|\Z))""", re.S)
_HINT = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]{2,}")
#: End tag of each raw element, in the page itself: lower-casing a page can move its places.
_SHUT = {name: re.compile(rf"</{name}(?=[\s/>])", re.I | re.A) for name in RAW}

FEATURES = ("bias", "positive tag", "negative tag", "positive word", "negative word", "heading", "paragraph", "list item",
            "link", "inline", "division", "root", "long text", "short text", "no text", "mostly links",
            # a listed word beside others that change its sense; the rest only on pages that mark no article
            "doubtful word", "prose", "sentence", "heading of prose", "open root")
#: Prior weights, in the order of FEATURES; then the costs of content that begins below other nodes, and of
#: other nodes below content. The second is low: articles hold adverts, but menus hold no articles.
PRIOR = np.array([0.0, 20.0, -40.0, 4.0, -40.0, 0.2, 0.4, -0.2, -0.2, 0.0, -0.1, -40.0, 0.2, -0.2, -0.1, -1.5,
                  -0.1, 6.0, 1.5, 1.5, -3.5, 4.0, 0.8])
#: Letters of a block's own text that make a paragraph prose, any other block prose, and a paragraph a sentence.
PROSE, BARE_PROSE, SENTENCE = 80, 200, 25


@dataclass
class Page:
    """Nodes in page order (parents before children), and the text pieces with their node and block."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hints: list[str] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def parse(html: str) -> Page:
    page = Page()
    parent, tags, hints, texts = page.parent, page.tag, page.hints, page.texts
    parent.append(-1)
    tags.append("#page")
    hints.append("")
    stack, block, at, n = [0], 0, 0, len(html)
    began = [0]  # block of each node's start
    modes = [0]  # by place in the stack: the place of the svg or math whose rules hold inside; 0: those of HTML
    last: dict[str, int] = {}  # place in the stack of the last SKIPPED element of each name
    marks: list[tuple[int, int]] = []  # SKIPPED nodes not ended by their own tag yet, with the texts before them
    while True:
        m = _TAG.search(html, at)
        if m is None:
            if at < n:
                texts.append((stack[-1], block, html[at:]))
            break
        if m.start() > at:
            texts.append((stack[-1], block, html[at:m.start()]))
        at = m.end()
        name = m["name"]
        if name is None or not m["shut"]:
            continue
        name = name.lower()
        if name not in INLINE:
            block += 1
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                t = tags[stack[k]]
                if t == name:
                    if name in SKIPPED:  # what it holds goes
                        node = stack[k]
                        while marks[-1][0] > node:
                            marks.pop()
                        del texts[marks.pop()[1]:], parent[node + 1:], tags[node + 1:], hints[node + 1:], began[node + 1:]
                    del stack[k:]
                    break
                if name in INLINE and t not in INLINE:
                    break
            continue
        foreign = modes[len(stack) - 1]
        if foreign and name in LEAVES:
            del stack[foreign:]
            foreign = modes[len(stack) - 1]
        if name in SKIPPED and name not in SEALED and (k := last.get(name, 0)) and k < len(stack) and tags[stack[k]] == name:
            del stack[k:]  # these don't nest
            foreign = modes[len(stack) - 1]
        if name == "br":
            texts.append((stack[-1], block, " "))
            continue
        if name not in INLINE and name not in ("html", "head", "body"):
            _close(stack, tags, name)
        elif name == "body":
            while len(stack) > 1 and tags[stack[-1]] != "html":
                stack.pop()
        parent.append(stack[-1])
        tags.append(name)
        attrs = m["attrs"]
        hints.append(attrs if "=" in attrs else "")
        began.append(block)
        if name in VOID or (foreign or name in FOREIGN) and attrs.endswith("/"):
            continue
        if name in RAW and not foreign:  # its text is no text of the page
            shut = _SHUT[name].search(html, at)
            if shut is None:
                break
            end = html.find(">", shut.end())
            at = n if end < 0 else end + 1
            continue
        stack.append(len(parent) - 1)
        del modes[len(stack) - 1:]
        modes.append((foreign or len(stack) - 1) if name in FOREIGN else 0 if name in HOSTS else foreign)
        if name in SKIPPED:
            marks.append((len(parent) - 1, len(texts)))
            last[name] = len(stack) - 1
    if marks:
        _unseal(page, began, {node for node, _ in marks})
    return page


def _unseal(page: Page, began: list[int], unclosed: set[int]) -> None:
    """Give what follows in an unclosed SKIPPED node, from its first block element on, to the node's parent; the texts before go."""
    parent, tags = page.parent, page.tag
    under: dict[int, int] = {}  # nodes whose text the unclosed node hides
    ended: dict[int, int] = {}  # the block that ends it

    def holder(node: int) -> int | None:
        return node if node in unclosed else under.get(node)

    for i in range(1, len(parent)):
        while (u := holder(parent[i])) is not None:
            if tags[u] in SEALED or (u not in ended and tags[i] in PHRASE):
                under[i] = u
                break
            ended.setdefault(u, began[i])
            parent[i] = parent[u]
    kept = []
    for node, block, t in page.texts:
        while (u := holder(node)) is not None and u in ended and block >= ended[u]:
            node = parent[u]
        if u is None:
            kept.append((node, block, t))
    page.texts[:] = kept


def _close(stack: list[int], tags: list[str], name: str) -> None:
    """End what a block start tag ends: an open paragraph, and list or table parts of its own list or table."""
    for k in range(len(stack) - 1, 0, -1):
        t = tags[stack[k]]
        if t == "p":
            del stack[k:]
            break
        if t not in INLINE:
            break
    ends, stop = CLOSES.get(name, ()), SCOPE.get(name, ())
    if ends:
        for k in range(len(stack) - 1, 0, -1):
            t = tags[stack[k]]
            if t in stop:
                break
            if t in ends:
                del stack[k:]
                if name not in ("tr", "tbody", "tfoot"):
                    break


def hint_of(hints: str) -> str:
    """What an element's class, id and role say: "negative", "positive", "doubtful" or nothing.

    A name is negative if it holds a listed word and nothing but listed and plain words; beside other words
    ("comments-open", "related-work") a listed word is doubtful.
    """
    kinds = set()
    for h in _HINT.findall(hints):
        for name in h.lower().split():
            words = _WORD.findall(name)
            bad = [w in NEGATIVE_WORDS for w in words]
            if any(bad):
                kinds.add("negative" if all(x or w in PLAIN_WORDS or w in POSITIVE_WORDS for x, w in zip(bad, words, strict=True)) else "doubtful")
            elif not POSITIVE_WORDS.isdisjoint(words):
                kinds.add("positive")
    return next((k for k in ("negative", "positive", "doubtful") if k in kinds), "")


def node_features(page: Page) -> list[list[int]]:
    """Numbers of the features that hold, by node."""
    n = len(page.tag)
    tags, parents = page.tag, page.parent
    total, linked, own, away = [0] * n, [0] * n, [0] * n, [0] * n
    for node, _, t in page.texts:
        size = len(t.strip())
        total[node] += size
        own[node] += size
        if tags[node] == "a":
            linked[node] += size
    for i in range(n - 1, 0, -1):
        p, link = parents[i], tags[i] == "a"
        total[p] += total[i]
        linked[p] += total[i] if link else linked[i]
        if tags[i] in INLINE:  # a block's own text is also that of its phrases; ``away``: the linked part of it
            own[p] += own[i]
            away[p] += own[i] if link else away[i]
    roots = ("#page", "html", "body")
    kinds = [hint_of(h) if h and t not in roots and t not in ("a", "img") else "" for h, t in zip(page.hints, tags, strict=True)]
    # a form around most of a page is its frame
    bad = [k == "negative" or (t in NEGATIVE_TAGS or t in HIDDEN) and not (t == "form" and 2 * total[i] > total[0])
           for i, (t, k) in enumerate(zip(tags, kinds, strict=True))]
    barred = bad[:]  # in a part marked as something else
    for i in range(1, n):
        barred[i] = barred[i] or barred[parents[i]]
    marked = any(t in POSITIVE_TAGS and total[i] and not barred[i] for i, t in enumerate(tags))
    prose, headed = [False] * n, [False] * n
    if not marked:
        prose = [not barred[i] and t not in INLINE and 2 * away[i] <= own[i]
                 and own[i] >= (PROSE if t in ("p", "blockquote", "pre") else BARE_PROSE) for i, t in enumerate(tags)]
        below = [False] * n  # prose follows among the later nodes of the same parent
        for i in range(n - 1, 0, -1):
            p = parents[i]
            headed[i] = below[p]
            if prose[i]:
                below[p] = True
    out = []
    for i, t in enumerate(tags):
        f = [0]
        if t in POSITIVE_TAGS:
            f.append(1)
        elif bad[i] and kinds[i] != "negative" or t in NEGATIVE_TAGS and t != "form" or t in HIDDEN:
            f.append(2)
        elif t in ("p", "blockquote", "pre"):
            f.append(6)
            if not marked and not barred[i] and own[i] >= SENTENCE and 2 * away[i] <= own[i]:
                f.append(18)
        elif t in ("li", "td", "th", "dd", "dt"):
            f.append(7)
        elif t == "a":
            f.append(8)
        elif t in INLINE:
            f.append(9)
        elif len(t) == 2 and t[0] == "h" and t[1] in "123456":
            f.append(5)
            if headed[i] and not barred[i] and total[i]:
                f.append(19)
        elif t in ("div", "section", "form"):
            f.append(10)
        elif t in roots:
            f.append(20 if t == "body" and not marked or t == "#page" and not marked and "body" not in tags else 11)
        if kinds[i] == "negative":
            f.append(4)
        elif kinds[i] == "positive":
            f.append(3)
        elif kinds[i] == "doubtful":
            f.append(16)
        if prose[i]:
            f.append(17)
        size = total[i]
        if size > 200:
            f.append(12)
        elif size < 40:
            f.append(13 if size else 14)
        if size and 2 * linked[i] > size:
            f.append(15)
        out.append(f)
    return out


def _soft(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return a + log1p(exp(b - a)) if a > b else b + log1p(exp(a - b))


def marginals(parent: list[int], unary: list[float], begin: float, end: float):
    """Content log-odds of each node by sum-product messages up and then down the tree.

    ``begin`` is the cost of a content node below another, ``end`` that of another below content. Also the
    messages up and the beliefs from below, from which edge marginals follow.
    """
    n = len(parent)
    below = unary[:]
    up = [0.0] * n
    for i in range(n - 1, 0, -1):
        b = below[i]
        up[i] = m = _soft(-end, b) - _soft(0.0, b - begin)
        below[parent[i]] += m
    odds = below[:]
    for i in range(1, n):
        rest = odds[parent[i]] - up[i]
        odds[i] = below[i] + _soft(rest, -begin) - _soft(0.0, rest - end)
    return odds, up, below


def label_by_markup(page: Page) -> list[bool]:
    """Labels of a page whose author marked the article: what is in it, without parts marked as something else."""
    out = [False]
    for i in range(1, len(page.tag)):
        t = page.tag[i]
        if t in NEGATIVE_TAGS or t in HIDDEN or page.hints[i] and hint_of(page.hints[i]) == "negative":
            out.append(False)
        else:
            out.append(t in POSITIVE_TAGS or out[page.parent[i]])
    return out


def unmarked(page: Page) -> Page:
    """The page as if its author had marked no article: divisions for it, no class, id or role."""
    return Page(page.parent, ["div" if t in POSITIVE_TAGS else t for t in page.tag], [""] * len(page.tag), page.texts)


def fit(pages: list[tuple[Page, list[bool]]], steps: int = 30, rate: float = 0.5, prior_strength: float = 0.05) -> np.ndarray:
    """Weights from labelled pages: gradient ascent on the mean log likelihood per node, around PRIOR."""
    w = PRIOR.copy()
    k = len(FEATURES)
    given = [(p.parent, node_features(p), y) for p, y in pages]
    nodes = sum(len(y) for _, _, y in given)
    for _ in range(steps if nodes else 0):
        grad = np.zeros(k + 2)
        for parent, feats, y in given:
            odds, up, below = marginals(parent, [sum(w[j] for j in f) for f in feats], w[k], w[k + 1])
            for i, f in enumerate(feats):
                miss = y[i] - 1 / (1 + exp(-max(-40.0, min(40.0, odds[i]))))
                for j in f:
                    grad[j] += miss
                if i:
                    rest, b = odds[parent[i]] - up[i], below[i]
                    parts = np.array([rest + b, 0.0, b - w[k], rest - w[k + 1]])
                    parts = np.exp(parts - parts.max())
                    parts /= parts.sum()
                    grad[k] -= (y[i] and not y[parent[i]]) - parts[2]
                    grad[k + 1] -= (y[parent[i]] and not y[i]) - parts[3]
        w += rate * (grad / nodes - prior_strength / 100 * (w - PRIOR))
    return w


def main_text(html: str | None, weights: np.ndarray) -> str:
    if not html:
        return ""
    page = parse(html)
    w = weights.tolist() if isinstance(weights, np.ndarray) else weights
    k = len(FEATURES)
    odds, _, _ = marginals(page.parent, [sum([w[j] for j in f]) for f in node_features(page)], w[k], w[k + 1])
    blocks: list[str] = []
    current, parts = -1, []
    for node, block, t in page.texts:
        if odds[node] <= 0 or page.tag[node] in HIDDEN:
            continue
        if block != current:
            if parts and (joined := " ".join(unescape("".join(parts)).split())):
                blocks.append(joined)
            current, parts = block, []
        parts.append(t)
    if parts and (joined := " ".join(unescape("".join(parts)).split())):
        blocks.append(joined)
    return "\n".join(blocks)


#: Labelled pages learned from, at most, and the longest of them.
SAMPLE, SAMPLE_CHARS = 200, 60_000


def train(spark: SparkSession, pages: DataFrame, key: str = "page_id", html: str = "html", size: int = SAMPLE) -> np.ndarray:
    """Weights from at most ``size`` pages with a marked article, drawn by a hash of the key."""
    marked = pages.where(F.lower(F.col(html)).contains("<article") & (F.length(html) <= SAMPLE_CHARS) & F.col(key).isNotNull())
    sample = draw(marked.select(key, html), size, key, html).select(html).collect()
    parsed = [parse(r[0]) for r in sample]
    given = [(p, label_by_markup(p)) for p in parsed]
    return fit([*given, *((unmarked(p), y) for p, y in given)])


def extract(spark: SparkSession, pages: DataFrame, weights: np.ndarray, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` plus the main text ``out``."""
    shared = PerWorker(spark, weights.tolist(), list)

    def run(values: pa.Array) -> list[pa.Array]:
        w = shared.get()
        return [pa.array([main_text(v, w) for v in values.to_pylist()], pa.string())]

    return add_columns(pages, html, run, f"`{out}` string")
