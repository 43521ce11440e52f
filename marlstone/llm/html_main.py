"""Main text of web pages by gradient-boosted trees over DOM nodes.

A tolerant parser builds a light tree (open elements end with their parents; a new p ends an open p). Every element gets
features: its tag, depth, size, link density, density of its subtree (characters per element), tokens of its class, id and
role, the worst tokens and tags of its ancestors, and figures of its siblings. Boosted regression trees on logistic loss give
each element the chance that it belongs to the article. Decoding is hierarchical: the best labelling of the tree in which
nothing under a dropped element is kept, found by one pass up and one down.

The trees are fitted when first needed on pages that this module writes itself, with every kind of furniture around and inside
the article and labels by construction; the number of pages is a parameter, and the corpus plays no part. The model is a few
kilobytes and is broadcast.

Defined results: null or empty pages and pages without text give an empty string; repeated rows are parsed each; markup that
is never closed is read to the end; very long pages are read whole.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import col, free_name, with_struct
from .markup import END, RAW, TEXT, VOID, events

# Tags of HTML by how they are parsed (fixed values).
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Formulas are part of the sentence they stand in.
INLINE |= frozenset("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul".split())
SAME_ENDS = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
SCOPE = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table", "tbody", "thead"]), "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"]), "option": frozenset(["select"])}
# Tokens of class, id and role that speak for or against an article (fixed values).
GOOD = frozenset("article articlebody body content copy entry main maincontent page post postbody prose story text".split())
BAD = frozenset("ad ads adslot advert advertisement alert author banner bar billboard bottom breadcrumb breadcrumbs byline comment comments community consent contact cookie cookies copyright disclaimer discussion disqus dropdown footer footnav form gdpr header hero legal links login masthead menu meta modal nav navbar navigation newsletter notice pager pagination pagehead paywall popup promo promoted reader readers recommended related replies reply respond rss search share sharing shoutbox sidebar sidebars sidenav signup site siteheader sitefooter skip social sponsor sponsored subscribe tag tags teaser toolbar top topbar tracking widget widgets colophon".split())
#: What a compound name may start with; the rest of it is looked up as well.
PLACES = ("left", "right", "top", "bottom", "site", "page", "main", "side", "upper", "lower", "header", "footer")

_ATTRS = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDE = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")

TAGS = {t: i for i, t in enumerate("? body main article section div p h1 h2 h3 blockquote pre ul ol li table td figure aside nav header footer form dl dd address fieldset details button select option".split())}
BAD_TAGS = frozenset("nav aside footer header form fieldset menu dialog address button select option".split())
FEATURES = ("tag", "depth", "chars", "link_share", "density", "good", "bad", "over_good", "over_bad", "over_bad_tag", "over_article", "n_siblings", "place", "same_tag_siblings", "share_of_parent", "words_per_block", "stops", "p_children", "bad_tag")


class Node:
    __slots__ = ("tag", "up", "kids", "parts", "depth", "good", "bad", "place", "chars", "linked", "elements", "stops", "blocks", "ps", "own")

    def __init__(self, tag: str, up: "Node | None", good: int = 0, bad: int = 0):
        self.tag, self.up, self.good, self.bad = tag, up, good, bad
        self.kids: list[Node] = []
        #: text pieces and block children in page order
        self.parts: list = []
        self.depth = up.depth + 1 if up else 0
        self.place = len(up.kids) if up else 0
        self.chars = self.linked = self.elements = self.stops = self.blocks = self.ps = self.own = 0


_NAMED: dict[str, tuple[int, int, bool]] = {}


def _named(attrs: str) -> tuple[int, int, bool]:
    """Good and bad tokens of an element's attributes, and whether it is hidden."""
    if (got := _NAMED.get(attrs)) is not None:
        return got
    good = bad = 0
    for m in _ATTRS.finditer(attrs):
        for t in map(str.lower, _NAME.findall(m[1] or m[2] or m[3] or "")):
            rest = next((t[len(p) :] for p in PLACES if t.startswith(p)), "")
            good += t in GOOD or t not in BAD and rest in GOOD
            bad += t in BAD or t not in GOOD and rest in BAD
    if len(_NAMED) > 100_000:
        _NAMED.clear()
    return _NAMED.setdefault(attrs, (good, bad, bool(_HIDE.search(attrs))))


def parse(page: str) -> Node:
    """The tree of block elements; inline elements only leave their text, links are counted; text outside all of them gets a body."""
    root = node = Node("?", None)
    in_link = 0

    def text(raw: str) -> None:
        at = node
        if at is root:
            # what stands outside every element is a body's, in page order
            if root.parts and type(root.parts[-1]) is not str and root.parts[-1].tag == "body":
                at = root.parts[-1]
            elif raw and not raw.isspace():
                at = _child(root, "body", 0, 0)
        if raw:
            at.parts.append(raw)
            if in_link:
                at.linked += len(raw)

    for kind, tag, attrs, raw in events(page):
        if kind is TEXT:
            text(raw)
            continue
        if kind is RAW:
            continue
        if kind is END:
            if tag == "a":
                in_link = 0
            elif tag in INLINE or tag in VOID:
                continue
            else:
                at = node
                while at.up and at.tag != tag:
                    at = at.up
                if at.up:
                    node = at.up
            continue
        if tag == "a":
            in_link = 1
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in VOID or tag in INLINE or tag in ("html", "head", "tbody", "thead"):
            continue
        if tag in ENDS_P:
            at = node
            while at.up and at.tag == "p":
                at = at.up
            node = at
        if tag in SAME_ENDS:
            at = node
            while at.up and at.tag not in SCOPE[tag]:
                if at.tag in SAME_ENDS[tag]:
                    node = at.up
                    break
                at = at.up
        good, bad, hidden = _named(attrs) if attrs else (0, 0, False)
        node = _child(node, tag, good, bad + 3 * hidden)
    return root


def _child(up: Node, tag: str, good: int, bad: int) -> Node:
    new = Node(tag, up, good, bad)
    up.kids.append(new)
    up.parts.append(new)
    return new


def order(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack.extend(reversed(n.kids))
    return out


def measure(nodes: list[Node]) -> list[list[float]]:
    """Features of each node; figures of subtrees are summed from the leaves up."""
    for n in reversed(nodes):
        own = 0
        for p in n.parts:
            if type(p) is str:
                k = len(p) if not p.isspace() else 0
                own += k
                n.stops += p.count(". ") + p.count(".") * (k > 0 and p.rstrip()[-1:] in ".!?")
        n.own = own
        n.chars += own
        n.elements += 1
        n.blocks += own > 0
        if up := n.up:
            up.chars += n.chars
            up.linked += n.linked
            up.elements += n.elements
            up.stops += n.stops
            up.blocks += n.blocks
            up.ps += n.tag == "p"
    over: dict[int, tuple] = {id(nodes[0]): (0, 0, 0, 0)}
    same: dict[int, Counter] = {}
    rows = []
    for n in nodes:
        up = n.up
        if up:
            g, b, t, a = over[id(up)]
            over[id(n)] = (g + up.good, b + up.bad, t + (up.tag in BAD_TAGS), a or up.tag in ("article", "main"))
        g, b, t, a = over[id(n)]
        sib = up.kids if up else [n]
        if (tags := same.get(id(up))) is None:
            tags = same[id(up)] = Counter(s.tag for s in sib)
        rows.append([
            TAGS.get(n.tag, 0), n.depth, math.log1p(n.chars), n.linked / (n.chars + 1), math.log1p(n.chars / n.elements), n.good, n.bad, g, b, t, float(a),
            math.log1p(len(sib)), n.place / len(sib), tags[n.tag] / len(sib), n.chars / (up.chars + 1) if up else 1.0, math.log1p(n.chars / (n.blocks or 1)), math.log1p(n.stops), math.log1p(n.ps), float(n.tag in BAD_TAGS),
        ])
    return rows


@dataclass
class Trees:
    """Boosted regression trees: of each node the feature, the cut, the children (or -1) and the value."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        out = np.full(len(x), self.base)
        at_row = np.arange(len(x))
        for r in self.roots:
            at = np.full(len(x), r)
            while True:
                inner = self.left[at] >= 0
                if not inner.any():
                    break
                f = np.where(inner, self.feature[at], 0)
                step = np.where(x[at_row, f] <= self.cut[at], self.left[at], self.right[at])
                at = np.where(inner, step, at)
            out += self.value[at]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, l2: float = 1.0, least: int = 8) -> Trees:
    """Newton boosting on logistic loss with binned features; splits by gain over gradient histograms."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    z = np.full(len(y), base)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for a, v in ((feature, 0), (cut, 0.0), (left, -1), (right, -1), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    for _ in range(rounds):
        prob = 1 / (1 + np.exp(-z))
        g, h = y - prob, prob * (1 - prob)
        roots.append(node())
        todo = [(roots[-1], np.arange(len(y)), 0)]
        while todo:
            at, rows, d = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-3, None, None)
            if d < depth and len(rows) >= 2 * least:
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[rows, f]
                    gl, hl, nl = (np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                    gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                    gain[(nl < least) | (len(rows) - nl < least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
            if best[1] is None:
                value[at] = float(rate * gs / (hs + l2))
                z[rows] += value[at]
                continue
            _, f, k = best
            feature[at], cut[at] = f, float(cuts[f][k])
            left[at], right[at] = node(), node()
            low = binned[rows, f] <= k
            todo += [(left[at], rows[low], d + 1), (right[at], rows[~low], d + 1)]
    return Trees(*(np.array(a) for a in (feature, cut, left, right, value, roots)), base)


def decode(nodes: list[Node], odds: np.ndarray) -> set[int]:
    """Indices of kept nodes: the likeliest labelling in which every node under a dropped one is dropped. Nodes count by their own text."""
    index = {id(n): i for i, n in enumerate(nodes)}
    keep = np.zeros(len(nodes))
    drop = np.zeros(len(nodes))
    gain = odds * np.log1p(np.array([n.own for n in nodes], dtype=float) + 1)
    for i in range(len(nodes) - 1, -1, -1):
        keep[i] += gain[i]
        if up := nodes[i].up:
            j = index[id(up)]
            keep[j] += max(keep[i], drop[i])
    kept = set()
    for i, n in enumerate(nodes):
        if (n.up is None or index[id(n.up)] in kept) and (keep[i] > drop[i] or n.up is None):
            kept.add(i)
    return kept


def blocks_of(nodes: list[Node], kept: set[int]) -> list[str]:
    """Text blocks of kept nodes in page order; a node's text between block children is a block."""
    kept_ids = {id(nodes[i]) for i in kept if nodes[i].up is not None}
    out: list[str] = []
    run: list[str] = []

    def close():
        if run:
            t = " ".join(html.unescape("".join(run)).split())
            if t:
                out.append(t)
            run.clear()

    stack: list = [(nodes[0], iter(nodes[0].parts))]
    while stack:
        n, it = stack[-1]
        for p in it:
            if type(p) is str:
                if id(n) in kept_ids:
                    run.append(p)
            else:
                close()
                stack.append((p, iter(p.parts)))
                break
        else:
            close()
            stack.pop()
    return out


def extract(pages: list[str | None], trees: Trees) -> list[str]:
    """Main texts; the trees judge the nodes of all pages at once."""
    parsed = [order(parse(p)) if p else [] for p in pages]
    rows = [r for nodes in parsed if nodes for r in measure(nodes)]
    odds = trees.score(np.array(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for nodes in parsed:
        if not nodes:
            out.append("")
            continue
        out.append(" ".join(blocks_of(nodes, decode(nodes, odds[at : at + len(nodes)]))))
        at += len(nodes)
    return out


# Training pages.

_SYLLABLES = "ba be bi bo da de do du fa fe ga go ha he in ka ke la le li lo ma me mi mo na ne no on or pa pe ra re ri ro sa se si so st ta te th ti to un va ve wa we".split()


def _prose(r: random.Random, words: int, stop: bool = True) -> str:
    out = []
    for i in range(words):
        w = "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))
        out.append((w.capitalize() if i == 0 or r.random() < 0.06 else w) + ("," if r.random() < 0.05 else "." if stop and r.random() < 0.08 else ""))
    return " ".join(out) + ("." if stop and r.random() < 0.9 else "")


def _article(r: random.Random) -> list[str]:
    """Blocks of an article, every text block with the mark that makes it content."""
    blocks = []
    if r.random() < 0.8:
        head = f"<h1>\x01{_prose(r, r.randint(1, 12), False)}</h1>"
        blocks.append(f"<header>{head}</header>" if r.random() < 0.15 else head)
    closed = r.random() < 0.7
    for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14, 25])):
        kind = r.random()
        n = r.choice([1, 2, 4, 8, 15, 30, 60, 120, 300])
        if kind < 0.75:
            body = _prose(r, n)
            if r.random() < 0.2:
                body = f"<b>{body}" + ("</b>" if r.random() < 0.5 else "<br>")
            elif r.random() < 0.2:
                body += f' <a href="/x">{_prose(r, 2, False)}</a> ' + _prose(r, 5)
            blocks.append(f"<p>\x01{body}" + ("</p>" if closed else ""))
        elif kind < 0.82:
            level = r.choice("23")
            blocks.append(f"<h{level}>\x01{_prose(r, r.randint(1, 7), False)}</h{level}>")
        elif kind < 0.87:
            blocks.append(f"<blockquote>\x01{_prose(r, n)}</blockquote>")
        elif kind < 0.92:
            blocks.append("<ul>" + "".join(f"<li>\x01{_prose(r, r.randint(2, 20))}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
        elif kind < 0.95:
            blocks.append("<table>" + "".join("<tr>" + "".join(f"<td>\x01{_prose(r, r.randint(1, 3), False)}</td>" for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>")
        else:
            blocks.append(f"<div>\x01{_prose(r, n)}</div>")
    return blocks


def _furniture(r: random.Random, where: str) -> str:
    """Something that is no part of the article."""
    pick = r.choice
    links = lambda n: "".join(f'<li><a href="/{_prose(r, 1, False)}">{_prose(r, r.randint(1, 3), False)}</a></li>' for _ in range(n))
    name = lambda *names: pick(["class", "id"]) + '="' + pick(names) + '"'
    some = _prose(r, pick([3, 6, 12, 25, 60]))
    kinds = {
        "nav": lambda: f"<nav><ul>{links(r.randint(3, 9))}</ul></nav>",
        "menu": lambda: f"<div {name('menu', 'main-menu', 'nav', 'navbar', 'site-navigation')}><ul>{links(r.randint(3, 12))}</ul></div>",
        "header": lambda: f"<header><div {name('logo', 'site-title', 'masthead')}>{_prose(r, 3, False)}</div><p>{_prose(r, 8)}</p></header>",
        "headdiv": lambda: f"<div {name('header', 'site-header', 'top-bar')}><p>{some}</p></div>",
        "ad": lambda: f"<div {name('ad', 'ads', 'advert', 'ad-slot', 'banner', 'sponsored', 'promo')}>" + pick([some, f"<p>{some}</p>", f'<a href="/buy">{some}</a>']) + "</div>",
        "aside": lambda: "<aside>" + pick([f"<p>{some}</p>", f"<h3>{_prose(r, 2, False)}</h3><ul>{links(5)}</ul>", f"<p>{_prose(r, 80)}</p><p>{_prose(r, 40)}</p>"]) + "</aside>",
        "sidebar": lambda: f"<div {name('sidebar', 'side-bar', 'related', 'widget', 'recommended')}>" + pick([f"<p>{some}</p>", f"<h3>{_prose(r, 2, False)}</h3><ul>{links(6)}</ul>"]) + "</div>",
        "notice": lambda: f"<{(t := pick(['div', 'section']))} {name('cookie-notice', 'cookie', 'notice', 'gdpr-banner', 'consent', 'alert')}>" + pick([some, f"<p>{some}</p>"]) + f"<button>ok</button></{t}>",
        "form": lambda: f"<form action='/s'><label>{_prose(r, 4)}</label><input name=q><p>{some}</p><button>go</button></form>",
        "newsletter": lambda: f"<div {name('newsletter', 'subscribe', 'signup', 'share', 'social')}><p>{some}</p></div>",
        "comments": lambda: f"<{(t := pick(['section', 'div']))} {name('comments', 'comment-list', 'reader-comments', 'discussion', 'replies')}><h2>{_prose(r, 2, False)}</h2>" + "".join(pick(['<div class="comment"><p>{}</p></div>', "<p>{}</p>", "<article><p>{}</p></article>", "<li>{}</li>"]).format(_prose(r, pick([5, 20, 60]))) for _ in range(r.randint(1, 6))) + f"</{t}>",
        "footer": lambda: f"<footer>{pick([some, f'<p>{some}</p>', '&copy; ' + some])}</footer>",
        "footdiv": lambda: f"<div {name('footer', 'site-footer', 'bottom', 'copyright')}><p>{some}</p></div>",
        "script": lambda: '<script>var t="</p>";f(1);</script>',
        "comment": lambda: "<!-- ad 12 -->",
    }
    by = {
        "top": "nav nav menu header headdiv ad notice script comment form", "side": "aside sidebar ad newsletter menu form", "in": "ad aside newsletter sidebar script comment form notice comments menu",
        "end": "footer footer footdiv comments comments sidebar newsletter notice ad",
    }
    return kinds[pick(by[where].split())]()


def _table_page(r: random.Random, inner: str) -> str:
    """A page laid out as a table: a name above, links on one or both sides, a line below."""
    links = lambda n: r.choice(["<br>", " ", ""]).join(f'<a href="/{i}">{_prose(r, r.randint(1, 2), False)}</a>' for i in range(n))
    cell = lambda names, body: f'<td{r.choice(["", "", f" class={r.choice(names)}"])}>{body}</td>'
    left, right = (cell(names, links(r.randint(2, 9))) if r.random() < p else "" for names, p in ((("leftmenu", "nav"), 0.9), (("rightads", "sidebar"), 0.5)))
    top, low = f"<font size=5>{_prose(r, r.randint(1, 3), False)}</font>", f"<font size=1>{_prose(r, r.randint(3, 9))}</font>"
    return f'<table><tr><td colspan=3>{top}</td></tr><tr>{left}{cell(("story", "content", "main"), inner)}{right}</tr><tr><td colspan=3>{low}</td></tr></table>'


def _bare_page(r: random.Random) -> str:
    """Text with hardly any markup: runs of it, a bold word, perhaps a paragraph."""
    run = lambda: r.choice(["\x01{}", "\x01{}", "\x01<b>{}</b>"]).format(_prose(r, r.choice([2, 4, 9, 30]), r.random() < 0.7)) + r.choice(["", "<br>", " "])
    page = "".join(f"<p>\x01{_prose(r, r.choice([3, 8, 30]))}</p>" if r.random() < 0.3 else run() for _ in range(r.randint(1, 5)))
    return r.choice(["{}", "<body>{}</body>", "<html><head><title>t</title></head>{}", "<body>{}</body>\x01tail text"]).format(page)


def training_page(r: random.Random) -> str:
    """A page whose content text starts with \\x01 in each block."""
    if r.random() < 0.08:
        return _bare_page(r)
    blocks = _article(r)
    for _ in range(r.choice([0, 0, 0, 1, 2])):
        blocks.insert(r.randint(0, len(blocks)), _furniture(r, "in"))
    inner = "".join(blocks)
    wrap = r.choice(["<article>{}</article>"] * 3 + ["<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>', '<div id="main"><div class="post-body">{}</div></div>', '<div class="article-text">{}</div>', '<div><div class="story">{}</div></div>', '<article class="post"><div class="entry-content">{}</div></article>', "<div>{}</div>"])
    put = lambda where, most: "".join(_furniture(r, where) for _ in range(r.randint(0, most)))
    if r.random() < 0.12:
        page = _table_page(r, inner)
    else:
        page = put("top", 4) + put("side", 1) + wrap.format(inner) + put("side", 2) + put("end", 3)
    if r.random() < 0.3:
        page = f'<div class="{r.choice(["wrapper", "page", "container", "layout"])}">{page}</div>'
    head = f"<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>{_prose(r, 5, False)}</title><style>p{{margin:0}}</style></head><body>"
    return head + page + ("</body></html>" if r.random() < 0.9 else "")


def labelled(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of training pages: a node is content if most text under it is."""
    xs, ys = [], []
    for page in pages:
        nodes = order(parse(page))
        good = [0] * len(nodes)
        index = {id(n): i for i, n in enumerate(nodes)}
        for i, n in enumerate(nodes):
            mine = any(type(p) is str and "\x01" in p for p in n.parts)
            n.parts = [p.replace("\x01", "") if type(p) is str else p for p in n.parts]
            good[i] = sum(len(p) for p in n.parts if type(p) is str) if mine else 0
        rows = measure(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            good[index[id(nodes[i].up)]] += good[i]
        for i, n in enumerate(nodes):
            if n.chars and n.up:
                xs.append(rows[i])
                ys.append(good[i] * 2 > n.chars)
    return np.array(xs), np.array(ys, dtype=float)


_TREES: dict[tuple, Trees] = {}


def trees(pages: int = 500, seed: int = 7) -> Trees:
    """The trees, fitted on this many pages of this module's own; a process fits them once."""
    if (pages, seed) not in _TREES:
        r = random.Random(seed)
        _TREES[pages, seed] = fit_trees(*labelled([training_page(r) for _ in range(pages)]))
    return _TREES[pages, seed]


def main_text(pages: DataFrame, html_col: str = "html", out: str = "main", model: Trees | None = None) -> DataFrame:
    """pages with a struct column: text, the article's blocks joined by one space."""
    shared = pages.sparkSession.sparkContext.broadcast(model or trees())

    def run(given):
        made: list[str] = []
        for k in range(0, len(given), 500):
            made += extract(given[k : k + 500], shared.value)
        return [made]

    return with_struct(pages, free_name(pages, out), [col(html_col)], run, T.StructType([T.StructField("text", T.StringType())]))
