"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of block elements with its runs of text as leaves. Every node has a label, content or not. The
model is a Markov random field on that tree: a node potential from the node's observed features and a parent-child
potential. Sum-product messages go up to the root and down again, which gives each node's exact marginal; leaves whose
marginal is above one half are the text, in page order.

Both potentials are smoothed log ratios of counts over labelled pages: ``SEEDS``, short pages labelled by hand with
``y="1"`` or ``y="0"`` (inherited), and at most ``SAMPLE`` pages of the table that mark their article themselves
(``article`` or ``main``). Counts are made and added up by Spark; the model is a table of a few hundred numbers.

Nulls and odd cases: a NULL or empty page gives an empty text; unclosed and stray tags are repaired as far as HTML's
implied end tags go; an unfinished tag or comment runs to the end; nothing is capped; repeated rows come back each;
extra columns are dropped; without a labelled page in the table the seeds alone are the model.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 500  # pages of the table learnt from at most
SEED_WEIGHT = 40  # a seed page counts as so many pages
SMOOTH = 0.5
# What a node's features count for; those of neighbours repeat each other, so they count for less than their ratios say.
WEIGHT = {"tag": 0.6, "hint": 5.0, "size": 0.3, "links": 1.0, "ends": 0.3}

# Element names of the HTML standard.
RAW = {"script", "style", "textarea", "template", "iframe", "noscript", "noembed", "svg", "math", "head", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
ASIDE = {"nav", "aside", "footer", "form", "button", "dialog", "menu", "search"}  # never part of an article by their meaning
# An element whose start ends an open one of these, up to the nearest element of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
# Words in class, id and role names that tell what an element is for.
AGAINST = set(
    "ad ads advert advertisement adverts alert author banner bar breadcrumb breadcrumbs byline comment comments consent "
    "contentinfo cookie cookies copyright dialog discussion disqus footer foot form gdpr header hidden legal links login "
    "masthead menu meta modal nav navbar navigation newsletter notice pager pagination popup promo promoted rail "
    "recommended related replies reply respond search share sharing sidebar side signup skip social sponsor sponsored "
    "subscribe tags toc toolbar widget".split()
)
FOR = set("article body content entry main post prose story text".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LABEL = re.compile(r'\by="([01])"')
ENDS = re.compile(r"[.!?…。](?:\s|$)|[.!?…]['\"»”)]")


@dataclass
class Tree:
    """Nodes in page order; a parent stands before its children. Leaves have a text."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hint: list[str] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters inside links
    label: list[str | None] = field(default_factory=list)

    def add(self, parent: int, tag: str, hint: str, text: str | None = None, linked: int = 0, label=None) -> int:
        for column, value in zip(
            (self.parent, self.tag, self.hint, self.text, self.linked, self.label),
            (parent, tag, hint, text, linked, label),
        ):
            column.append(value)
        return len(self.parent) - 1


def hint_of(attributes: str) -> str:
    if "=" not in attributes:
        return "none"
    found = {
        part.lower() for groups in NAMES.findall(attributes) for name in groups if name for part in PART.findall(name)
    }
    if found & AGAINST:
        return "against"
    return "for" if found & FOR else "none"


def parse(page: str) -> Tree:
    """The tree of a page; the root is node 0."""
    tree = Tree()
    tree.add(-1, "html", "none")
    stack: list[tuple[str, int, int]] = [("html", 0, 0)]  # (element, its node or its parent's, open links)
    run: list[str] = []
    plain = links = 0

    def flush() -> None:
        nonlocal run, plain, links
        if run:
            text = " ".join("".join(run).split())
            if text:
                tree.add(stack[-1][1], "#text", "none", text, len(text) * links // max(1, plain + links))
            run = []
        plain = links = 0

    def say(raw: str) -> None:
        nonlocal plain, links
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            run.append(text)
            if stack[-1][2]:
                links += len(text)
            else:
                plain += len(text)

    def close(depth: int) -> None:
        if any(name in BLOCK for name, _, _ in stack[depth:]):
            flush()
        del stack[depth:]

    at = 0
    while True:
        match = TAG.search(page, at)
        if match is None:
            say(page[at:])
            break
        say(page[at:match.start()])
        at = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if stack[depth][0] in BLOCK and name not in BLOCK:
                    break  # an inline end tag does not reach out of its block
            continue
        attributes = match[3]
        if name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else (at if name == "head" else len(page))
            continue
        if name in VOID:
            if name == "br" or name == "hr":
                run.append(" ")
                if name == "hr":
                    flush()
            continue
        if name in ("html", "body"):
            continue
        if name in BLOCK:
            flush()
            ends, stop = IMPLIED.get(name, (set(), set()))
            for depth in range(len(stack) - 1, 0, -1):
                open_name = stack[depth][0]
                if open_name == "p" or open_name in ends:
                    close(depth)
                    if open_name == "p" and not ends:
                        break
                elif open_name in stop or open_name in BLOCK:
                    break
            label = LABEL.search(attributes)
            hint = "against" if name in ASIDE else hint_of(attributes)
            node = tree.add(stack[-1][1], name, hint, label=label and label[1])
            stack.append((name, node, stack[-1][2]))
        else:
            stack.append((name, stack[-1][1], stack[-1][2] + (name == "a")))
    flush()
    return tree


def bucket(size: int) -> int:
    """Lengths by powers of four."""
    return min(7, size.bit_length() // 2)


def observe(tree: Tree) -> list[tuple[str, ...]]:
    """What is seen of each node: its element, its names' hint, text under it, share of links, ends of sentences."""
    n = len(tree.parent)
    size, linked, ends = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        text = tree.text[i]
        if text is not None:
            size[i], linked[i], ends[i] = len(text), tree.linked[i], len(ENDS.findall(text))
        if i:
            p = tree.parent[i]
            size[p] += size[i]
            linked[p] += linked[i]
            ends[p] += ends[i]
    return [
        (
            f"tag {tree.tag[i]}", f"hint {tree.hint[i]}",
            f"size {tree.text[i] is not None} {bucket(size[i])}",
            f"links {4 * linked[i] // max(1, size[i])}", f"ends {min(3, ends[i])}",
        )
        for i in range(n)
    ]


def seed_labels(tree: Tree) -> list[int]:
    """Labels written into a seed page, inherited by what stands inside."""
    out = [0] * len(tree.parent)
    for i in range(1, len(out)):
        own = tree.label[i]
        out[i] = int(own) if own is not None else out[tree.parent[i]]
    return majority(tree, out)


def marked_labels(tree: Tree) -> list[int] | None:
    """Labels of a page that marks its article; None if it does not."""
    marks = {"main"} if "article" not in tree.tag else {"article"}
    if not marks & set(tree.tag):
        return None
    out = [0] * len(tree.parent)
    for i in range(1, len(out)):
        if tree.hint[i] == "against":
            out[i] = -1  # and so is all inside
        else:
            above = out[tree.parent[i]]
            out[i] = above if above else int(tree.tag[i] in marks)
    return majority(tree, [max(0, x) for x in out])


def majority(tree: Tree, labels: list[int]) -> list[int]:
    """A node above text has the label of most of the text under it."""
    n = len(labels)
    good, bad = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        text = tree.text[i]
        if text is not None:
            (good if labels[i] else bad)[i] = len(text)
        if good[i] + bad[i]:
            labels[i] = int(good[i] > bad[i])
        if i:
            good[tree.parent[i]] += good[i]
            bad[tree.parent[i]] += bad[i]
    return labels


def tally(tree: Tree, labels: list[int], into: Counter, weight: int = 1) -> None:
    for i, seen in enumerate(observe(tree)):
        for feature in seen:
            into[feature, labels[i]] += weight
        if i:
            into[f"edge {place(tree, i)} {labels[tree.parent[i]]}", labels[i]] += weight
        else:
            into["root", labels[i]] += weight


Edge = tuple[tuple[float, float], tuple[float, float]]
PLACES = ("leaf", "top", "inner")


def place(tree: Tree, node: int) -> str:
    """The kind of edge above a node: to a leaf, from the root, or between elements."""
    return "leaf" if tree.text[node] is not None else "inner" if tree.parent[node] else "top"


@dataclass
class Model:
    node: dict[str, tuple[float, float]]
    edge: dict[str, Edge]  # by place: [parent's label][child's label]
    root: tuple[float, float]


def fit(counts: dict[tuple[str, int], int]) -> Model:
    """Log potentials from counts; a feature never seen says nothing."""
    whole = [sum(c for (f, y), c in counts.items() if y == label and f.startswith("tag ")) for label in (0, 1)]
    kinds = Counter(f.split(" ")[0] for f in {f for f, _ in counts})

    def ratio(feature: str, label: int) -> float:
        room = kinds[feature.split(" ")[0]] * SMOOTH
        weight = WEIGHT[feature.split(" ")[0]]
        return weight * math.log((counts.get((feature, label), 0) + SMOOTH) / (whole[label] + room))

    node = {f: (ratio(f, 0), ratio(f, 1)) for f in {f for f, _ in counts} if not f.startswith(("edge", "root"))}

    def share(name: str) -> tuple[float, float]:
        c = [counts.get((name, y), 0) + SMOOTH / 100 for y in (0, 1)]
        return math.log(c[0] / sum(c)), math.log(c[1] / sum(c))

    edge = {p: (share(f"edge {p} 0"), share(f"edge {p} 1")) for p in PLACES}
    return Model(node, edge, share("root"))


def add_logs(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(tree: Tree, model: Model) -> list[float]:
    """Probability of content for each node: messages up to the root, then down."""
    n = len(tree.parent)
    belief = [[0.0, 0.0] for _ in range(n)]
    for b, seen in zip(belief, observe(tree)):
        for feature in seen:
            if feature in model.node:
                zero, one = model.node[feature]
                b[0] += zero
                b[1] += one
    belief[0][0] += model.root[0]
    belief[0][1] += model.root[1]
    up = [(0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):
        (e00, e01), (e10, e11) = model.edge[place(tree, i)]
        zero, one = belief[i]
        up[i] = add_logs(e00 + zero, e01 + one), add_logs(e10 + zero, e11 + one)
        above = belief[tree.parent[i]]
        above[0] += up[i][0]
        above[1] += up[i][1]
    for i in range(1, n):
        (e00, e01), (e10, e11) = model.edge[place(tree, i)]
        above = belief[tree.parent[i]]
        zero, one = above[0] - up[i][0], above[1] - up[i][1]
        low = add_logs(zero + e00, one + e10)
        high = add_logs(zero + e01, one + e11)
        belief[i][0] += low
        belief[i][1] += high
    return [1 / (1 + math.exp(min(700.0, max(-700.0, zero - one)))) for zero, one in belief]


def main_text(page: str, model: Model) -> str:
    tree = parse(page)
    chances = marginals(tree, model)
    return "\n\n".join(t for t, chance in zip(tree.text, chances) if t is not None and chance > 0.5)


def seed_counts() -> Counter:
    counts: Counter = Counter()
    for page in SEEDS:
        tree = parse(page)
        tally(tree, seed_labels(tree), counts, SEED_WEIGHT)
    return counts


def train(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from the seeds and a bounded sample of ``pages (page_id, html)`` that mark their article."""
    chosen = (
        pages.where("page_id IS NOT NULL AND html IS NOT NULL").select("page_id").distinct()
        .orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    )
    # At most ``sample`` ids: a bounded broadcast.
    rows = pages.select("page_id", "html").where("html IS NOT NULL").join(F.broadcast(chosen), "page_id")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for frame in frames:
            for page in frame.html:
                tree = parse(page)
                labels = marked_labels(tree)
                if labels is not None:
                    tally(tree, labels, found)
        yield pd.DataFrame([(f, y, n) for (f, y), n in found.items()], columns=["feature", "label", "n"])

    counts = seed_counts()
    summed = rows.mapInPandas(count, "feature string, label int, n long").groupBy("feature", "label").agg(
        F.sum("n").alias("n"))
    for feature, label, n in summed.collect():  # names of elements and buckets: a few hundred
        counts[feature, label] += n
    return fit(counts)


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages (page_id, url, html)``."""
    model = pages.sparkSession.sparkContext.broadcast(train(pages, sample))

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, model.value) for page in batch], dtype=object)

    return pages.select("page_id", "url", text(F.coalesce("html", F.lit(""))).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))


_S = "The river was high that spring. Nobody crossed it for weeks, and the mill stood still."
_T = "A short remark."
_L = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Contact us</a></li></ul>'
SEEDS = [
    f'<nav>{_L}</nav><article y="1"><h1>Floods</h1><p>{_S} {_S}</p><p>{_S}</p><h2>After</h2><p>{_T}</p></article>'
    f'<footer><p>Copyright. All rights reserved.</p></footer>',
    f'<header><div class="logo">Daily</div><div class="menu">{_L}</div></header><div class="cookie-notice">We use '
    f'cookies. <a href="/p">More</a></div><main y="1"><h1>Floods</h1><p>{_S}</p><p>{_S}</p><blockquote>{_T}</blockquote>'
    f'<ul><li>{_T}</li><li>{_S}</li></ul></main><aside><h3>Related</h3>{_L}</aside><footer>Imprint. {_T}</footer>',
    f'<div id="top-nav">{_L}</div><div id="content"><div class="post-body" y="1"><h1>Floods</h1><p>{_S} {_S}</p><p>{_T}'
    f'</p><p>{_S}</p></div><div class="comments" y="0"><h3>Comments</h3><div><p>{_S}</p><p>{_T}</p></div><p>{_S}</p>'
    f'</div></div><div class="sidebar"><h3>Popular</h3>{_L}<p>{_T}</p></div>',
    f'<nav>{_L}</nav><article y="1"><h1>Floods</h1><p>{_S}</p><aside y="0"><p>{_T}</p><a href="/x">Read this too</a>'
    f'</aside><p>{_S} {_S}</p><form y="0"><p>Get our letter every week.</p><button>Join</button></form><p>{_T}</p>'
    f'<section class="comments" y="0"><h2>Readers</h2><p>{_S}</p><p>{_S}</p></section></article><footer>{_T}</footer>',
    f'<div class="banner">{_T}</div><div class="ad">Buy a boat now. {_T}</div><div class="story" y="1"><p>{_S}</p>'
    f'<div class="ad" y="0">{_T}</div><p>{_S}</p><pre>{_T}</pre><table><tr><td>{_T}</td><td>{_T}</td></tr></table></div>'
    f'<div class="newsletter"><p>{_T}</p></div><div class="share"><a href="/s">Share</a></div><div class="footer">{_T}'
    f'</div>',
    f'<header>{_L}</header><section y="1"><h1>Floods</h1><p>{_S}</p><div><p>{_S}</p></div><p>See <a href="/m">the map'
    f'</a> of the valley. {_S}</p><figure><figcaption>{_T}</figcaption></figure></section><div class="popup notice">'
    f'<p>{_S}</p></div><ol class="comments"><li><p>{_S}</p></li><li><p>{_T}</p></li></ol><footer><p>{_S}</p></footer>',
    f'<nav>{_L}</nav><article y="1"><h1>Floods</h1><p>{_S}</p><ul><li>{_T}</li><li>{_T}</li><li>{_S}</li></ul><p>{_S}</p>'
    f'<ol><li>{_S}</li><li>{_S}</li></ol></article><footer>{_L}</footer>',
    f'<div class="menu">{_L}</div><div class="text" y="1"><h2>Floods</h2><ul><li><p>{_S}</p></li><li><p>{_T}</p></li></ul>'
    f'<p>{_T}</p></div><div class="tags">{_L}</div><div class="legal">{_T}</div>',
    f'<div role="navigation">{_L}</div><div class="main-content" y="1"><h2>Floods</h2><p>{_S} {_S} {_S}</p><p>{_T}</p>'
    f'</div><div class="related"><p>{_T}</p>{_L}</div><form><label>Search</label></form><footer><div>{_T}</div></footer>',
]
