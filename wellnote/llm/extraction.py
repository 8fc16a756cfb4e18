"""Main text of web pages by a tree-structured graphical model of the DOM.

Every block element and every run of text in one is a node that is either content or not.  Nodes
have potentials from their features (tag, words of class, id and role, share of link text, length);
each parent-child edge has a 2 x 2 potential.  Sum-product messages, upward and then downward, give
exact marginals; a text run is content when its marginal is over one half.  The potentials are fitted by
maximum likelihood, whose gradients are these same marginals, on labelled pages: a bounded sample
of the given pages whose markup names the article, and variants of them in other common layouts.

Content is then joined in page order: character references decoded, white space inside a block
one space, blocks joined by one space.  Scripts, styles and other text that is never shown is no node.

Defined results: a null or empty page has an empty text; unclosed, stray and cut-off tags are read
as browsers do in the simple cases; every page is read whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellnote.llm.common import batches_of, bounded_sample, rows_of, text_id

#: Pages of the table and variants made of them that the model is fitted on.
FIT_PAGES, FIT_VARIANTS = 80, 240
EPOCHS, RATE = 12, 0.15

#: HTML elements.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
UNSEEN = frozenset("""script style head title noscript template svg iframe object canvas audio video select
textarea button datalist map""".split())
#: Of these, the ones that an unclosed block around them ends.
INSIDE_BLOCKS = frozenset("noscript iframe object canvas audio video select button datalist map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dt", "dd"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol menu dl table td th html".split())
_TOKEN = re.compile(r"[a-z]+")
_TAG = re.compile(r"</?[a-zA-Z]|<!|<\?")


class Tree(HTMLParser):
    """Nodes in page order: ``parent``, ``features``, ``mark``, and ``text`` (None for elements)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent: list[int] = []
        self.features: list[list[str]] = []
        self.text: list[str | None] = []
        self.mark: list[int | None] = []
        self.open: list[tuple[str, int]] = []
        self.hidden: list[str] = []
        self.links = 0
        self.run: list[str] = []
        self.run_linked = 0

    def _node(self, features: list[str], text: str | None, mark: int | None) -> int:
        self.parent.append(self.open[-1][1] if self.open else -1)
        self.features.append(features)
        self.text.append(text)
        self.mark.append(mark)
        return len(self.parent) - 1

    def _end_run(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            share = self.run_linked / len(text)
            size = min(4, int(math.log(len(text), 4)))
            self._node(["x", f"l{min(2, int(3 * share))}", f"n{size}"], text, None)
        self.run, self.run_linked = [], 0

    def _pop_to(self, at: int) -> None:
        self._end_run()
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.hidden:
            if tag not in VOID:
                self.hidden.append(tag)
            return
        if tag in UNSEEN:
            if tag == "head":  # a head ends where the body begins, closed or not
                return
            self.hidden.append(tag)
            return
        if tag == "br":
            self.run.append(" ")
        elif tag == "hr":
            self._end_run()
        elif tag == "a":
            self.links += 1
        elif tag in BLOCKS:
            self._end_run()
            if tag in CLOSES_P and any(t == "p" for t, _ in self.open):
                self._pop_to(max(i for i, (t, _) in enumerate(self.open) if t == "p"))
            if tag in CLOSED_BY:
                for i in range(len(self.open) - 1, -1, -1):
                    if self.open[i][0] in CLOSED_BY[tag]:
                        self._pop_to(i)
                        break
                    if self.open[i][0] in SCOPES:
                        break
            named, mark = [], None
            for key, value in attrs:
                if key in ("class", "id", "role") and value:
                    named += _TOKEN.findall(value.lower())
                elif key == "data-mark":
                    mark = int(value)
            features = ["e", "t:" + tag] + ["c:" + w for w in dict.fromkeys(named)]
            self.open.append((tag, self._node(features, None, mark)))
            self.links = 0

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
                return
            if self.hidden[0] not in INSIDE_BLOCKS or all(t != tag for t, _ in self.open):
                return
            self.hidden = []
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BLOCKS:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    self._pop_to(i)
                    break

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.run.append(data)
            if self.links:
                self.run_linked += len(data)

    def close(self) -> "Tree":
        super().close()
        self._end_run()
        return self

    def marks(self) -> list[int]:
        """Label of every node: the mark of the nearest marked node above or at it, else 0."""
        out: list[int] = []
        for p, m in zip(self.parent, self.mark):
            out.append(m if m is not None else out[p] if p >= 0 else 0)
        return out


def parse(html: str) -> Tree:
    cut_off = html.rfind("<")
    if cut_off > html.rfind(">") and _TAG.match(html, cut_off):
        html = html[:cut_off]  # the page ends inside a tag
    tree = Tree()
    tree.feed(html)
    return tree.close()


def _log_sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


class TreeModel:
    """Node weights (of being content) and edge potentials, by kind of child."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        #: edges[kind of child][label of parent][label of child]; kind 0: element, 1: text.
        self.edges = [[[0.5, 0.0], [0.0, 0.5]], [[0.5, 0.0], [0.0, 0.5]]]

    def marginals(self, tree: Tree, with_edges: bool = False) -> tuple[list[float], list]:
        """P(content) of every node; with_edges: also the joint of every node with its parent."""
        parent, weights, n = tree.parent, self.weights, len(tree.parent)
        kinds = [t is not None for t in tree.text]
        # Upward: up0/up1 gather a node's own potential and its children's messages.
        up0 = [0.0] * n
        up1 = [sum([weights.get(f, 0.0) for f in fs]) for fs in tree.features]
        to0, to1 = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            p = parent[i]
            if p >= 0:
                (e00, e01), (e10, e11) = self.edges[kinds[i]]
                a, b = up0[i], up1[i]
                to0[i] = _log_sum(a + e00, b + e01)
                to1[i] = _log_sum(a + e10, b + e11)
                up0[p] += to0[i]
                up1[p] += to1[i]
        # Downward: what the rest of the tree says about a node, through its parent.
        full0, full1 = up0[:], up1[:]
        joint = []
        for i in range(n):
            p = parent[i]
            if p >= 0:
                (e00, e01), (e10, e11) = self.edges[kinds[i]]
                r0, r1 = full0[p] - to0[i], full1[p] - to1[i]
                if with_edges:
                    cells = (r0 + e00 + up0[i], r0 + e01 + up1[i], r1 + e10 + up0[i], r1 + e11 + up1[i])
                    top = max(cells)
                    shares = [math.exp(c - top) for c in cells]
                    total = sum(shares)
                    joint.append((i, kinds[i], [s / total for s in shares]))
                full0[i] = up0[i] + _log_sum(r0 + e00, r1 + e10)
                full1[i] = up1[i] + _log_sum(r0 + e01, r1 + e11)
        out = [1 / (1 + math.exp(min(700.0, a - b))) for a, b in zip(full0, full1)]
        return out, joint

    def fit(self, trees: list[Tree], seed: int = 31) -> "TreeModel":
        """Stochastic gradient ascent on the likelihood of the marks."""
        rng = random.Random(seed)
        marked = [(t, t.marks()) for t in trees if t.parent]
        scale: dict[str, float] = {}
        for epoch in range(EPOCHS):
            rng.shuffle(marked)
            for tree, marks in marked:
                found, joint = self.marginals(tree, with_edges=True)
                slope: dict[str, float] = {}
                for i, fs in enumerate(tree.features):
                    gap = marks[i] - found[i]
                    for f in fs:
                        slope[f] = slope.get(f, 0.0) + gap
                for f, g in slope.items():
                    g -= 0.002 * self.weights.get(f, 0.0)
                    scale[f] = scale.get(f, 0.0) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + RATE * 4 * g / (1 + math.sqrt(scale[f]))
                turn = [[[0.0, 0.0], [0.0, 0.0]], [[0.0, 0.0], [0.0, 0.0]]]
                for i, kind, shares in joint:
                    turn[kind][marks[tree.parent[i]]][marks[i]] += 1
                    for cell, share in enumerate(shares):
                        turn[kind][cell >> 1][cell & 1] -= share
                for kind in (0, 1):
                    for a in (0, 1):
                        for b in (0, 1):
                            self.edges[kind][a][b] += RATE * turn[kind][a][b] / len(joint or [1])
        return self

    def extract(self, html: str | None) -> str:
        tree = parse(html or "")
        found, _ = self.marginals(tree)
        return " ".join(t for t, p in zip(tree.text, found) if t is not None and p > 0.5)


#: Usual names of the parts of a page, for the layouts of the labelled variants.
CONTENT_NAMES = ("content", "post", "entry", "story", "article", "main", "body text", "post content",
                 "entry content", "article body", "page text", "blog post", "markdown", "news text")
ASIDE_NAMES = {
    "nav": ("nav", "menu", "breadcrumb", "navbar", "pagination", "toc links"),
    "header": ("header", "masthead", "top bar", "site header", "banner"),
    "footer": ("footer", "site footer", "copyright", "bottom legal"),
    "aside": ("sidebar", "widget", "related", "recommended", "trending popular", "author bio", "tags"),
    "div": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored promo", "cookie notice", "cookie consent",
            "gdpr banner", "newsletter subscribe", "share social", "popup modal", "notice alert", "promo"),
    "section": ("comments", "comment list", "respond", "discussion", "replies", "reader comments", "disqus thread"),
    "form": ("login form", "search form", "signup", "subscribe form", "contact"),
}


def _mark_known(tree: Tree) -> Tree:
    """Marks from the markup itself: an article is content, navigation and the like inside it is not."""
    for i, fs in enumerate(tree.features):
        tag = fs[1] if len(fs) > 1 else ""
        if tag in ("t:article", "t:main"):
            tree.mark[i] = 1
        elif tag in ("t:nav", "t:aside", "t:form", "t:footer"):
            tree.mark[i] = 0
    return tree


def variant(paragraphs: list[str], rng: random.Random) -> str:
    """A page in some common layout around the paragraphs, its parts marked."""
    def escape(text: str) -> str:
        return text.replace("&", "&amp;").replace("<", "&lt;")

    def some() -> str:
        return escape(rng.choice(paragraphs))

    def short() -> str:
        return escape(" ".join(rng.choice(paragraphs).split()[: rng.randint(1, 6)]))

    def aside(kind: str) -> str:
        name = rng.choice(ASIDE_NAMES[kind])
        tag = rng.choice((kind, kind, "div", "section")) if kind != "form" else "form"
        # Half of the real sections carry no name at all.
        attr = f' {rng.choice(("class", "id"))}="{name.replace(" ", rng.choice((" ", "-", "_")))}"' \
            if tag in ("div", "section") or rng.random() < 0.5 else ""
        if kind in ("nav", "footer", "aside") and rng.random() < 0.7:
            inner = "<ul>" + "".join(f'<li><a href="#">{short()}</a></li>' for _ in range(rng.randint(2, 7))) + "</ul>"
        elif kind == "section":
            unit = rng.choice(("div", "li", "article", "p"))
            inner = f"<h3>{short()}</h3>" + "".join(
                f'<{unit} class="comment"><p>{some()}</p></{unit}>' for _ in range(rng.randint(1, 4)))
        elif kind == "form":
            inner = f"<label>{short()}</label><input name=q><button>{short()}</button><p>{short()}</p>"
        else:
            inner = rng.choice((some(), f"<p>{some()}</p>", f"<span>{short()}</span>", f"<h1>{short()}</h1>",
                                f"<h2>{short()}</h2><p>{short()}</p>", f"<div><p>{some()}</p></div>"))
        if rng.random() < 0.25 and kind != "header":
            inner = f"<h3>{short()}</h3>{inner}"
        return f'<{tag}{attr} data-mark="0">{inner}</{tag}>'

    def piece() -> str:
        kind = rng.random()
        if kind < 0.62:
            return f"<p>{some()}</p>" if rng.random() < 0.9 else f"<p><b>{some()}<br>"
        if kind < 0.72:
            return f"<p>{short()}</p>"
        if kind < 0.8:
            return f"<h2>{short()}</h2>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{rng.choice((some, short))()}</li>" for _ in range(3)) + "</ul>"
        if kind < 0.9:
            return f"<blockquote><p>{some()}</p></blockquote>"
        if kind < 0.93:
            return f"<table><tr><th>{short()}</th><td>{short()}</td></tr></table>"
        if kind < 0.96:
            return f"<figure><img src=x><figcaption>{short()}</figcaption></figure>"
        return f'<div>{some()} <a href="#">{short()}</a> {short()}</div>'

    inner = [piece() for _ in range(rng.randint(1, 9))]
    for _ in range(rng.randint(0, 2)):
        inner.insert(rng.randint(0, len(inner)), aside(rng.choice(("div", "aside", "form", "section"))))
    if rng.random() < 0.8:
        inner.insert(0, f"<h1>{short()}</h1>")
    kind = rng.random()
    name = rng.choice(CONTENT_NAMES).replace(" ", rng.choice((" ", "-", "_")))
    if kind < 0.36:
        body = f'<article data-mark="1">{"".join(inner)}</article>'
    elif kind < 0.5:
        body = f'<main data-mark="1">{"".join(inner)}</main>'
    elif kind < 0.66:
        # Pages of plain blocks, whose parts have no names.
        body = "".join(inner) if kind < 0.55 else f'<div data-mark="1">{"".join(inner)}</div>'
    else:
        body = f'<div class="{name}" data-mark="1">{"".join(inner)}</div>'
    if kind >= 0.66 and rng.random() < 0.4 or rng.random() < 0.3:
        body = f'<div class="{rng.choice(("container", "wrapper", "page", "row", "col"))}">{body}</div>'
    before = [aside(k) for k in ("header", "nav", "div", "aside", "form") if rng.random() < 0.5]
    after = [aside(k) for k in ("section", "aside", "div", "form", "footer") if rng.random() < 0.55]
    mark = ' data-mark="1"' if 0.5 <= kind < 0.55 else ""
    return f"<html><body{mark}>{''.join(before)}{body}{''.join(after)}</body></html>"


def train(pages: DataFrame) -> TreeModel:
    """A model fitted on a bounded sample of the pages and on variants made of their paragraphs."""
    texts = pages.filter("html is not null").select(F.col("html").alias("text"))
    sample = [h for h, _ in bounded_sample(
        texts, texts.select(text_id().alias("tid"), F.lit("page").alias("label")), FIT_PAGES)]
    trees = [_mark_known(parse(h)) for h in sample]
    known = [t for t in trees if any(t.mark)]
    paragraphs = [x for t in trees for x in t.text if x] or ["text", "some words of text.", "more"]
    rng = random.Random(32)
    return TreeModel().fit(known + [parse(variant(paragraphs, rng)) for _ in range(FIT_VARIANTS)])


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.large_string()),
                    ("n_chars", pa.int64())])


def main_texts(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    model = model or train(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for page_id, url, html in rows_of(batches):
                text = model.extract(html)
                yield page_id, url, text, len(text)

        yield from batches_of(found(), _TEXTS)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html") \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
