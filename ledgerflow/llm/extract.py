"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded on the tree.

Every block element of a page is described by its subtree's density, its
attribute words, depth and siblings (``dom.FEATURES``).  Boosted trees give
the probability that an element holds main text; the decoder then takes the
likeliest set of kept elements in which nothing is kept inside a dropped
element, by dynamic programming over the tree.  The text of kept elements, in
page order, is the result.

The given pages carry no labels.  The trees are fitted on ``TRAIN_PAGES``
labelled pages that ``layout`` draws from varied page layouts (a fixed seed, a
documented bound); the model is a few kilobytes and is sent to the executors.

Defined results: null html is empty and gives the empty text; a page without
any element is its own text; very deep or unclosed markup is read as far as it
goes; repeated rows give repeated results; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .dom import FEATURES, Page

#: Bound on the generated pages that the trees are fitted on.
TRAIN_PAGES = 900
TREES, DEPTH, BINS, RATE = 60, 5, 32, 0.2


# -- gradient-boosted trees -----------------------------------------------------

class Trees:
    """Complete binary trees of one depth, as arrays (tree, place)."""

    def __init__(self, bias: float):
        self.bias = bias
        self.feature, self.cut, self.value = [], [], []

    def margin(self, x: np.ndarray) -> np.ndarray:
        feature, cut, value = np.array(self.feature), np.array(self.cut, dtype=np.float32), np.array(self.value)
        out = np.full(len(x), self.bias)
        tree = np.arange(len(feature))
        for at in range(0, len(x), 4096):
            rows = np.arange(min(4096, len(x) - at))[:, None]
            place = np.zeros((len(rows), len(tree)), dtype=np.int64)
            for _ in range(DEPTH):
                place = 2 * place + 1 + (x[at:at + 4096][rows, feature[tree, place]] > cut[tree, place])
            out[at:at + 4096] += value[tree, place - (2 ** DEPTH - 1)].sum(axis=1)
        return out


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Logistic boosting with quantile bins and second-order leaf values."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Trees(float(np.log(share / (1 - share))))
    margin = np.full(len(y), model.bias)
    n_features = x.shape[1]
    flat = binned + np.arange(n_features) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        place = np.zeros(len(y), dtype=np.int64)
        feature, cut = np.zeros(2 ** DEPTH - 1, dtype=np.int64), np.full(2 ** DEPTH - 1, np.inf)
        for depth in range(DEPTH):
            width, first = 2 ** depth, 2 ** depth - 1
            keys = ((place - first)[:, None] * (n_features * BINS) + flat).ravel()
            gs, hs = (np.bincount(keys, weights=np.repeat(v, n_features), minlength=width * n_features * BINS)
                      .reshape(width, n_features, BINS).cumsum(axis=2) for v in (g, h))
            all_g, all_h = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs ** 2 / (hs + 1) + (all_g - gs) ** 2 / (all_h - hs + 1) - all_g ** 2 / (all_h + 1)
            gain[(hs < 2) | (all_h - hs < 2)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for node in range(width):
                f, b = divmod(int(best[node]), BINS)
                if gain[node, f, b] > 1e-3 and b < len(edges[f]):
                    feature[first + node], cut[first + node] = f, edges[f][b]
            place = 2 * place + 1 + (x[np.arange(len(y)), feature[place]] > cut[place])
        leaf = place - (2 ** DEPTH - 1)
        value = RATE * np.bincount(leaf, g, 2 ** DEPTH) / (np.bincount(leaf, h, 2 ** DEPTH) + 1)
        margin += value[leaf]
        model.feature.append(feature)
        model.cut.append(cut)
        model.value.append(value)
    return model


# -- labelled layouts -------------------------------------------------------------

class _Layout:
    """One page; ``truth`` are the words of its main text in order."""

    def __init__(self, rng: random.Random):
        self.rng, self.out, self.truth = rng, [], []
        self.anonymous = 0.07       # share of boilerplate without a telling name

    def words(self, low: int, high: int, main: bool, full: bool = True) -> str:
        r = self.rng
        found = ["".join(r.choices("etaoinshrdluäéñ", k=r.randint(1, 11))) for _ in range(r.randint(low, high))]
        if full:
            for i in range(len(found)):
                if r.random() < 0.12:
                    found[i] += r.choice([",", ".", ".", "!", "?"])
            found[-1] += "."
        if main:
            self.truth += found
        return " ".join(found)

    def add(self, *parts: str) -> None:
        self.out += parts

    def named(self, *names: str) -> str:
        r = self.rng
        name = r.choice(names)
        name = r.choice([name, name, f"{name}-{r.choice(['box', 'wrap', 'inner', 'area', '1'])}", f"{r.choice(['site', 'l', 'js', 'c'])}-{name}"])
        return f' {r.choice(["class", "class", "id"])}="{name}"' if r.random() >= self.anonymous else ""

    def links(self, n: int) -> str:
        r = self.rng
        each = [f'<a href="/{i}">{self.words(1, 3, False, False)}</a>' for i in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>" if r.random() < 0.7 else r.choice([" | ", " ", ""]).join(each)

    def boilerplate(self, kind: str) -> None:
        r = self.rng
        w = lambda a, b: self.words(a, b, False, r.random() < 0.7)
        tag = lambda real, *names: r.choice([f"{real}", f"{real}{self.named(*names)}", f"div{self.named(*names)}"])
        if kind == "nav":
            head, inner = tag("nav", "nav", "menu", "navbar", "breadcrumb"), self.links(r.randint(2, 9))
        elif kind == "header":
            head, inner = tag("header", "header", "masthead", "topbar", "banner"), f"<{(t := r.choice(['h1', 'h2', 'div', 'p', 'a']))}>{w(1, 6)}</{t}>" + (self.links(4) if r.random() < 0.4 else "")
        elif kind == "footer":
            head, inner = tag("footer", "footer", "bottom", "copyright"), r.choice(["&copy; ", "© ", ""]) + w(1, 14) + (self.links(4) if r.random() < 0.4 else "")
        elif kind == "aside":
            head = tag("aside", "sidebar", "widget", "related", "recommended", "trending")
            inner = f"<h3>{w(1, 4)}</h3>" + (self.links(r.randint(2, 8)) if r.random() < 0.6 else "".join(f"<p>{w(4, 40)}</p>" for _ in range(r.randint(1, 3))))
        elif kind == "ad":
            head = f"div{self.named('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo')}"
            inner = r.choice([w(2, 30), f"<p>{w(2, 40)}</p>", f'<a href="/x">{w(1, 8)}</a>'])
        elif kind == "notice":
            head = r.choice([f"div{self.named('cookie', 'consent', 'notice', 'gdpr', 'popup', 'alert')}", f"section{self.named('cookie', 'notice', 'privacy')}"])
            inner = f"<p>{w(4, 40)}</p><button>{w(1, 2)}</button>"
        elif kind == "comments":
            head, item = tag("section", "comments", "comment-list", "discussion", "responses"), r.choice(["div", "li", "article"])
            inner = f"<h2>{w(1, 3)}</h2>" + "".join(f'<{item}{r.choice([self.named("comment", "reply"), ""])}><p>{w(3, 60)}</p></{item}>' for _ in range(r.randint(1, 5)))
        elif kind == "form":
            head = r.choice([f"form{self.named('search', 'login', 'newsletter', 'subscribe')}", "form", f"div{self.named('newsletter', 'subscribe', 'signup')}"])
            inner = f"<label>{w(1, 5)}</label><input name=q><p>{w(2, 15)}</p><button>{w(1, 2)}</button>"
        else:
            head, inner = tag("div", "share", "social", "follow"), self.links(r.randint(2, 5))
        self.add(f"<{head} data-m=0>{inner}</{head.split()[0]}>")

    def block(self) -> None:
        r = self.rng
        kind = r.choices(["p", "h2", "list", "quote", "pre", "table", "figure", "div"], [60, 8, 7, 5, 3, 4, 3, 10])[0]
        if kind == "p":
            text = self.words(1, r.choice([4, 20, 120]), True)
            if r.random() < 0.2 and " " in text:
                a, b = text.split(" ", 1)
                text = r.choice([f"<b>{a}</b> {b}", f'<a href="/y">{a}</a> {b}', f"<em>{a}</em> {b}", f"{a}<br>{b}"])
            self.add(r.choice([f"<p>{text}</p>"] * 4 + [f"<p>{text}\n", f"<p><b>{text}<br>", f'<p class="{r.choice(["lead", "text", "x1"])}">{text}</p>']))
        elif kind == "h2":
            self.add(f"<h2>{self.words(1, 8, True, False)}</h2>")
        elif kind == "list":
            t = r.choice(["ul", "ol"])
            self.add(f"<{t}>" + "".join(f"<li>{self.words(1, 20, True)}</li>" for _ in range(r.randint(1, 6))) + f"</{t}>")
        elif kind == "table":
            self.add("<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 4, True, False)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
        elif kind == "figure":
            self.add(f'<figure><img src="/i.png"><figcaption>{self.words(2, 14, True)}</figcaption></figure>')
        else:
            t = {"quote": "blockquote", "pre": "pre", "div": "div"}[kind]
            self.add(f"<{t}>{self.words(3, 60, True)}</{t}>")

    def page(self) -> str:
        r = self.rng
        before = [k for k, p in (("nav", 0.7), ("header", 0.45), ("notice", 0.3), ("ad", 0.4), ("form", 0.15), ("share", 0.15)) if r.random() < p]
        after = [k for k, p in (("comments", 0.35), ("aside", 0.45), ("share", 0.2), ("form", 0.2), ("ad", 0.2), ("nav", 0.15)) if r.random() < p]
        r.shuffle(before)
        r.shuffle(after)
        self.add(r.choice(["<!DOCTYPE html>", ""]), "<html><head><title>", self.words(1, 6, False), "</title><style>p{margin:0}</style></head><body>")
        wrap = r.choice(["", "", "<div>", '<div class="wrap">', '<div id="page" class="container">', '<div class="site">'])
        self.add(wrap)
        for kind in before:
            self.boilerplate(kind)
        shell = r.choice([("<main>", "</main>"), ("", ""), ("", ""), ('<div class="row">', "</div>"), ('<div id="content">', "</div>"), ('<div role="main">', "</div>")])
        core = r.choice([("<article>", "</article>")] * 4 + [('<article class="post">', "</article>"), ('<div class="article-body">', "</div>"), ('<div class="entry-content">', "</div>"),
                                                             ('<section class="story">', "</section>"), ('<div class="post">', "</div>"), ("<div>", "</div>"), ('<div class="c3">', "</div>")])
        if not shell[0] and r.random() < 0.1:
            core = ("", "")
        self.add(shell[0])
        if shell[0] and r.random() < 0.2:
            self.boilerplate("aside")
        self.add(core[0].replace(">", " data-m=1>") if core[0] else "")
        plain = not core[0]
        self.anonymous = 0.0        # within an article nothing else tells it
        if r.random() < 0.8 and not plain:
            title = f"<h1>{self.words(1, 12, True, False)}</h1>"
            self.add(f"<header>{title}</header>" if r.random() < 0.12 else title)
        for _ in range(r.choice([1, 1, 2, 4, 8, 14])):
            if plain:
                self.add(f"<p data-m=1>{self.words(8, 90, True)}</p>")
                continue
            self.block()
            if r.random() < 0.04:
                self.boilerplate(r.choice(["ad", "share", "form", "aside", "ad"]))
        if not plain and r.random() < 0.1:
            self.boilerplate(r.choice(["share", "comments", "aside"]))
        self.add(core[1])
        self.anonymous = 0.07
        if shell[0] and r.random() < 0.25:
            self.boilerplate("aside")
        self.add(shell[1])
        for kind in after:
            self.boilerplate(kind)
        if r.random() < 0.85:
            self.boilerplate("footer")
        self.add("</div>" if wrap else "", r.choice(["</body></html>", ""]))
        return "".join(self.out)


def layout(seed: int) -> tuple[str, str]:
    """(html, main text) of one generated page; elements carry data-m marks,
    which no feature sees."""
    page = _Layout(random.Random(seed))
    source = page.page()
    return source, " ".join(page.truth)


def _labelled(seed: int) -> tuple[np.ndarray, np.ndarray]:
    page = Page(layout(seed)[0])
    mark = [None] * len(page.tag)
    for i, a in enumerate(page.attrs):
        own = "1" if "data-m=1" in a else "0" if "data-m=0" in a else None
        mark[i] = own or (mark[page.parent[i]] if i else None)
    held, main = np.zeros(len(mark)), np.zeros(len(mark))
    for i, text in page.items:
        if text and text.strip():
            held[i] += len(text)
            main[i] += len(text) * (mark[i] == "1")
    for i in range(len(mark) - 1, 0, -1):
        held[page.parent[i]] += held[i]
        main[page.parent[i]] += main[i]
    nodes = page.nodes()
    nodes = nodes[held[nodes] > 0]
    return page.features(nodes), (main[nodes] > 0).astype(float)


@lru_cache(maxsize=2)
def train(pages: int = TRAIN_PAGES) -> Trees:
    """The trees, fitted once in this process."""
    parts = [_labelled(seed) for seed in range(pages)]
    return fit(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]))


# -- decoding ---------------------------------------------------------------------

def decode(page: Page, nodes: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Kept elements: the likeliest choice in which a dropped element has no
    kept descendant.  Elements that are not classified follow their parent."""
    n = len(page.tag)
    yes, no = np.zeros(n), np.zeros(n)
    yes[nodes], no[nodes] = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
    keep, drop = yes.copy(), no.copy()
    classified = np.zeros(n, dtype=bool)
    classified[nodes] = True
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        keep[p] += max(keep[i], drop[i]) if classified[i] else keep[i]
        drop[p] += drop[i]
    kept = np.zeros(n, dtype=bool)
    kept[0] = True
    hidden = page.hidden()
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and not hidden[i] and (not classified[i] or keep[i] >= drop[i])
    return kept


def main_texts(sources: list[str | None], model: Trees) -> list[str]:
    """The main text of each page."""
    out = []
    for at in range(0, len(sources), 64):
        pages = [Page(s or "") for s in sources[at:at + 64]]
        nodes = [p.nodes() for p in pages]
        margins = np.split(model.margin(np.concatenate([p.features(k) for p, k in zip(pages, nodes)])), np.cumsum([len(k) for k in nodes])[:-1])
        out += [p.text(decode(p, k, m)) for p, k, m in zip(pages, nodes, margins)]
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    sent = pages.sparkSession.sparkContext.broadcast(train())
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = main_texts(batch.column("html").to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=[id_col, url_col, "text", "n_chars"])

    return (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
            .mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long"))
