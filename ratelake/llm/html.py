"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded as a hierarchy.

Every block element is a node with features: tag, words of its attributes, those of its
ancestors, text density of its subtree, links, depth and siblings. Boosted trees give
each node the odds that it belongs to the article. Decoding chooses for every subtree
between keeping it, dropping it and deciding for its children, so no node is kept under
a dropped one; text is what the kept blocks hold, in page order.

The trees are trained here on at most ``TRAIN_PAGES`` pages of up to ``TRAIN_BYTES`` bytes:
as they are, with weak labels from their elements, and laid out anew, with their texts as
articles, menus, notices, adverts, forms, sidebars and comments in common mark-up, tables
that only lay out among it, where labels are known. If all pages are longer, a rule on the
elements' names takes the trees' place.

Null and empty html gives an empty text. Repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ratelake.llm.common import pieces
from ratelake.llm.dom import N_FEATURES, Page

TRAIN_PAGES = 150
TRAIN_BYTES = 200_000  # longer pages are not trained on
LAYOUTS = 4  # new layouts per training page
CELLS = 0.15  # share of them in the cells of a table
TREES, DEPTH, BINS, RATE, MIN_HESSIAN, LIMIT = 60, 4, 32, 0.25, 2.0, 6.0
LONG, NEAR = 25, -1.5  # spaces of a long block; odds that are near even
SPLIT_COST = 3.0  # what deciding for the children costs
TREES_AT_ONCE = 64  # pages held by a task


class Trees:
    """Histogram gradient boosting for log loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._bin(x)
        self.base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        total = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            tree = self._grow(binned, p - y, np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            total += self._follow(binned, tree)

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1).astype(np.uint8)

    @staticmethod
    def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray):
        inner = (1 << DEPTH) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, 255)
        node = np.zeros(len(b), np.int64)
        for level in range(DEPTH):
            width = 1 << level
            local = node - (width - 1)
            best = np.full(width, 1e-9)
            for j in range(b.shape[1]):
                at = local * (BINS + 1) + b[:, j]
                sg = np.bincount(at, g, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                sh = np.bincount(at, h, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                ag, ah = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + 1) + (ag - sg) ** 2 / (ah - sh + 1) - ag**2 / (ah + 1)
                gain[(sh < MIN_HESSIAN) | (ah - sh < MIN_HESSIAN)] = 0
                k = gain.argmax(1)
                value = gain[np.arange(width), k]
                better = value > best
                best[better] = value[better]
                feature[width - 1 + np.flatnonzero(better)] = j
                cut[width - 1 + np.flatnonzero(better)] = k[better]
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        return feature, cut, value

    @staticmethod
    def _follow(b: np.ndarray, tree) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(b), np.int64)
        row = np.arange(len(b))
        for _ in range(DEPTH):
            node = 2 * node + 1 + (b[row, feature[node]] > cut[node])
        return value[node - len(feature)]

    def odds(self, x: np.ndarray) -> np.ndarray:
        b = self._bin(x)
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += self._follow(b, tree)
        return np.clip(total, -LIMIT, LIMIT)


def kept_blocks(page: Page, odds: np.ndarray) -> list[bool]:
    """Best consistent choice: for each block of text whether it is kept.

    Keeping a subtree whole is worth the odds of all its text, dropping it the opposite;
    deciding for its parts is worth the best of each, less a cost where there are several.
    """
    n = len(page.nodes)
    up = [node.parent.number if node.parent is not None else 0 for node in page.nodes]
    own = np.zeros(n)
    for number, text in page.blocks:
        own[number] += 1 + np.log1p(len(text))
    whole = own * odds
    apart = np.abs(whole)
    held = (own > 0).astype(np.int64)  # parts with text: a wrapper of one part is no decision
    cost = np.zeros(n)
    for k in range(n - 1, -1, -1):
        cost[k] = SPLIT_COST if held[k] > 1 else 0.0
        if k:
            whole[up[k]] += whole[k]
            apart[up[k]] += max(abs(whole[k]), apart[k] - cost[k])
            held[up[k]] += held[k] > 0
    state = np.zeros(n, np.int8)  # 1 kept whole, -1 dropped whole, 0 decided below
    for k in range(n):
        if k and state[up[k]]:
            state[k] = state[up[k]]
        elif abs(whole[k]) >= apart[k] - cost[k]:
            state[k] = 1 if whole[k] > 0 else -1
    kept = (state > 0) | ((state == 0) & (odds > 0))
    return [bool(kept[number]) for number, _ in page.blocks]


def main_text(page: Page, odds: np.ndarray) -> str:
    """Kept blocks, one per line. Of a page that would lose all its text, though the odds of
    a long block are near even, what is about as likely as the best of these stays."""
    keep = kept_blocks(page, odds)
    if not any(keep):
        best = max((odds[number] for number, text in page.blocks if text.count(" ") >= LONG), default=-LIMIT)
        if best > NEAR:
            keep = kept_blocks(page, odds - best + 1)
    return "\n".join(t for (_, t), kept in zip(page.blocks, keep) if kept)


_OUT_TAGS = {"nav", "header", "footer", "aside", "form"}
_OUT_GROUPS = {1, 2, 3, 4, 5, 6, 7, 8}  # attribute groups other than main and share


def weak_labels(page: Page) -> np.ndarray:
    """1 inside article or main, 0 outside or in anything that names itself otherwise."""
    y = np.zeros(len(page.nodes))
    for k, node in enumerate(page.nodes):
        up = y[node.parent.number] if node.parent is not None else 0
        if node.tag in ("article", "main"):
            up = 1
        if node.tag in _OUT_TAGS or (node.groups & _OUT_GROUPS and 0 not in node.groups):
            up = 0
        y[k] = up
    return y


# Mark-up of parts of a page: (opening tags, their class words).
_MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "post-body"), ("div", "entry-content"), ("section", "story"),
         ("div", "article-text"), ("article", "post"), ("div", ""), ("main", "main-content")]
_REST = {
    "menu": [("nav", ""), ("div", "menu"), ("ul", "navbar"), ("div", "breadcrumbs"), ("nav", "main-nav"), ("div", "pagination")],
    "head": [("header", ""), ("div", "masthead"), ("div", "site-header"), ("div", "top-banner")],
    "foot": [("footer", ""), ("div", "footer"), ("div", "site-footer legal"), ("div", "copyright")],
    "side": [("aside", ""), ("div", "sidebar"), ("div", "related"), ("section", "widget popular"), ("aside", "rail")],
    "note": [("div", "cookie-notice"), ("div", "notice"), ("div", "alert"), ("section", "consent popup"), ("dialog", "modal")],
    "advert": [("div", "ad"), ("div", "advert"), ("aside", "sponsored"), ("div", "ads promo"), ("section", "promotion")],
    "form": [("form", ""), ("form", "newsletter"), ("div", "search-form"), ("div", "subscribe"), ("form", "login")],
    "talk": [("section", "comments"), ("div", "comment-list"), ("ol", "comments"), ("div", "discussion"), ("div", "replies")],
    "share": [("div", "share"), ("div", "social-links"), ("ul", "share-tools")],
}
_INSIDE = ["advert", "talk", "share", "side", "note", "form"]  # parts also met inside an article


def _part(rng, kind: str, texts: list[str]) -> str:
    tag, words = _REST[kind][rng.integers(len(_REST[kind]))]
    some = [texts[i] for i in rng.integers(0, len(texts), rng.integers(1, 7))]
    name = rng.choice(["class", "id"])
    open_tag = f'<{tag} data-out="1"' + (f' {name}="{words}">' if words else ">")
    if kind in ("menu", "share"):
        item = "".join(f'<li><a href="#">{" ".join(t.split()[:3])}</a></li>' for t in some)
        return f"{open_tag}{item if tag in ('ul', 'ol') else '<ul>' + item + '</ul>'}</{tag}>"
    if kind in ("advert", "note", "foot", "head", "form") and rng.random() < 0.6:
        return f"{open_tag}{' '.join(some[0].split()[:25])}</{tag}>"
    inner = "li" if tag in ("ul", "ol") else "p" if rng.random() < 0.6 else "div"
    return f"{open_tag}{''.join(f'<{inner}>{t}</{inner}>' for t in some)}</{tag}>"


def lay_out(rng, texts: list[str]) -> str:
    """A page whose boilerplate elements are marked with an attribute ``data-out``."""
    tag, words = _MAIN[rng.integers(len(_MAIN))]
    body = []
    for k in range(rng.integers(1, 12)):
        t = texts[rng.integers(len(texts))]
        kind = rng.choice(["p", "p", "p", "p", "div", "h2", "ul", "blockquote"])
        body.append(f"<ul><li>{t}</li><li>{t}</li></ul>" if kind == "ul" else f"<{kind}>{t}</{kind}>")
        if rng.random() < 0.12:
            body.append(_part(rng, _INSIDE[rng.integers(len(_INSIDE))], texts))
    if rng.random() < 0.3:
        body.append(_part(rng, "talk", texts))
    head = f"<h1>{texts[rng.integers(len(texts))][:80]}</h1>"
    main = f'<{tag} data-in="1"' + (f' class="{words}">' if words else ">") + head + "".join(body) + f"</{tag}>"
    kinds = [k for k in _REST if rng.random() < 0.6]
    before = [_part(rng, k, texts) for k in kinds if k in ("menu", "head", "note", "advert", "form") ]
    after = [_part(rng, k, texts) for k in kinds if k in ("foot", "side", "talk", "advert", "share", "note", "form")]
    if rng.random() < CELLS:
        return f"<html><body>{''.join(before[1:])}{_cells(rng, ''.join(before[:1]), main, after[:1])}{''.join(after[1:])}</body></html>"
    if rng.random() < 0.5:
        main = f'<div class="{rng.choice(["wrapper", "container", "page", "row"])}">{main}{"".join(after[:1])}</div>'
    return f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def _cells(rng, before: str, main: str, after: list[str]) -> str:
    """The page's columns as cells of a table that only lays out; the article's cell may be
    all the mark-up it has."""
    if rng.random() < 0.7:
        main = re.sub(r"^<\w+ data-in=\"1\"[^>]*>|</\w+>$", "", main)
    cells = [f'<td data-out="1">{before}</td>'] if before else []
    cells.append(f'<td data-in="1">{main}</td>')
    cells += [f'<td data-out="1">{a}</td>' for a in after]
    return f"<table><tr>{''.join(cells)}</tr></table>"


def train(htmls: list[str]) -> Trees | None:
    """Boosted trees from a bounded list of pages."""
    from html import escape

    import ratelake.llm.dom as dom

    rng = np.random.default_rng(5)
    xs, ys = [], []

    def add(page: Page, y: np.ndarray) -> None:
        """Nodes that hold both kinds of text teach nothing."""
        holds = y.copy()
        for k in range(len(y) - 1, 0, -1):
            up = page.nodes[k].parent.number
            holds[up] = max(holds[up], holds[k])
        clear = holds == y
        xs.append(page.features()[clear])
        ys.append(y[clear])

    for html in htmls:
        page = Page(html)
        add(page, weak_labels(page))
        texts = [escape(t) for _, t in page.blocks]
        for _ in range(LAYOUTS if texts else 0):
            marked = lay_out(rng, texts)
            laid = Page(marked)
            add(laid, _known_labels(dom, marked, laid))
    if not xs:
        return None
    x, y = np.concatenate(xs), np.concatenate(ys)
    return Trees(x, y) if 0 < y.mean() < 1 else None


def _known_labels(dom, html: str, page: Page) -> np.ndarray:
    """Labels from the marks: parsed a second time with the attributes kept."""
    marks: list[str] = []

    class Keeper(dom._Parser):
        def handle_starttag(self, tag, attrs):
            super().handle_starttag(tag, attrs)
            if tag in dom.BLOCK:
                names = {n for n, _ in attrs}
                marks.append("in" if "data-in" in names else "out" if "data-out" in names else "")

    keeper = Keeper()
    keeper.feed(html)
    y = np.zeros(len(page.nodes))
    # Block nodes are numbered in the order of their opening tags, after the root.
    for k, node in enumerate(page.nodes):
        up = y[node.parent.number] if node.parent is not None else 0
        mark = marks[k - 1] if k else ""
        y[k] = 1 if mark == "in" else 0 if mark == "out" else up
    return y


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` (without ``html``) with text and n_chars."""
    some = pages.select(html, F.xxhash64(html).alias("h")).filter(F.octet_length(html).between(1, TRAIN_BYTES))
    # Hashes first, so that no more pages travel than are trained on; equal pages count once.
    last = some.select("h").distinct().orderBy("h").limit(TRAIN_PAGES).agg(F.max("h")).first()[0]
    sample = some.filter(F.col("h") <= F.lit(last)).groupBy("h").agg(F.first(html).alias(html)).orderBy("h").limit(TRAIN_PAGES).select(html)
    model = train([r[0] for r in sample.collect()])  # TRAIN_PAGES pages of bounded length
    shared = pages.sparkSession.sparkContext.broadcast(model)
    base = pages.drop("text", "n_chars")
    rest = [c for c in base.columns if c != html]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for whole in pieces(batches, html):
            for low in range(0, whole.num_rows, TREES_AT_ONCE):
                batch = whole.slice(low, TREES_AT_ONCE)
                parsed = [Page(h or "") for h in batch.column(html).to_pylist()]
                cuts = np.cumsum([0, *[len(p.nodes) for p in parsed]])
                x = np.concatenate([p.features() for p in parsed]) if parsed else np.zeros((0, N_FEATURES))
                odds = trees.odds(x) if trees is not None else np.concatenate([weak_labels(p) * 2 - 1 for p in parsed])
                texts = [main_text(p, odds[a:b]) for p, a, b in zip(parsed, cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in rest], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*rest, "text", "n_chars"],
                )

    schema = StructType([*[base.schema[c] for c in rest], StructField("text", StringType()), StructField("n_chars", LongType())])
    return base.mapInArrow(run, schema)
