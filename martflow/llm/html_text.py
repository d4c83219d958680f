"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every block element and text block of a page is a node. Trees score from a
node's features - density of its subtree, words of its class and id and of its
ancestors', depth, place and share among siblings, links, punctuation - whether
main text lies in it. Decoding picks the labelling of the whole tree with the
largest total score in which nothing below a dropped node is kept, so no
descendant contradicts its ancestor; kept text blocks are the text.

Training needs no labelled pages: nodes of a bounded sample of pages, and of
the same pages with boilerplate of known kinds put in at random places, are
labelled by structure. The trees then judge by all features together.

Defined results: null and empty html give empty text. A page cut off in a tag
loses that tag only. Pages without any block judged main give empty text.
Repeated rows are treated alike. Other columns are not read.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import map_batches
from martflow.llm.html_tree import Node, parse

SAMPLE_PAGES = 300
SAMPLE_CHARS = 200_000
TREES, DEPTH, RATE, BINS = 40, 4, 0.25, 32

# Elements and class words that mark boilerplate or main text.
NOISE_TAGS = frozenset(
    "nav header footer aside form menu dialog noscript button select fieldset template svg canvas object applet "
    "audio video map head".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended share sharing social "
    "comment comments reply replies discussion disqus notice cookie cookies consent popup modal overlay newsletter "
    "subscribe signup login search form pagination pager copyright legal toolbar alert".split()
)
MAIN_TAGS = frozenset("article main".split())
MAIN_WORDS = frozenset("article content post entry story main text".split())
# Boilerplate put into training pages: element, class, and how its text looks.
PLANTS = [
    ("nav", "", "links"), ("div", "navbar", "links"), ("ul", "menu", "links"), ("header", "", "line"),
    ("div", "header", "line"), ("footer", "", "line"), ("div", "footer", "text"), ("aside", "", "text"),
    ("div", "sidebar", "text"), ("div", "ad", "line"), ("div", "advert", "text"), ("section", "sponsored", "line"),
    ("div", "cookie-notice", "line"), ("div", "notice", "text"), ("form", "", "line"), ("form", "newsletter", "line"),
    ("section", "comments", "text"), ("div", "comment", "text"), ("div", "related", "links"), ("div", "promo", "text"),
    ("div", "share", "links"), ("dialog", "", "line"), ("div", "pagination", "links"),
]


def labels_of(nodes: list[Node]) -> np.ndarray:
    """1 for text blocks of the main text and all elements around them."""
    noise = np.zeros(len(nodes), dtype=bool)
    main = np.zeros(len(nodes), dtype=bool)
    for i, node in enumerate(nodes):
        up = node.parent
        main[i] = (up >= 0 and main[up]) or node.tag in MAIN_TAGS or "main" in node.tokens
        own = node.tag in NOISE_TAGS or bool(node.tokens & NOISE_WORDS and not node.tokens & MAIN_WORDS)
        noise[i] = own or (up >= 0 and noise[up])
    wants_main = any(n.tag in MAIN_TAGS for n in nodes)
    labels = np.zeros(len(nodes))
    for i, node in enumerate(nodes):
        if node.tag == "#text" and not noise[i] and (main[i] if wants_main else 2 * node.link_chars < len(node.text)):
            while i >= 0 and not labels[i]:
                labels[i] = 1
                i = nodes[i].parent
    return labels


FEATURES = (
    "noise_tag noise_above noise_words noise_words_above main_tag main_above main_words page_has_main depth "
    "subtree_chars own_chars link_share kind children siblings place share_of_parent chars_per_node punctuation "
    "parent_link_share is_text"
).split()
KINDS = {"p": 1, "h1": 2, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "li": 3, "ul": 4, "ol": 4, "td": 5, "th": 5, "table": 6, "tr": 6, "blockquote": 7, "pre": 7, "div": 8, "section": 8}


def features_of(nodes: list[Node]) -> np.ndarray:
    n = len(nodes)
    x = np.zeros((n, len(FEATURES)), dtype=np.float32)
    chars, links, marks, below = np.zeros(n), np.zeros(n), np.zeros(n), np.ones(n)
    for i, node in enumerate(nodes):
        if node.text:
            chars[i], links[i] = len(node.text), min(len(node.text), node.link_chars)
            marks[i] = sum(map(node.text.count, ".,;:!?"))
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        chars[up] += chars[i]
        links[up] += links[i]
        marks[up] += marks[i]
        below[up] += below[i]
    has_main = any(node.tag in MAIN_TAGS for node in nodes)
    link_share = links / np.maximum(chars, 1)
    place = np.zeros(n)
    for node in nodes:
        for k, child in enumerate(node.children):
            place[child] = k
    for i, node in enumerate(nodes):
        up = node.parent
        row = x[i]
        row[0] = node.tag in NOISE_TAGS
        row[2] = len(node.tokens & NOISE_WORDS)
        row[4] = node.tag in MAIN_TAGS
        row[6] = len(node.tokens & MAIN_WORDS)
        if up >= 0:
            above = x[up]
            row[1] = above[0] or above[1]
            row[3] = (above[2] > 0 and not above[6]) or above[3]
            row[5] = above[4] or above[5]
            row[14] = len(nodes[up].children)
            row[16] = chars[i] / max(chars[up], 1)
            row[19] = link_share[up]
        row[12] = KINDS.get(node.tag, 0)
        row[13] = len(node.children)
        row[20] = node.tag == "#text"
    x[:, 7] = has_main
    x[:, 8] = [node.depth for node in nodes]
    x[:, 9] = np.log1p(chars)
    x[:, 10] = [len(node.text) for node in nodes]
    x[:, 11] = link_share
    x[:, 15] = place
    x[:, 17] = np.log1p(chars / below)
    x[:, 18] = marks / np.maximum(chars, 1)
    return x


class Trees:
    """Boosted regression trees on binned features, for the logistic loss."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._binned(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        f = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            f += self._tree(tree, binned)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        f = np.full(len(x), self.start)
        for tree in self.trees:
            f += self._tree(tree, binned)
        return f

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)

    def _grow(self, binned: np.ndarray, slope: np.ndarray, curve: np.ndarray):
        """A complete tree: per inner node a feature and the bin up to which rows go left."""
        size = 2**DEPTH - 1
        feature, cut = np.zeros(size, dtype=int), np.full(size, BINS, dtype=int)
        at = np.zeros(len(binned), dtype=int)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            for j in range(binned.shape[1]):
                cell = (at - first) * (BINS + 1) + binned[:, j]
                g = np.bincount(cell, slope, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                h = np.bincount(cell, curve, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                better = value > best
                best = np.where(better, value, best)
                feature[first : first + width][better] = j
                cut[first : first + width][better] = top[better]
            at = 2 * at + 1 + (binned[np.arange(len(at)), feature[at]] > cut[at])
        leaf = at - size
        g, h = np.bincount(leaf, slope, size + 1), np.bincount(leaf, curve, size + 1)
        return feature, cut, -RATE * g / (h + 1)

    @staticmethod
    def _tree(tree, binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at, rows = np.zeros(len(binned), dtype=int), np.arange(len(binned))
        for _ in range(DEPTH):
            at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        return value[at - len(feature)]


def decode(nodes: list[Node], scores: np.ndarray) -> np.ndarray:
    """The kept nodes of the labelling with the largest total score in which
    everything below a dropped node is dropped."""
    keep = np.clip(scores, -8, 8)
    drop = -keep
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept = np.zeros(len(nodes), dtype=bool)
    kept[0] = keep[0] > drop[0]
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and keep[i] > drop[i]
    return kept


def with_plants(source: str, rng: random.Random) -> str:
    """The page with some boilerplate of known kinds before closing or opening tags."""
    spots = [i for i in range(len(source)) if source.startswith(("<p>", "<article", "</article", "<footer", "</body"), i)]
    if not spots:
        return source
    words = " ".join(n.text for n in parse(source) if n.tag == "#text").split()[:400] or ["text"]
    for _ in range(rng.randint(1, 4)):
        tag, name, look = rng.choice(PLANTS)
        start = rng.randrange(len(words))
        some = words[start : start + rng.randint(3, 10 if look != "text" else 80)]
        if look == "links":
            inner = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in some)
        elif look == "text" and rng.random() < 0.5:
            inner = f"<p>{' '.join(some)}.</p>"
        else:
            inner = " ".join(some)
        at = rng.choice(spots)
        attributes = f' {rng.choice(("class", "id"))}="{name}"' if name else ""
        source = f"{source[:at]}<{tag}{attributes}>{inner}</{tag}>{source[at:]}"
        spots = [s for s in spots if s <= at]
        if not spots:
            break
    return source


def without_main(source: str) -> str:
    """The page with its article as a plain division."""
    return source.replace("<article", "<div").replace("</article", "</div")


def fit(pages: DataFrame, html: str = "html", sample: int = SAMPLE_PAGES, seed: int = 3) -> Trees:
    """Train on at most ``sample`` pages of up to ``SAMPLE_CHARS`` characters,
    chosen by a hash of their source."""
    rows = pages.filter(F.length(html) <= SAMPLE_CHARS).select(
        F.col(html).alias("html"), F.xxhash64(html, F.lit(seed)).alias("h")
    )
    # The hashes alone are ranked; whole pages leave the executors for the chosen ones only.
    lowest = [r.h for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]
    some = rows.filter(F.col("h").isin(lowest)).dropDuplicates(["h"]).orderBy("h").collect()
    rng = random.Random(seed)
    sources = [r.html for r in some] or ["<body><nav><a>a b</a></nav><article><p>Some text, of a page.</p></article></body>"]
    sources += [with_plants(s, rng) for s in sources for _ in range(3)]
    sources += [without_main(with_plants(s, rng)) for s in sources[: len(sources) // 4]]
    trees = [parse(s) for s in sources]
    x = np.concatenate([features_of(nodes) for nodes in trees])
    y = np.concatenate([labels_of(nodes) for nodes in trees])
    return Trees().fit(x, y)


def main_text(nodes: list[Node], scores: np.ndarray) -> str:
    kept = decode(nodes, scores)
    return "\n\n".join(n.text for n, k in zip(nodes, kept, strict=True) if k and n.tag == "#text")


def _extractor(model: Trees):
    def make():
        def work(batch):
            pages = [parse(s or "") for s in batch["html"]]
            scores = model.score(np.concatenate([features_of(p) for p in pages])) if pages else np.zeros(0)
            ends = np.cumsum([len(p) for p in pages])
            texts = [main_text(p, scores[e - len(p) : e]) for p, e in zip(pages, ends, strict=True)]
            return {"id": batch["id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    return make


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", model: Trees | None = None) -> DataFrame:
    """Per row: ``key``, ``url``, ``text`` and ``n_chars``. Fits a model if none is given."""
    model = model or fit(pages, html)
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    made = map_batches(rows, _extractor(model), "id long, url string, text string, n_chars long")
    return made.withColumnsRenamed({"id": key, "url": url})
