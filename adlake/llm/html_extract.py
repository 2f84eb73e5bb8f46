"""Operator 9: main text of web pages by boosted trees over DOM nodes.

A page becomes a tree of its block elements, with each run of inline text as a leaf. Every
node gets features: how much text its subtree holds and how densely, how much of it is
links, its attribute tokens' and tag's learned scores and those of its ancestors, depth,
place and its siblings. Gradient-boosted trees score each node for holding main text.
Decoding is hierarchical: a node may only stay if its parent stays; the best such choice
over the whole tree (largest sum of scores) comes from one pass from the leaves up and one
back. So a menu's words can't stay when the menu goes, and an article's container can't go
when its paragraphs stay.

There are no labelled pages, so the trees are trained on TRAINING_PAGES generated ones
(``template_page``), seeded and so always the same. The fitted model is small and of fixed size. Extraction is one pass
over whole pages without a shuffle.
"""
from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from adlake.llm.common import slices, text_column
from adlake.llm.html_templates import MAIN_MARK, template_page

TRAINING_PAGES, SEED = 800, 9
TREES, DEPTH, RATE, BINS, LEAF_WEIGHT = 60, 4, 0.2, 48, 1.0
#: Attribute tokens and tags of fewer training nodes get no score.
RARE = 12
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr "
                   # formulas are part of the text around them
                   "math semantics annotation annotation-xml mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded "
                   "mphantom menclose mfenced msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr "
                   "mlabeledtr mtd maction".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Text in these is never a page's text.
HIDDEN = frozenset("script style template head title iframe svg".split())
#: Start tags that may stand in a head; any other closes an open one, as text does.
IN_HEAD = frozenset("base link meta script style template title noscript".split())
#: Blocks that may stand in a paragraph.
PHRASING = frozenset("noscript object".split())
CONTROLS = frozenset("input select button textarea option".split())
#: A start tag on the left closes an open element on the right, looked for up to a boundary.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
BOUNDARY = frozenset("ul ol dl table body html".split())
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: A tag that the page's end cuts is no text.
_CUT_TAG = re.compile(r"<[/!a-zA-Z][^<>]*$")
_MARKS = re.compile(r"[.,;:!?]")


class Tree(HTMLParser):
    """Block elements and text leaves of a page, in page order; node 0 is the root."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.tokens = ["#root"], [-1], [()]
        self.text: list[list[str] | None] = [None]
        self.links, self.controls = [0], [0]
        self.open = [("#root", 0)]
        #: Places in ``open``: of each name's elements; of blocks; of the boundaries; and for each element the
        #: nearest one from it downwards that is no noscript. So no tag ever searches the open elements.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.block_places, self.boundaries, self.under = [0], [], [0]
        self.hidden = 0
        self.leaf = -1
        self.feed(_CUT_TAG.sub("", html))
        self.close()

    def _node(self, tag: str, tokens: tuple = ()) -> int:
        self.tag.append(tag)
        self.parent.append(self.open[-1][1])
        self.tokens.append(tokens)
        self.text.append([] if tag == "#text" else None)
        self.links.append(0)
        self.controls.append(0)
        return len(self.tag) - 1

    def _push(self, tag: str, node: int) -> None:
        k = len(self.open)
        self.open.append((tag, node))
        self.places[tag].append(k)
        if tag not in INLINE:
            self.block_places.append(k)
        if tag in BOUNDARY:
            self.boundaries.append(k)
        self.under.append(self.under[-1] if tag == "noscript" else k)
        self.hidden += tag in HIDDEN

    def _cut(self, k: int) -> None:
        """Close the elements from place k on."""
        for tag, _ in self.open[k:]:
            self.places[tag].pop()
            self.hidden -= tag in HIDDEN
        del self.open[k:], self.under[k:]
        for places in (self.block_places, self.boundaries):
            while places and places[-1] >= k:
                places.pop()

    def _last(self, tag: str) -> int:
        """The place of the innermost open element of that name, or -1."""
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _end_head(self) -> None:
        """Close an open head that what comes next can't stand in, whose end tag was left out."""
        while self.open[k := self.under[-1]][0] == "head":
            self._cut(k)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.places["head"] and tag not in IN_HEAD:
            self._end_head()
        if tag in CONTROLS:
            self.controls[self.open[-1][1]] += 1
        if tag in INLINE:
            if tag == "br" and self.leaf >= 0:
                self.text[self.leaf].append(" ")
            if tag not in VOID:
                self._push(tag, self.open[-1][1])
            return
        self.leaf = -1
        if tag in VOID:
            return
        if tag not in PHRASING:
            closed = CLOSES.get(tag)
            if closed:
                k = max(self._last(name) for name in ("p", *closed))
                if k > (self.boundaries[-1] if self.boundaries else 0):
                    self._cut(k)
            elif self.open[self.block_places[-1]][0] == "p":
                self._cut(self.block_places[-1])
        words = (w for key, value in attrs if key in ("class", "id", "role", "itemprop") and value for w in _TOKEN.findall(value))
        self._push(tag, self._node(tag, tuple(w.lower() for w in words)))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # in HTML the slash means nothing

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.leaf = -1
        k = self._last(tag)
        if k > 0 and (tag not in INLINE or k > self.block_places[-1]):
            self._cut(k)

    def handle_data(self, data: str) -> None:
        if self.places["head"] and data.strip():
            self._end_head()
        if self.hidden:
            return
        if self.leaf < 0:
            if not data.strip():
                return
            node = self.open[-1][1]
            self.leaf = self._node("#text")
            self.parent[self.leaf] = node
        self.text[self.leaf].append(data)
        if any(name == "a" for name, _ in self.open[-4:]):
            self.links[self.leaf] += len(data)

    def unknown_decl(self, data: str) -> None:
        """CDATA and the like are no text."""


def blocks(tree: Tree) -> list[str | None]:
    """The text of each leaf, white space runs as one space; None for elements."""
    return [None if t is None else " ".join("".join(t).split()) for t in tree.text]


FEATURES = 32


def features(tree: Tree, texts: list[str | None], tag_score: dict, token_score: dict) -> np.ndarray:
    """One row of numbers per node."""
    n, parent, tag = len(tree.tag), tree.parent, tree.tag
    chars, links, marks, digits = [0] * n, list(tree.links), [0] * n, [0] * n
    leaves, elements, paragraphs, controls = [0] * n, [0] * n, [0] * n, list(tree.controls)
    children: list[list[int]] = [[] for _ in range(n)]
    in_paragraphs, depth, before, seen = [0] * n, [0] * n, [0] * n, 0
    own_low, own_high = [0.0] * n, [0.0] * n
    low_tag, high_tag, low_token, high_token = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for v in range(1, n):
        p = parent[v]
        children[p].append(v)
        depth[v] = depth[p] + 1
        before[v] = seen
        t = texts[v]
        if t is not None:
            chars[v] = len(t)
            links[v] = min(links[v], len(t))
            marks[v] = len(_MARKS.findall(t))
            digits[v] = sum(map(t.count, "0123456789"))
            leaves[v] = 1
            in_paragraphs[v] = len(t) if tag[p] == "p" else 0
            seen += len(t)
        else:
            elements[v] = 1
            paragraphs[v] = tag[v] == "p"
        s = tag_score.get(tag[v], 0.0)
        low_tag[v], high_tag[v] = min(low_tag[p], s), max(high_tag[p], s)
        if tree.tokens[v]:
            scores = [token_score.get(w, 0.0) for w in tree.tokens[v]]
            own_low[v], own_high[v] = min(scores), max(scores)
        low_token[v], high_token[v] = min(low_token[p], own_low[v]), max(high_token[p], own_high[v])
    for v in range(n - 1, 0, -1):
        p = parent[v]
        for total in (chars, links, marks, digits, leaves, elements, paragraphs, controls, in_paragraphs):
            total[p] += total[v]
    out = np.zeros((n, FEATURES), dtype=np.float32)
    log, whole = math.log1p, max(1, chars[0])
    place, around, same, prev_text, next_text = [0.0] * n, [1] * n, [1.0] * n, [0] * n, [0] * n
    for kids in children:
        count = defaultdict(int)
        for v in kids:
            count[tag[v]] += 1
        for k, v in enumerate(kids):
            place[v], around[v], same[v] = k / len(kids), len(kids), count[tag[v]] / len(kids)
            prev_text[v] = chars[kids[k - 1]] if k else -1
            next_text[v] = chars[kids[k + 1]] if k + 1 < len(kids) else -1
    for v in range(1, n):
        p, size = parent[v], max(1, chars[v])
        over = tag[p] if texts[v] is not None else tag[v]
        out[v] = (
            texts[v] is not None, depth[v], log(chars[v]), links[v] / size, log(leaves[v]), log(size / max(1, leaves[v])),
            log(size / (elements[v] + 1)), before[v] / whole, size / whole, place[v], log(around[v]), same[v],
            log(prev_text[v] + 1), log(next_text[v] + 1), marks[v] / size, digits[v] / size, tag_score.get(tag[v], 0.0),
            own_low[v], own_high[v], low_tag[v], high_tag[v], low_token[v], high_token[v], links[p] / max(1, chars[p]),
            log(chars[p]), log(controls[v]), over in ("h1", "h2", "h3", "h4", "h5", "h6"), over == "p", over == "li",
            over in ("td", "th"), log(paragraphs[v]), in_paragraphs[v] / size)
    return out


class Trees:
    """Gradient-boosted trees of one depth for the logistic loss, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.depth, n = depth, len(y)
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)])
        self.base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
        score, self.trees = np.full(n, self.base), []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            feature, cut, at = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1, np.float32), np.zeros(n, np.int64)
            for level in range(depth):
                width, start = 1 << level, (1 << level) - 1
                local, best = at - start, np.full(width, 1e-9)
                choice = np.full((width, 2), -1)
                for f in range(len(binned)):
                    cell = local * BINS + binned[f]
                    gs = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(1)
                    hs = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1)
                    gain[:, len(self.edges[f]):] = 0
                    gain[(hs < LEAF_WEIGHT) | (ht - hs < LEAF_WEIGHT)] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(width), k]
                    better = top > best
                    best[better], choice[better] = top[better], np.c_[np.full(better.sum(), f), k[better]]
                for w, (f, k) in enumerate(choice):  # a node without a useful cut sends all rows left
                    feature[start + w], cut[start + w] = (f, self.edges[f][k]) if f >= 0 else (0, np.inf)
                at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
            leaf = at - ((1 << depth) - 1)
            value = rate * np.bincount(leaf, g, 1 << depth) / (np.bincount(leaf, h, 1 << depth) + 1)
            self.trees.append((feature, cut, value))
            score += value[leaf]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            total += value[at - ((1 << self.depth) - 1)]
        return total


def decode(parent: list[int], score: list[float]) -> list[bool]:
    """Of all choices in which every node that stays has a parent that stays, the one of the
    largest summed score. The root stays."""
    gain = list(score)
    for v in range(len(parent) - 1, 0, -1):
        if gain[v] > 0:
            gain[parent[v]] += gain[v]
    stays = [True] * len(parent)
    for v in range(1, len(parent)):
        stays[v] = stays[parent[v]] and gain[v] > 0
    return stays


class Extractor:
    """Learned tag and token scores, and the trees."""

    def __init__(self, pages: list[str]):
        trees = [Tree(p) for p in pages]
        labels, tags, tokens = [], defaultdict(lambda: [1, 1]), defaultdict(lambda: [1, 1])
        for t in trees:
            main = [x is not None and MAIN_MARK in "".join(x) for x in t.text]
            for v in range(len(main) - 1, 0, -1):
                main[t.parent[v]] |= main[v]
                if t.text[v] is None:
                    tags[t.tag[v]][main[v]] += 1
                    for w in set(t.tokens[v]):
                        tokens[w][main[v]] += 1
                else:
                    t.text[v] = [s.replace(MAIN_MARK, "") for s in t.text[v]]
            labels.append(main[1:])
        # a name that few nodes carry says nothing, as one that was never seen
        self.tags, self.tokens = ({k: math.log(b / a) for k, (a, b) in found.items() if a + b >= RARE + 2} for found in (tags, tokens))
        x = np.concatenate([features(t, blocks(t), self.tags, self.tokens)[1:] for t in trees])
        self.model = Trees(x, np.concatenate(labels).astype(float))

    def __call__(self, pages: list[str]) -> list[str]:
        """The main text of each page."""
        trees = [Tree(p) for p in pages]
        texts = [blocks(t) for t in trees]
        rows = [features(t, b, self.tags, self.tokens) for t, b in zip(trees, texts)]
        score = self.model.score(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for t, b in zip(trees, texts):
            stays = decode(t.parent, score[at:at + len(b)].tolist())
            out.append("\n".join(x for x, s in zip(b, stays) if x and s))
            at += len(b)
        return out


@lru_cache(maxsize=2)
def extractor(pages: int = TRAINING_PAGES, seed: int = SEED) -> Extractor:
    """The extractor trained on generated pages, once per process."""
    rng = np.random.default_rng(seed)
    return Extractor([template_page(rng) for _ in range(pages)])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by line feeds; empty if none), n_chars.

    Null or empty html, and text without markup that is taken for no article, give what the trees decide on it,
    an empty text for an empty page. Repeated rows are extracted one by one; an empty table
    gives an empty result. Other columns are not read."""
    shared = pages.sparkSession.sparkContext.broadcast(extractor())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html", 1 << 20):
            texts = shared.value(part.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                          text_column(pages, html_col).alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
