"""Operator 8: benchmark decontamination by a generalised suffix automaton.

The automaton is built over the words of all benchmark items. Documents stream through it
word by word; it tracks the longest match that ends at each word. Where that reaches
``window`` words, the match is a hit; an item shorter than the window hits where all of it
occurs. Hit spans are removed, and a document whose hit words exceed ``max_coverage`` of its
words is dropped.

Words of a slice of documents are looked up first, and only runs in which every two
neighbours are neighbours in some item enter the automaton: outside those no match is
longer than one word, so nothing is lost.

Scale: one pass over documents without a shuffle. Items reach the workers in shards of at
most SHARD_WORDS words (one longer item is a shard by itself), whose automata a worker builds
once, one after the other, and then holds as flat arrays: some 100 bytes for each word of the
benchmark, whatever the number of shards, and several times that for the one shard that is being
built. All shards share a vocabulary and a test of neighbours, so a document's words are
looked up once; only words next to each other in some item are looked at shard by shard.
"""
from __future__ import annotations

import hashlib
import itertools
import re
import uuid
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adlake.llm.common import fresh, slices, text_column

WINDOW, MAX_COVERAGE, SHARD_WORDS = 10, 0.5, 150_000
#: Bytes to words: A-Z to lower case; ASCII other than letters and digits to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_BLOOM_BITS, _MIX = 20, np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of items: a list of (item id, words). ``vocabulary`` numbers the
    words and may be shared. States are numbers; once built, all that a state has is in flat arrays."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int, vocabulary: dict[bytes, int] | None = None):
        self.window, self.vocabulary = window, {} if vocabulary is None else vocabulary
        self.next, self.link, self.length = [{}], [-1], [0]
        encoded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for i, words in items if words]
        ends = []
        for _, ids in encoded:
            state = 0
            for c in ids:
                state = self._extend(state, c)
            ends.append(state)
        self._anchors()
        found: dict[int, set] = {}
        whole: dict[int, set] = {}
        for (item, ids), end in zip(encoded, ends):
            if len(ids) < window:
                whole.setdefault(end, set()).add(item)
                continue
            state = 0
            for k, c in enumerate(ids):
                state = self.next[state][c]
                if k + 1 >= window:
                    found.setdefault(self.anchor[state], set()).add(item)
        self._short_links(whole)
        self.shortest = min([window, *(len(ids) for _, ids in encoded)])
        # words that are a match by themselves
        self.single = [c for c, s in self.next[0].items() if window == 1 or s in whole and self.length[s] == 1]
        self.pairs = np.unique(np.array([a << 32 | b for _, ids in encoded for a, b in itertools.pairwise(ids)], dtype=np.int64))
        self._flatten(found, whole)

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, c, known)
        state = self._add({}, 0, self.length[last] + 1)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return state

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = self._add(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _add(self, edges: dict, link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _anchors(self) -> None:
        """For each state, the state on its suffix path that holds the last ``window`` words."""
        self.order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.anchor = [-1] * len(self.link)
        for s in self.order:
            if self.length[s] >= self.window:
                self.anchor[s] = s if self.length[self.link[s]] < self.window else self.anchor[self.link[s]]

    def _short_links(self, whole: dict[int, set]) -> None:
        """For each state, the nearest state further up its suffix path that ends a short item."""
        self.short = [0] * len(self.link)
        for s in self.order:
            up = self.link[s]
            self.short[s] = up if up in whole else self.short[up]
        del self.order

    def _flatten(self, found: dict[int, set], whole: dict[int, set]) -> None:
        """Edges of each state in the order of their words, and numbers for the few different sets of items."""
        first, words, targets = array("i", [0]), array("i"), array("i")
        for edges in self.next:
            for c in sorted(edges):
                words.append(c)
                targets.append(edges[c])
            first.append(len(words))
        self.first, self.words, self.targets = first, words, targets
        del self.next
        self.sets: list[frozenset] = []
        number: dict[frozenset, int] = {}

        def numbered(of: dict[int, set]) -> array:
            at = array("i", [-1]) * len(self.link)
            for s, items in of.items():
                key = frozenset(items)
                if key not in number:
                    number[key] = len(self.sets)
                    self.sets.append(key)
                at[s] = number[key]
            return at

        self.found, self.whole = numbered(found), numbered(whole)
        self.link, self.length, self.anchor, self.short = (array("i", v) for v in (self.link, self.length, self.anchor, self.short))

    def step(self, state: int, c: int) -> int:
        """The state after the word ``c``, or -1."""
        low, high = self.first[state], self.first[state + 1]
        at = bisect_left(self.words, c, low, high)
        return self.targets[at] if at < high and self.words[at] == c else -1

    def runs(self, places: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, int]]:
        """[start, end) of the runs of at least two words that may hold a match, from the places of words whose
        pair with the next one has the given key."""
        if len(self.pairs) and len(places):
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            first = places[self.pairs[at] == keys]
            if len(first):
                cut = np.flatnonzero(np.diff(first) != 1)
                starts, ends = first[np.r_[0, cut + 1]], first[np.r_[cut, len(first) - 1]] + 2
                long = ends - starts >= max(2, self.shortest)
                yield from zip(starts[long].tolist(), ends[long].tolist())

    def stream(self, ids: list[int]) -> Iterator[tuple[int, int, frozenset]]:
        """(start, end, items) of every match in a run of item words."""
        state = length = 0
        for i, c in enumerate(ids):
            after = self.step(state, c)
            while after < 0 and state:
                state = self.link[state]
                length = self.length[state]
                after = self.step(state, c)
            state = max(after, 0)
            length = length + 1 if state else 0
            if length >= self.window:
                yield i + 1 - length, i + 1, self.sets[self.found[self.anchor[state]]]
            short = state if self.whole[state] >= 0 and length == self.length[state] else self.short[state]
            while short:
                yield i + 1 - self.length[short], i + 1, self.sets[self.whole[short]]
                short = self.short[short]


class Index:
    """The automata of all shards, over one vocabulary."""

    def __init__(self, shards: list, window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.automata = []
        for shard in shards:
            items = [(i, w.split() if isinstance(w, bytes) else w) for i, w in getattr(shard, "value", shard)]
            self.automata.append(Automaton(items, window, self.vocabulary))
        self.pairs = np.unique(np.concatenate([a.pairs for a in self.automata])) if self.automata else np.zeros(0, np.int64)
        self.bloom = np.zeros(1 << _BLOOM_BITS, dtype=bool)
        self.bloom[self._slot(self.pairs)] = True
        self.single = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        self.single[[c for a in self.automata for c in a.single]] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _MIX) >> np.uint64(64 - _BLOOM_BITS)

    def neighbours(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that some item has before the word that follows, and the pairs' keys; -1 is no item's word."""
        if len(ids) < 2 or not len(self.pairs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        key = ids[first] << 32 | ids[first + 1]
        maybe = self.bloom[self._slot(key)]
        first, key = first[maybe], key[maybe]
        known = self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key
        return first[known], key[known]

    def scan(self, documents: list[list[bytes]], hits: list[np.ndarray], found: list[set]) -> None:
        """Mark the hit words of each document and add the items that occur in it."""
        starts = list(itertools.accumulate((len(d) + 1 for d in documents), initial=0))
        get, gap = self.vocabulary.get, (b"",)
        flat = itertools.chain.from_iterable(itertools.chain(d, gap) for d in documents)
        ids = np.fromiter((get(w, -1) for w in flat), dtype=np.int64, count=starts[-1])
        bounds = np.array(starts)

        def mark(automaton: Automaton, a: int, b: int) -> None:
            d = int(np.searchsorted(bounds, a, side="right")) - 1
            shift = a - starts[d]
            for s, e, items in automaton.stream(ids[a:b].tolist()):
                hits[d][shift + s:shift + e] = True
                found[d] |= items

        places, keys = self.neighbours(ids)
        alone = np.flatnonzero((ids >= 0) & self.single[ids]).tolist() if self.single.any() else []
        for automaton in self.automata:
            for a, b in automaton.runs(places, keys):
                mark(automaton, a, b)
            for k in alone:
                mark(automaton, k, k + 1)


#: This worker's indexes by scanner: those of the last two jobs that it served.
_BUILT: dict[str, Index] = {}


class Scanner:
    """Finds hits in documents, with an index that each worker builds once."""

    def __init__(self, shards: list, window: int):
        # a key of its own tells this scanner's index from others' in a worker that serves many jobs
        self.key, self.shards, self.window = uuid.uuid4().hex, shards, window

    @property
    def index(self) -> Index:
        if self.key not in _BUILT:
            while len(_BUILT) > 1:
                del _BUILT[next(iter(_BUILT))]
            _BUILT[self.key] = Index(self.shards, self.window)
        return _BUILT[self.key]

    def __call__(self, documents: list[list[bytes]]) -> tuple[list[np.ndarray], list[set]]:
        hits, found = [np.zeros(len(d), dtype=bool) for d in documents], [set() for _ in documents]
        self.index.scan(documents, hits, found)
        return hits, found

    def clean(self, text: bytes) -> bytes:
        """The text without its hit spans, searched again until none is left."""
        while True:
            words = list(_WORD.finditer(text.translate(_FOLD)))
            (hit,), _ = self([[m.group() for m in words]])
            if not hit.any():
                return text
            edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
            out, at = [], 0
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                out.append(text[at:words[a].start()])
                at = words[b - 1].end()
            text = b"".join([*out, text[at:]])


def item_shards(items: DataFrame, id_col: str, text_col: str, shard_words: int = SHARD_WORDS) -> list:
    """(item, its words joined) as broadcasts of at most ``shard_words`` words, read one at a time."""
    context, shards, shard, held = items.sparkSession.sparkContext, [], [], 0
    for item, text in items.select(items[id_col].cast("long"), text_column(items, text_col)).toLocalIterator():
        words = words_of(text.encode())
        if shard and held + len(words) > shard_words:
            shards.append(context.broadcast(shard))
            shard, held = [], 0
        shard.append((item, b" ".join(words)))
        held += len(words)
    return shards + ([context.broadcast(shard)] if shard else [])


REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<long>"


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: its words, hit words, and the items with occurring windows.

    Null and empty texts have no words. Items without words never match; a null item id
    counts as an item, written as an empty string in the digest. Repeated rows are reported
    one by one, repeated item ids once. Other columns are not read."""
    scanner = Scanner(item_shards(items, item_id_col, item_text_col, shard_words), window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            documents = [words_of(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
            hits, found = scanner(documents)
            names = [sorted("" if i is None else str(i) for i in f) for f in found]
            n_hit = [int(h.sum()) for h in hits]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(map(len, documents), pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(map(len, found), pa.int64()),
                pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names], pa.string()),
                pa.array([n > 0 for n in n_hit], pa.bool_()),
                pa.array([sorted(f, key=lambda i: (i is None, i)) for f in found], pa.list_(pa.int64()))],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), text_column(docs, text_col).alias("text")).mapInArrow(run, REPORT)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents with their own columns, hit spans cut out of the text.

    A document with more than ``max_coverage`` of its words hit is dropped. Cutting brings
    words together, so a cut text is searched until it holds no window. Texts without hits,
    null ones too, stay as they are, byte for byte. A column ``n_chars`` follows the new text."""
    scanner = Scanner(item_shards(items, item_id_col, item_text_col, shard_words), window)
    cut_col = fresh(docs, "__cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            texts = part.column(text_col).cast(pa.binary()).to_pylist()
            documents = [words_of(t or b"") for t in texts]
            hits, _ = scanner(documents)
            keep, cut = [], []
            for text, hit in zip(texts, hits):
                n = int(hit.sum())
                keep.append(n <= max_coverage * len(hit))
                cut.append(scanner.clean(text).decode() if n and keep[-1] else None)
            out = part.append_column(cut_col, pa.array(cut, pa.string()))
            yield out.filter(pa.array(keep, pa.bool_()))

    texts = docs.withColumn(text_col, docs[text_col].cast("string"))
    schema = T.StructType([*texts.schema.fields, T.StructField(cut_col, T.StringType())])
    done = texts.mapInArrow(run, schema)
    out = {text_col: F.coalesce(cut_col, text_col)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col(cut_col).isNull(), F.col("n_chars")).otherwise(F.length(cut_col).cast(kind))
    return done.withColumns(out).select(*[F.col(f"`{c}`") for c in docs.columns])
