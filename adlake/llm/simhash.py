"""Operator 7: SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints. A text's words are joined by single spaces; each run of ``shingle`` words is
hashed to 64 bits (XXH64, seed 42), repeats included; a fingerprint bit is 1 when it is set
in over half the hashes.

Index. Its top nodes are masked bit patterns: the 64 bits fall into ``max_bits + 2``
blocks, and two fingerprints within ``max_bits`` bits agree on at least two of them, so each
fingerprint enters one top node for every pair of blocks. Below a top node, fingerprints are
sorted by Gray rank, so neighbours share most bits; runs of GROUP become leaf nodes, and
FANOUT nodes at a time get an upper node that stores the bits all its members share (mask
and pattern). A search walks down pairs of nodes, adds up the differing shared bits,
and drops a pair of whole groups as soon as that exceeds ``max_bits``; where even the
bits that are not shared can't reach it, the groups are linked as wholes. A top node emits
a spanning star for each component that it sees, never all its pairs.

Scale: copies collapse to one row per fingerprint before the search, with the aggregate
ahead of the shuffle. A top node with more than NODE_ROWS members is dealt into parts by
hash, and every two parts meet in a task of their own, so no task holds more than about
2 * NODE_ROWS fingerprints and no link is lost. Links, components and fingerprints stay in
tables. Results do not depend on NODE_ROWS, GROUP or FANOUT.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from adlake.llm.common import fresh, materialize, refuse_clashes, slices, text_column
from adlake.llm.components import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
NODE_ROWS, GROUP, FANOUT, SMALL = 8192, 32, 8, 32
#: Node pairs expanded, or shingles summed, at once.
BLOCK = 4096
#: Bytes to words: A-Z to lower case, ASCII white space to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The text's fingerprint, unsigned; zero for a text without words."""
    joined = text.translate(_FOLD).strip(b" ")
    while b"  " in joined:
        joined = joined.replace(b"  ", b" ")
    if not joined:
        return 0
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    if len(spaces) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    n = len(spaces) - shingle + 2
    starts, ends = np.r_[0, spaces[:n - 1] + 1], np.r_[spaces[shingle - 1:], len(joined)]
    counts, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 16 * BLOCK):
        spans = zip(starts[at:at + 16 * BLOCK].tolist(), ends[at:at + 16 * BLOCK].tolist())
        h = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8").view(np.uint8)
        for byte in range(8):
            counts[8 * byte:8 * byte + 8] += np.bincount(h[byte::8], minlength=256) @ _BITS
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist()))


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, text_col: str, shingle: int, out_col: str) -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint column in place of the text's own position."""
    source = docs.withColumn(text_col, text_column(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            texts = part.column(text_col).cast(pa.binary()).to_pylist()
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            rest = part.drop_columns([text_col])
            yield rest.append_column(out_col, pa.array(values, pa.int64()))

    kept = [f for f in source.schema.fields if f.name != text_col]
    ddl = type(source.schema)(kept).add(out_col, "long")
    return source.mapInArrow(run, ddl)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a-b as (node, root): one row for each node that isn't its component's smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        if (rx == ry).all():
            moved = root != np.arange(len(nodes))
            return nodes[moved], nodes[root[moved]]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while (root[root] != root).any():
            root = root[root]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each value in Gray order."""
    x = x.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        x ^= x >> np.uint64(shift)
    return x


class Node:
    """One level of the index: per node its first and last child, the mask of bits that all
    its members share, and their pattern."""

    def __init__(self, first: np.ndarray, last: np.ndarray, mask: np.ndarray, pattern: np.ndarray):
        self.first, self.last, self.mask, self.pattern = first, last, mask, pattern


def index_levels(x: np.ndarray) -> list[Node]:
    """From the leaf nodes (over Gray-ordered fingerprints) to the root."""
    full, levels = np.full(len(x), ~np.uint64(0)), []
    mask, pattern, width = full, x, GROUP
    while not levels or len(mask) > 1:
        first = np.arange(0, len(mask), width)
        last = np.minimum(first + width, len(mask))
        ones = np.bitwise_and.reduceat(pattern | ~mask, first)
        zeros = np.bitwise_or.reduceat(pattern & mask, first)
        shared = np.bitwise_and.reduceat(mask, first) & ~(ones ^ zeros)
        mask, pattern = shared, zeros & shared
        levels.append(Node(first, last, mask, pattern))
        width = FANOUT
    return levels


def _expand(ia: np.ndarray, ib: np.ndarray, level: Node) -> tuple[np.ndarray, np.ndarray]:
    """All child pairs of node pairs, each unordered pair once."""
    na, nb = level.last[ia] - level.first[ia], level.last[ib] - level.first[ib]
    total = na * nb
    k = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    width = np.repeat(nb, total)
    a, b = np.repeat(level.first[ia], total) + k // width, np.repeat(level.first[ib], total) + k % width
    once = a <= b
    return a[once], b[once]


def node_links(x: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) stars of the links among distinct fingerprints below one top node."""
    x = x[np.argsort(gray_rank(x))]
    levels = index_levels(x)
    ia = ib = np.zeros(1, dtype=np.int64)
    label = np.arange(len(x))

    def link(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal label
        differ = label[a] != label[b]
        if differ.any():
            node, root = stars(label[a[differ]], label[b[differ]])
            to = np.arange(len(x))
            to[node] = root
            label = to[label]

    for depth in reversed(range(len(levels))):
        level, kept = levels[depth], []
        for at in range(0, len(ia), BLOCK):
            a, b = ia[at:at + BLOCK], ib[at:at + BLOCK]
            both = level.mask[a] & level.mask[b]
            lower = np.bitwise_count((level.pattern[a] ^ level.pattern[b]) & both)
            near = lower <= max_bits
            whole = near & (lower + np.bitwise_count(~both) <= max_bits)
            if depth == 0 and whole.any():
                fa, fb = a[whole], b[whole]
                for n in range(GROUP):  # every member of both groups is within reach of b's first
                    for g in (fa, fb):
                        member = level.first[g] + n
                        ok = member < level.last[g]
                        link(member[ok], level.first[fb][ok])
                near &= ~whole
            if depth == 0:
                order = np.argsort(b[near] - a[near], kind="stable")
                _leaves(x, level, a[near][order], b[near][order], max_bits, link, lambda: label)
            else:
                kept.append(_expand(a[near], b[near], level))
        if depth:
            ia, ib = (np.concatenate(side) for side in zip(*kept))
    moved = label != np.arange(len(x))
    return x[moved], x[label[moved]]


def _leaves(x, level, a, b, max_bits, link, labels) -> None:
    """Compare the members of leaf pairs; pairs that are one component already are skipped."""
    step = max(1, 16 * BLOCK // (GROUP * GROUP))
    for at in range(0, len(a), step):
        pa_, pb_ = a[at:at + step], b[at:at + step]
        label = labels()
        low, high = np.minimum.reduceat(label, level.first), np.maximum.reduceat(label, level.first)
        done = (low[pa_] == high[pa_]) & (low[pb_] == high[pb_]) & (low[pa_] == low[pb_])
        i, j = _expand(pa_[~done], pb_[~done], level)
        near = np.bitwise_count(x[i] ^ x[j]) <= max_bits
        link(i[near], j[near])


def _small_links(cell: np.ndarray, x: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in runs of equal ``cell`` of at most SMALL rows, many runs at once."""
    a, b = [], []
    for d in range(1, SMALL):
        same = np.flatnonzero(cell[:-d] == cell[d:])
        if not len(same):
            break
        near = same[np.bitwise_count(x[same] ^ x[same + d]) <= max_bits]
        a.append(x[near])
        b.append(x[near + d])
    return (np.concatenate(a), np.concatenate(b)) if a else (x[:0], x[:0])


def search(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Batches of (k, p, i, j, x), equal keys together -> links. Holds one top node at a time."""
    held: list[np.ndarray] = []

    def links(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, x = rows[:4], rows[4].view(np.uint64)
        new = np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]
        start = np.flatnonzero(new)
        size = np.diff(np.r_[start, len(x)])
        small = np.repeat(size <= SMALL, size)
        a, b = _small_links(np.cumsum(new)[small], x[small], max_bits)
        out = [stars(a, b)] + [node_links(x[s:s + n], max_bits) for s, n in zip(start, size) if n > SMALL]
        a, b = (np.concatenate(side) for side in zip(*out))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        rows = np.array([batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False) for c in range(5)])
        rows = np.concatenate([*held, rows], axis=1) if held else rows
        if not rows.shape[1]:
            continue
        differ = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0))
        last = differ[-1] + 1 if len(differ) else 0
        if last:
            yield from links(rows[:, :last])
        held = [rows[:, last:]]
    if held:
        yield from links(held[0])


def block_masks(max_bits: int) -> list[int]:
    """Signed masks of every two of ``max_bits + 2`` blocks of the 64 bits."""
    edges = [64 * i // (max_bits + 2) for i in range(max_bits + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    masks = [a | b for a, b in itertools.combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) that span the components of the distinct fingerprints ``x``."""
    masks = block_masks(max_bits)
    tops = F.array(*[F.struct(F.lit(k).alias("k"), F.col("x").bitwiseAND(F.lit(m)).alias("p")) for k, m in enumerate(masks)])
    rows = prints.select("x", F.explode(tops).alias("t")).select("t.k", "t.p", "x")
    large = materialize(rows.groupBy("k", "p").count().filter(F.col("count") > node_rows).select(
        "k", "p", F.ceil(F.col("count") / node_rows).cast("int").alias("parts")), "simhash-large-nodes")
    dealt = rows.join(large, ["k", "p"], "left")
    part = F.pmod(F.xxhash64("x"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
        F.least(o, part).alias("i"), F.greatest(o, part).alias("j")))
    meets = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.filter(others, lambda c: c["i"] != c["j"]))
    cells = dealt.select("k", "p", F.explode(meets).alias("c"), "x").select("k", "p", "c.i", "c.j", "x")
    together = cells.repartition("k", "p", "i", "j").sortWithinPartitions("k", "p", "i", "j")
    return together.mapInArrow(lambda batches: search(batches, max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept, then ``carry``.

    component_id is the smallest id among documents reachable over links, itself included;
    exactly one row of a component is kept, one with that id. Null texts count as empty; texts
    without words have fingerprint zero. Null ids rank after all others, and a component of
    null ids alone has a null component_id. Repeated rows belong to one component. An
    empty table gives an empty result. ``carry`` columns may not have the result's names."""
    refuse_clashes(carry, ("doc_id", "fingerprint", "component_id", "kept", "__copy", "__x", "__uid", "first"))
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("__copy"), *[docs[f"`{c}`"] for c in carry])
    rows = fingerprints(source, "__copy", shingle, "__x")
    rows = materialize(rows.withColumn("__uid", F.monotonically_increasing_id()), "simhash-rows")
    best = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("__uid").alias("uid"))
    prints = materialize(rows.groupBy(F.col("__x").alias("x")).agg(F.min(best).alias("best")), "simhash-prints")
    roots = components(fingerprint_links(prints.select("x"), max_bits))
    known = prints.join(roots, prints["x"] == roots["node"], "left").select("x", F.coalesce("root", "x").alias("root"), "best")
    firsts = known.groupBy("root").agg(F.min("best").alias("first"))
    owner = materialize(known.join(firsts, "root").select(F.col("x").alias("__x"), "first"), "simhash-owners")
    return rows.join(owner, "__x").select(
        "doc_id", F.lpad(F.lower(F.hex("__x")), 16, "0").alias("fingerprint"), F.col("first.id").alias("component_id"),
        (F.col("__uid") == F.col("first.uid")).alias("kept"), *carry)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with their own columns, whatever those are named.
    Null texts count as empty; texts without words have fingerprint zero and are one component. A null id ranks
    after all others; of repeated rows one stays. An empty table gives an empty result."""
    names = {c: fresh(docs, f"__carry_{i}") for i, c in enumerate(docs.columns)}
    inner = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in names.items()])
    marked = near_duplicates(inner, names[id_col], names[text_col], shingle, max_bits, tuple(names.values()))
    return marked.filter("kept").select(*[F.col(n).alias(c) for c, n in names.items()])
