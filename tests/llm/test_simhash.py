from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from adlake.llm import simhash
from adlake.llm.components import components
from adlake.llm.simhash import block_masks, drop_near_duplicates, fingerprint, fingerprint_links, near_duplicates, node_links


def brute_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits):
    root = {x: x for x in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x in prints:
        for y in prints:
            if x < y and (x ^ y).bit_count() <= max_bits:
                root[max(find(x), find(y))] = min(find(x), find(y))
    return {x: find(x) for x in prints}


def partition(pairs):
    groups = {}
    for member, name in pairs:
        groups.setdefault(name, set()).add(member)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("text", ["", " \t\n", "one", "a b c", "a b c d", "A b C d e", "x  y\tz\x0bw v", "é ß ñ é ß ñ é", "a " * 700,
                                  "w x y z q", "\x1ca b\x1f c d e"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = random.Random(3)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(500))
    assert fingerprint(text.encode()) == brute_fingerprint(text)


def test_masks_cover_every_close_pair():
    rng = random.Random(5)
    masks = [m & (1 << 64) - 1 for m in block_masks(4)]
    assert len(masks) == 15
    for _ in range(500):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        assert any(x & m == y & m for m in masks)


def cluster(rng, n, centre_bits=6):
    """Dense clusters and loners."""
    out = set()
    while len(out) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 60])):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, centre_bits)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)[:n]


@pytest.mark.parametrize("seed", range(6))
def test_index_matches_brute_force(seed):
    prints = cluster(random.Random(seed), 400)
    node, root = node_links(np.array(prints, dtype=np.uint64), 4)
    found = {x: x for x in prints} | dict(zip(node.tolist(), root.tolist()))
    assert partition(found.items()) == partition(brute_components(prints, 4).items())


def test_whole_groups_link_at_once():
    prints = [0xABC0 << 32 | x for x in range(16)] + [0xABC0 << 32 | 0xFF << 48 | x for x in range(200)]
    node, root = node_links(np.array(sorted(set(prints)), dtype=np.uint64), 4)
    found = {x: x for x in prints} | dict(zip(node.tolist(), root.tolist()))
    assert partition(found.items()) == partition(brute_components(sorted(set(prints)), 4).items())


@pytest.mark.parametrize("node_rows", [8192, 7])
def test_links_over_nodes_and_parts(spark, node_rows):
    """With 7 rows to a node most nodes are dealt into parts; results are the same."""
    prints = cluster(random.Random(11), 300)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    links = fingerprint_links(spark.createDataFrame(signed, "x long"), 4, node_rows)
    found = {x: x for (x,) in signed} | {r.node: r.root for r in components(links).collect()}
    want = {(x - (1 << 64) if x >> 63 else x): r for x, r in brute_components(prints, 4).items()}
    assert partition(found.items()) == partition(want.items())


def test_components_of_long_paths(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 101) for i in range(40)] + [(5, 5)]
    rng.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 40)}


def texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    out = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 30, 300]))]
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(base)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return out + ["", None, " ", "SAME text Here now", "same TEXT here now", "long " * 60_000]


def test_near_duplicates_match_brute_force(spark):
    rows = list(enumerate(texts())) + [(3, texts()[3]), (None, texts()[0]), (None, "nobody else has this text")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    got = near_duplicates(docs).collect()
    prints = {brute_fingerprint(t or "") for _, t in rows}
    roots = brute_components(sorted(prints), 4)
    smallest = {}
    for i, t in rows:
        r = roots[brute_fingerprint(t or "")]
        smallest[r] = min((x for x in (smallest.get(r), i) if x is not None), default=None)
    want = sorted([(i, "%016x" % brute_fingerprint(t or ""), smallest[roots[brute_fingerprint(t or "")]]) for i, t in rows], key=repr)
    assert sorted([tuple(r)[:3] for r in got], key=repr) == want
    assert sum(r.kept for r in got) == len(smallest)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(smallest)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == [] and drop_near_duplicates(empty).collect() == []
