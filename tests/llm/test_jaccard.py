"""Operator 13 against all pairs of plain Python sets."""
from __future__ import annotations

import glob
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import jaccard
from adlake.llm.jaccard import differing, drop_near_duplicates, near_duplicates, parity, prefix_size, products, shingle_set
from conftest import SF_ORACLE


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_set(text, width=5):
    w = words(text)
    return {tuple(w[k:k + width]) for k in range(max(len(w) - width + 1, 1))} if w else set()


def brute(docs, percent=80, width=5):
    sets = [plain_set(t, width) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    overlap = Counter((a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1:])
    for (a, b), n in overlap.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), (True, 0)), (d is None, d or 0))
    return sorted(((d, len(sets[i]), None if least[find(i)][0] else least[find(i)][1]) for i, (d, _) in enumerate(docs)), key=repr)


def result(frame, **kw):
    return sorted((tuple(r)[:3] for r in near_duplicates(frame, **kw).collect()), key=repr)


def corpus(seed, size=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    docs, texts = [], []
    for k in range(size):
        kind = rng.random()
        if texts and kind < 0.5:  # a near copy, sometimes of a near copy
            w = list(rng.choice(texts))
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(1, 3))
        else:
            w = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 6, 9, 30, 60, 120]))
            if kind < 0.8:
                at = rng.randrange(len(w))
                w[at:at] = passage[:rng.randrange(5, 41)]
        texts.append(w)
        docs.append((k * 3 % 101 if rng.random() < 0.1 else k + 200, " ".join(w)))
    docs += [(None, None), (1, ""), (2, " \t\n"), (3, "a b c"), (4, "A  b\nC"), (5, "a b c d"), (6, "a b c"), (None, "only null"), (None, "Only Null"),
             (7, "r " * 4000), (8, "r " * 3999), (9, "é É"), (10, "é é")]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(frame) == brute(docs)
    assert result(frame, frequent_rows=2, block_rows=3) == brute(docs)


def test_other_width_and_threshold(spark):
    docs = corpus(3, 80)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(frame, width=2, percent=55, frequent_rows=3, block_rows=4) == brute(docs, 55, 2)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(70)]
    docs = []
    for k in range(500):
        w = list(base)
        for at in rng.sample(range(70), rng.randrange(1, 3)):
            w[at] = f"x{rng.randrange(10_000)}"
        docs.append((k, " ".join(w)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert result(frame, block_rows=32) == brute(docs)


def test_given_documents(spark):
    frame = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    assert result(frame) == brute([tuple(r) for r in frame.collect()])


def test_bounds():
    rng = random.Random(4)
    for _ in range(200):
        a = set(rng.sample(range(300), rng.randrange(1, 200)))
        b = {x for x in a if rng.random() < 0.9} | set(rng.sample(range(300), rng.randrange(1, 40)))
        x, y = (np.sort(np.array([hash((v, "s")) for v in s], dtype=np.int64)) for s in (a, b))
        linked = 100 * len(a & b) >= 80 * len(a | b)
        assert products([x], [y]).tolist() == [linked]
        assert differing(np.frombuffer(parity(x), np.uint8), np.frombuffer(parity(y), np.uint8)) <= len(a ^ b)
        if linked:
            assert set(x[:prefix_size(len(x))].tolist()) & set(y[:prefix_size(len(y))].tolist())


def test_sets():
    assert len(shingle_set(b"")) == 0 and len(shingle_set(b" \n")) == 0
    assert len(shingle_set(b"a b c")) == 1 and shingle_set(b"A b\tC").tolist() == shingle_set(b"a b c").tolist()
    assert len(shingle_set(b"a " * 50)) == 1
    assert shingle_set(b"a b c").tolist() != shingle_set(b"a b c d").tolist()


def test_bitmap(spark):
    values = [0, 1, -1, 63, 64, 2 ** 62, -2 ** 63, 12345]
    held = jaccard.bitmap(spark.createDataFrame([(v,) for v in values], "c long"), "c", 12).value
    assert all(v in held for v in values) and 77 not in held and 12346 not in held
    assert 5 not in jaccard.bitmap(spark.createDataFrame([], "c long"), "c", 12).value


def test_rows_kept_clashes_and_empty(spark):
    docs = corpus(5, 60)
    frame = spark.createDataFrame(docs, "id long, body string").withColumn("kept", F.lit("k")).withColumn("__n", F.col("id"))
    marked = near_duplicates(frame, "id", "body").filter("kept")
    kept = drop_near_duplicates(frame, "id", "body")
    assert kept.columns == frame.columns
    assert sorted(map(repr, (r["id"] for r in kept.collect()))) == sorted(map(repr, (r["doc_id"] for r in marked.collect())))
    assert kept.filter("kept = 'k'").count() == kept.count() < len(docs)
    assert drop_near_duplicates(frame.limit(0), "id", "body").count() == 0
    with pytest.raises(ValueError, match="kept"):
        near_duplicates(frame, "id", "body", carry=("kept",))


def test_tables_and_shuffle_files_go_when_nothing_reads_them(spark, monkeypatch):
    docs = corpus(6)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    made = []

    def recorded(df, name, old=jaccard.materialize):
        table = old(df, name)
        made.append((name, os.path.dirname(table.inputFiles()[0]).removeprefix("file://")))
        return table

    def files():
        return {f for d in local for f in glob.glob(f"{d}/*/shuffle_*.data")}

    monkeypatch.setattr(jaccard, "materialize", recorded)
    shuffles = files()
    marked = near_duplicates(frame)
    small = {"jaccard-links", "jaccard-near", "jaccard-stars", "jaccard-wanted"}  # pairs and keys
    assert sorted(name for name, path in made if os.path.exists(path) and name not in small) == ["jaccard-owners", "jaccard-rows"]
    assert len(files() - shuffles) < 60
    assert sorted((tuple(r)[:3] for r in marked.collect()), key=repr) == brute(docs)


def test_pairs_are_looked_at_once(spark, monkeypatch):
    looked = []

    def near(self, pairs, column, old=jaccard._Join._near):
        if column == "__parity":
            looked.extend(tuple(r) for r in pairs.select("a", "b").collect())
        return old(self, pairs, column)

    monkeypatch.setattr(jaccard._Join, "_near", near)
    # shared halves, so that lists are open in all rounds, and sets so large that 512 bits let most pairs pass
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = rng.choices(vocabulary, k=2000)
    docs = [(k, " ".join(base[:1400] + rng.choices(vocabulary, k=600))) for k in range(12)]
    assert result(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)
    assert looked and len(looked) == len(set(looked))
