"""Operator 12 against zlib and plain Python."""
from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adlake.llm.importance import BLOCK, crc_spans, importance, resample

BUCKETS = 50


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=900), st.data())
def test_crc_equals_zlib(data, draw):
    cuts = draw.draw(st.lists(st.integers(0, len(data)), min_size=2, max_size=8))
    spans = [(min(a, b), max(a, b)) for a in cuts for b in cuts]
    got = crc_spans(np.frombuffer(data, np.uint8), *zip(*spans))
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def test_crc_of_long_spans():
    data = random.Random(3).randbytes(300_000)
    spans = [(k, k + n) for k, n in enumerate([BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK, 7 * BLOCK + 5, 4096, 65_537, 299_000])]
    got = crc_spans(np.frombuffer(data, np.uint8), *zip(*spans))
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def brute(docs, target, percent, min_words):
    def runs(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
        return len(words), [" ".join(words[k:k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]

    def bucket(run):
        return zlib.crc32(run.encode()) % BUCKETS

    s, t = (Counter(bucket(f) for text in texts for f in runs(text)[1]) for texts in ([d[1] for d in docs], target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + BUCKETS) / ((s[b] + 1) * (t.total() + BUCKETS)))) for b in range(BUCKETS)]
    rows = []
    for doc_id, text in docs:
        n, found = runs(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words])
    may = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = percent * len(may) // 100
    return sorted((str((*r[:4], may.index(r) + 1 if r[4] and may.index(r) < drawn else None)) for r in rows))


def corpus():
    rng = random.Random(5)
    vocabulary = ["a", "Ärger", "été", "b1", "x" * 150, "don't", "中文", "w\x7fz"] + [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(12)))) for i in range(120)]
    docs += [(None, "a b c d"), (200, None), (201, ""), (202, " \n?"), (203, "y" * 5000 + " w1 w2"), (204, "w1 " * 3000), (-5, "A w1 w2")]
    return docs, ["w1 w2 w3", None, "", "Ärger a w1"]


def frames(spark):
    docs, target = corpus()
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame([(t,) for t in target], "text string"))


def test_equals_brute_force(spark):
    docs, target = corpus()
    frame, items = frames(spark)
    for percent, least in ((5, 2), (37, 0), (100, 3), (0, 1)):
        out = importance(frame, items, percent=percent, min_words=least, buckets=BUCKETS)
        got = sorted(str((*r[:4], r["rank"])) for r in out.collect())
        assert got == brute(docs, target, percent, least)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_repeated_rows_are_ranked_one_by_one(spark):
    rows = spark.createDataFrame([(7, "w1 w2")] * 6 + [(8, "w3 w4")] * 4, "doc_id long, text string")
    out = importance(rows, rows.limit(0), percent=70, min_words=1, buckets=BUCKETS).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == [1, 2, 3, 4, 5, 6, 7]


def test_empty_tables_and_clashes(spark):
    frame, items = frames(spark)
    assert importance(frame.limit(0), items).count() == 0
    assert importance(frame, items.limit(0)).count() == frame.count()
    odd = frame.select("doc_id", "text", F.lit(1).alias("rank"), F.lit(None).cast("string").alias("score"), F.lit(2).alias("__uid"))
    assert importance(odd, items, percent=50, min_words=0).filter("rank > 0").count() == frame.count() // 2


def test_resample_returns_the_drawn_rows(spark):
    frame, items = frames(spark)
    odd = frame.select("text", F.col("doc_id").alias("id"), F.length("text").alias("n_features"), F.lit("s").alias("weight"))
    odd = odd.unionByName(odd.filter("id IS NULL OR id < 10"))
    for percent in (0, 7, 50, 100):
        drawn = resample(odd, items, id_col="id", percent=percent, min_words=2, buckets=BUCKETS)
        ranks = importance(odd, items, id_col="id", percent=percent, min_words=2, buckets=BUCKETS)
        assert drawn.columns == odd.columns and drawn.schema["n_features"].dataType == odd.schema["n_features"].dataType
        got = sorted(str(r["id"]) for r in drawn.collect())
        assert got == sorted(str(r["doc_id"]) for r in ranks.filter("rank IS NOT NULL").collect())
    assert resample(odd.limit(0), items, id_col="id").count() == 0
