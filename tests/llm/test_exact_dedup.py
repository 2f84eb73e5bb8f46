from __future__ import annotations

import hashlib
import re

import pytest

from adlake.llm.exact_dedup import drop_duplicates, mark_duplicates


def brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append((doc_id is None, doc_id or 0, i))
    out = []
    for norm, members in groups.items():
        first = min(members)
        keep = None if first[0] else first[1]
        for m in members:
            out.append((None if m[0] else m[1], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [(3, "a  b"), (1, "a\tb"), (2, "a b"), (5, " a b"), (7, None), (6, ""), (9, "x\x0b\x0cy"), (8, "x y"), (4, "x y"),
        (None, "a b"), (None, "only"), (11, "rep"), (11, "rep"), (12, "long " * 50_000), (13, "long  " * 50_000), (14, "é")]


def test_matches_brute_force(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = mark_duplicates(docs).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == brute(ROWS)
    per_text = {}
    for r in got:
        per_text[r.text_sha256] = per_text.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(per_text.values()) == {1}  # repeated rows and null ids too


def test_keeps_own_columns_whatever_their_names(spark):
    docs = spark.createDataFrame([(2, "a b", 1, "x"), (1, "a  b", 2, "y"), (3, "c", 3, None)],
                                 "doc_id long, text string, kept int, `__norm` string")
    got = drop_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(1, "a  b", 2, "y"), (3, "c", 3, None)]
    with pytest.raises(ValueError):
        mark_duplicates(docs, carry=("kept",))


def test_empty_table(spark):
    assert mark_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_hash_collisions_stay_apart(spark, monkeypatch):
    """With a hash that always collides, the comparison of bytes still tells texts apart."""
    from pyspark.sql import functions as F
    import adlake.llm.exact_dedup as op
    monkeypatch.setattr(op.F, "md5", lambda c: F.lit("00"))
    rows = [(1, "a"), (2, "b"), (3, "a")]
    got = op.mark_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.keep_id) for r in got.collect()) == [(1, 1), (2, 2), (3, 1)]


def test_main_path_is_native(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = mark_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
