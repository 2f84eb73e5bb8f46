"""The pipeline's stages against plain Python on a small table, and the registry."""
from __future__ import annotations

import re

import numpy as np
import pytest
from test_decontaminate import brute as brute_hits
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from adlake.llm.language_id import fit
from adlake.llm.tokens import vocabulary_paths

SF = "/root/testdata/sf0.001"


def test_registry():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        docs = corpus_pipeline.materialize(docs, "test-stage")
        out.append((before, before.collect(), docs, docs.collect()))
    return out


def test_columns_of_documents_stay(stages):
    for before, _, after, _ in stages[:4]:
        assert after.dtypes == before.dtypes


def test_language_stage(spark, stages):
    before, rows, _, kept = stages[0]
    model = fit(before)
    want = [r.doc_id for r, accepted in zip(rows, model.judge([r.text or "" for r in rows])[3]) if accepted]
    assert sorted(r.doc_id for r in kept) == sorted(want) and len(kept) >= 0.97 * len(rows)


def test_exact_stage(stages):
    _, rows, _, kept = stages[1]
    first = {}
    for r in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        first[norm] = min(first.get(norm, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in kept) == sorted(first.values())


def test_near_stage(stages):
    _, rows, _, kept = stages[2]
    prints = {r.doc_id: brute_fingerprint(r.text or "") for r in rows}
    roots = brute_components(sorted(set(prints.values())), 4)
    first = {}
    for i, x in prints.items():
        first[roots[x]] = min(first.get(roots[x], i), i)
    assert sorted(r.doc_id for r in kept) == sorted(first.values())


def test_decontamination_stage(spark, stages):
    _, rows, _, kept = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    after = {r.doc_id: r.text for r in kept}
    for r in rows:
        n, hit, _ = brute_hits(r.text, items, 10)
        if n and hit > 0.5 * n:
            assert r.doc_id not in after
        else:
            assert (after[r.doc_id] == r.text) == (hit == 0) and brute_hits(after[r.doc_id], items, 10)[1] == 0


def test_packing_stage(stages):
    _, rows, _, pieces = stages[4]
    t = Tokenizer.from_file(vocabulary_paths()[0])
    t.encode_special_tokens = True
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.ids))
    for r in rows:
        ids = np.frombuffer(b"".join(b for _, b in sorted(by_doc[r.doc_id])), "<u4").tolist()
        assert ids == t.encode(r.text or "", add_special_tokens=False).ids + [0]


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    want = stages[-1][2]
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_nulls_repeats_and_clashing_columns(spark, tmp_path):
    """Odd rows and columns that have inner names go through every stage with defined results."""
    from pyspark.sql import functions as F
    given = spark.read.parquet(f"{SF}/documents.parquet")
    first = given.orderBy("doc_id").first()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter(F.size(F.split("text", " ")) > 12).orderBy("item_id").first()
    long = " ".join(r.text or "" for r in given.filter(F.col("lang") == first.lang).orderBy("doc_id").limit(60).collect())
    rows = [(90001, None, None, "s", None), (90002, "", "en", "s", 0), (90003, " 12 !", None, "s", 5), (None, first.text, None, None, None),
            (first.doc_id, first.text, first.lang, first.source, first.n_chars), (90004, long, first.lang, "s", len(long)),
            (90005, item.text, None, "s", 1)]
    odd = given.unionByName(spark.createDataFrame(rows, given.schema))
    clash = {"kept": F.lit("k"), "component_id": F.col("doc_id"), "__text": F.lit(None).cast("string"), "__cut": F.lit(1), "__uid": F.lit("u"),
             "keep_id": F.lit(2.5), "fingerprint": F.lit("f"), "lang_pred": F.lit("x")}
    odd.withColumns(clash).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), "odd-stage")
        assert docs.columns == columns and docs.filter("kept <> 'k' OR __cut <> 1 OR __text IS NOT NULL").isEmpty()
        kept.append([r.doc_id for r in docs.select("doc_id").collect()])
    assert not {90001, 90002, 90003} & set(kept[0])  # no letters, no language
    assert kept[0].count(first.doc_id) == 2 and None in kept[0] and 90004 in kept[0]
    assert kept[1].count(first.doc_id) == 1 and None not in kept[1]  # the null id is a copy of the first
    assert 90005 not in kept[3]  # nothing but a benchmark item
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(kept[3])
    plain = spark.read.parquet(f"{tmp_path}/documents.parquet").drop(*clash)
    plain.write.parquet(f"{tmp_path}/plain/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/plain/benchmark.parquet")
    want = corpus_pipeline.run(spark, f"{tmp_path}/plain").select("doc_id", "start", "length", "ids_crc32")
    assert sorted(map(tuple, pieces.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
