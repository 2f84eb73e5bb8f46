from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from adlake.llm.packing import pack, piece_lengths
from adlake.llm.tokens import encoder, vocabulary_paths

TEXTS = ["", "a", " ", "  ", "a  b", "a \n b", "x\n y", "x\n\n  y \t", " lead", "tail ", "it's we're 's", "don 't ' t", "a" * 3000,
         "naïve Ünïcode ñandú", "漢字 かな 한국어", "a\u00a0b \u00a0c", "\u200b \u200b", "1234 5678 90", "!!! ?? ,,, a,b", "🙂 🙂🙂 a🙂",
         "<|endoftext|> x <|endoftext|>", "\r\n \r\n", "\x1c \x1d x", "\u180e x \u180e", "a\u2003 b", "word " * 5000, "́ combining é",
         "ʼn ǅ ᾳ ⅷ ② ٣ 𝟘"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(vocabulary_paths()[0])
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizer_files(reference):
    encode = encoder()
    for _ in range(2):  # from the cache too
        for text in TEXTS:
            assert np.frombuffer(encode(text), "<u4").tolist() == reference(text), repr(text[:40])


def test_ids_equal_on_random_mixes(reference):
    import random
    rng = random.Random(7)
    parts = ["a", "Wort", " ", "  ", "\n", "\t", "'s", "'", "12", "é", "漢", ".", "!!", "\u00a0", "🙂", "\u200b", "\u0301"]
    encode = encoder()
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encode(text), "<u4").tolist() == reference(text), repr(text)


def test_piece_lengths():
    assert piece_lengths(2600) == [1024, 1024, 512, 32, 8]
    for n in range(1, 3000):
        assert sum(piece_lengths(n)) == n and all(p & (p - 1) == 0 and p <= 1024 for p in piece_lengths(n))


def test_pieces_rebuild_documents(spark, reference):
    rows = list(enumerate(TEXTS)) + [(100, None), (None, "no id"), (3, TEXTS[3])]
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, length int")
    got = pack(docs).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    by_doc = {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length == r.bucket and r.offset == 0 and zlib.crc32(r.ids) == r.ids_crc32
        by_doc.setdefault(r.doc_id, []).append((r.start, ids.tolist(), r.doc_tokens))
    want = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, []).append(reference(text or "") + [0])
    for doc_id, lists in want.items():
        pieces = sorted(by_doc[doc_id])
        if len(lists) == 1:
            assert [x for _, ids, _ in pieces for x in ids] == lists[0]
            assert {n for _, _, n in pieces} == {len(lists[0])}
        else:
            assert sum(len(ids) for _, ids, _ in pieces) == sum(map(len, lists))


def test_empty_and_bad_length(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([], "doc_id long, text string"), max_length=1000)


def test_added_tokens_as_the_unmodified_tokenizer_gives_them(spark):
    plain = Tokenizer.from_file(vocabulary_paths()[0])
    texts = [*TEXTS, "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|>", "<|endoftext|", " <|endoftext|>\n\n y é漢<|endoftext|> z"]
    want = {k: plain.encode(t, add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    assert want[len(TEXTS)] == [64, 220, 50256, 275, 0]
    got = {}
    for r in pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), added_tokens=True).collect():
        got.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert {k: [x for _, ids in sorted(v) for x in ids] for k, v in got.items()} == want


def test_query_and_pipeline_use_added_tokens(spark, tmp_path):
    import corpus_pipeline
    from adlake.llm.queries import op2_packing
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = zlib.crc32(np.array([64, 220, 50256, 275], "<u4").tobytes())
    for got in (op2_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, docs, str(tmp_path))):
        assert [(r.length, r.doc_tokens) for r in got.collect()] == [(4, 5), (1, 5)]
        assert {r.ids_crc32 for r in got.collect() if r.length == 4} == {want}
