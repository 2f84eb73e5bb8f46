from __future__ import annotations

import numpy as np
import pytest
from tokenizers import Tokenizer

from adlake.llm.token_counts import block_lengths, count_tokens, scan, write_streams
from adlake.llm.tokens import vocabulary_paths
from adlake.session import scratch_path

TEXTS = ["", "a", "one two three", None, "! <|endoftext|> !", "word " * 9000, "é漢🙂", "x\n\ny"] + [f"text {i} " * (i % 17) for i in range(60)]


@pytest.fixture(scope="module")
def lengths():
    t = Tokenizer.from_file(vocabulary_paths()[0])
    t.encode_special_tokens = True
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in TEXTS]


def test_block_lengths_stitch_blocks():
    rng = np.random.default_rng(1)
    for _ in range(200):
        ids = rng.integers(0, 4, rng.integers(0, 50)).astype("<u2")
        ends = [k for k, v in enumerate(ids) if v == 3]
        want = [b - a - 1 for a, b in zip([-1, *ends], ends)]
        got, tail = block_lengths(ids, 3, 7)
        assert got.tolist() == want and tail == len(ids) - (ends[-1] + 1 if ends else 0)


@pytest.mark.parametrize("file_ids", [4 * 1024 * 1024, 100, 3])
def test_counts_whatever_the_file_size(spark, tmp_path, lengths, file_ids):
    """Files of 3 ids make most documents span many files."""
    rows = [(i if i % 9 else None, t, i) for i, t in enumerate(TEXTS if file_ids > 3 else TEXTS[:5] + TEXTS[6:20])]
    want = [(i, n) for (i, _, _), n in zip(rows, lengths if file_ids > 3 else lengths[:5] + lengths[6:20])]
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(4).write.parquet(f"{tmp_path}/d")
    got = count_tokens(spark.read.parquet(f"{tmp_path}/d"), file_ids=file_ids).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_unclosed_document(spark):
    path = scratch_path(spark, "streams")
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string").coalesce(1)
    write_streams(docs, path)
    closed = scan(spark, path).collect()
    cut = scan(spark, path, end_id=60000).collect()
    assert [(r.document, r.n_tokens, r.complete) for r in closed] == [(0, 3, True)]
    assert [(r.document, r.n_tokens, r.complete) for r in cut] == [(0, 4, False)]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e")
    assert count_tokens(spark.read.parquet(f"{tmp_path}/e")).collect() == []
