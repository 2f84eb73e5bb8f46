"""Operator 11 against both libraries on whole texts and plain loops over intervals."""
from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlake.llm import alignment
from adlake.llm.alignment import Block, align, coalesce, pair_counts, sides, stretches
from adlake.llm.tokens import VOCABULARY
from conftest import SF_SMALL


class Plain:
    """Unmodified encoders over whole texts."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))
        shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        hidden = [b for b in range(256) if b not in shown]
        self.byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}

    def tokens(self, text):
        if not text:
            return [], []
        a_ids = self.a.encode(" " + text, add_special_tokens=False).ids
        b_ids = self.b.encode(text)
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in a_ids]
        b = []
        for i in b_ids:
            piece = self.b.id_to_piece(i)
            raw = re.fullmatch("<0x(..)>", piece)
            b.append((i, bytes([int(raw[1], 16)]) if raw else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            return [], []
        return a, b

    def aligned(self, text):
        spans = []
        for tokens in self.tokens(text):
            at, side = 0, []
            for i, t in tokens:
                side.append((i, at, at + len(t)))
                at += len(t)
            spans.append(side)
        a, b = spans
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for high in ends:
            groups.append(",".join(str(i) for i, s, _ in a if low <= s < high) + "|" + ",".join(str(i) for i, s, _ in b if low <= s < high))
            low = high
        links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
        return len(a), len(b), groups, links

    def rows(self, docs):
        found = [(d, *self.aligned(t)) for d, t in docs]
        count = Counter(p for *_, links in found for p in set(links))
        top = {}
        for (a, _), n in count.items():
            top[a] = max(n, top.get(a, 0))
        return [(d, n_a, n_b, len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links),
                 hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for d, n_a, n_b, groups, links in found], count


PLAIN = Plain()


def corpus():
    rng = random.Random(11)
    bits = ["hello", "the", " ", "  ", "\n", "\t", "été", "naïve", "中文", "🙂", "　", "<s>", "</s>", "<0x41>", "<|endoftext|>", "x" * 70,
            "​", "᠎", "1234", "don't", ".", "é", "\x00", "tokenisation", "﻿", "a ", " b"]
    docs = [(k, "".join(rng.choices(bits, k=rng.randrange(1, 14)))) for k in range(250)]
    return docs + [(300, None), (301, ""), (302, " "), (303, "   "), (304, "a▁b c"), (None, "the hello"), (300, "the hello"),
                   (305, "one two  three\nfour " * 60), (306, "▁" + "long text " * 50), (307, "\n"), (308, "z" * 3000)]


def result(frame, **kw):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in names) for r in align(frame, **kw).collect()), key=repr)


def test_equals_brute_force(spark):
    docs = corpus()
    want, count = PLAIN.rows(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(frame) == sorted(want, key=repr)
    assert result(frame, block_bytes=200) == sorted(want, key=repr)
    assert {((r["a"], r["b"]), r["count"]) for r in pair_counts(frame).collect()} == set(count.items())


def test_given_documents(spark):
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.substring("text", 1, 1500).alias("text"))
    want, _ = PLAIN.rows([tuple(r) for r in frame.collect()])
    assert result(frame) == sorted(want, key=repr)


@pytest.mark.parametrize("size", [1, 5, 40])
def test_long_texts_are_aligned_in_stretches(size):
    held = sides(VOCABULARY, alignment.PIECES)
    for _, text in corpus():
        if text:
            assert " ".join(stretches(text, size)) == text
    texts = [t or "" for _, t in corpus()]
    whole, cut = Block(texts, held, True), Block(texts, held, True, align_bytes=50, stretch=size)
    assert [";".join(g) for g in whole.groups] == [";".join(g) for g in cut.groups]
    for x, y in zip(whole.pairs(), cut.pairs()):
        assert x.tolist() == y.tolist()
    assert (whole.n_links == cut.n_links).all() and (whole.n_groups == cut.n_groups).all()
    assert [d and d.hexdigest() for d in whole.digests] == [d and d.hexdigest() for d in cut.digests]


def test_coalesce_by_hand():
    import numpy as np
    found = coalesce(np.array([2, 3, 1, 4]), np.array([5, 2, 3]))
    assert found.a_group.tolist() == [0, 0, 1, 1] and found.b_group.tolist() == [0, 1, 1]
    assert list(zip(found.a_linked.tolist(), found.b_linked.tolist())) == [(0, 0), (1, 0), (2, 1), (3, 1), (3, 2)]


def test_groups_carry_clashes_and_empty(spark):
    frame = spark.createDataFrame([(1, "the hello", "k"), (2, None, None)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in align(frame, with_groups=True, carry=("source",)).collect()}
    assert got[1]["groups"] == ";".join(PLAIN.aligned("the hello")[2]) and got[1]["source"] == "k"
    assert got[2]["groups"] == "" and got[2]["groups_sha256"] == "" and got[2]["source"] is None
    assert align(frame.limit(0)).count() == 0 and pair_counts(frame.limit(0)).count() == 0
    clash = frame.select("doc_id", "text", F.lit(1).alias("n_links"), F.lit(2).alias("__block"))
    assert align(clash).count() == 2
    with pytest.raises(ValueError, match="n_links"):
        align(clash, carry=("n_links",))
