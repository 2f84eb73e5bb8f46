from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from adlake.llm import language_id as lang
from adlake.llm.language_id import fit, identify, keep_identified, subwords, train

SYLLABLES = {"aa": "ba be bi bo".split(), "bb": "ku ke ki zu".split(), "cc": "schl ung ei tz".split()}


def text(rng, name, n):
    return " ".join("".join(rng.choice(SYLLABLES[name]) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize()


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    names = [rng.choice(list(SYLLABLES)) for _ in range(150)]
    return train([text(rng, n, rng.choice([2, 20, 80])) for n in names], names)


def brute_subwords(text):
    """Words with marked edges, cut into n-grams of 2 to 4 characters."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return sum(max(0, len(w) + 2 - n + 1) for w in words for n in (2, 3, 4))


@pytest.mark.parametrize("sample", ["", "a", "ab c", "Ä-b 12 c!", "İstanbul ǅ x", "  lead", "漢字 かな", "a\nb\n\n"])
def test_subword_counts(sample):
    rows, owner = subwords(["zz", sample, "", "yy"])
    assert np.bincount(owner, minlength=4).tolist() == [brute_subwords(t) for t in ("zz", sample, "", "yy")]
    assert (np.diff(owner) >= 0).all()


def test_texts_do_not_influence_each_other(model):
    rng = random.Random(2)
    texts = [text(rng, rng.choice(list(SYLLABLES)), n) for n in (1, 5, 50, 3)] + ["", "12", "x"]
    together = model.predict(texts)
    for k, t in enumerate(texts):
        alone = model.predict([t])
        assert together[0][k] == alone[0][0] and together[1][k] == pytest.approx(alone[1][0])


def test_long_texts_in_pieces(model, monkeypatch):
    rng = random.Random(6)
    texts = [text(rng, rng.choice(list(SYLLABLES)), n) for n in (1, 400, 3, 90)] + ["", "x" * 300, "-" * 90 + "ba be " * 30]
    whole = model.logits(texts)
    monkeypatch.setattr(lang, "PIECE_CHARS", 50)
    parts = model.logits(texts)
    same = [k for k in range(len(texts)) if k != 5]  # a word without a gap is cut anywhere
    assert np.allclose(whole[0][same], parts[0][same]) and (whole[1] == parts[1]).all()


def test_held_out_accuracy(model):
    rng = random.Random(3)
    names = [rng.choice(list(SYLLABLES)) for _ in range(300)]
    best, score, known = model.predict([text(rng, n, rng.choice([1, 5, 60])) for n in names])
    right = np.array([model.languages[b] == n for b, n in zip(best, names)])
    assert right.mean() > 0.98 and known.all() and (score >= model.level).mean() > 0.97


def test_unseen_scripts_are_rejected(model):
    _, score, known = model.predict(["漢字かな交じり文 " * 20, "Это русский текст"])
    assert known.all() and (score < model.level).all()


def documents(rng, n=240):
    rows = []
    for k in range(n):
        name = rng.choice(list(SYLLABLES))
        rows.append((k, text(rng, name, rng.choice([3, 40])), name if rng.random() < 0.9 else None, "s", 7))
    return rows


def test_query_columns_and_edges(spark):
    rows = documents(random.Random(4)) + [(1000, None, "aa", "s", 0), (1001, "12 !", "aa", "s", 0), (None, "baba bebe bibi", "aa", "s", 0),
                                          (3, "kuku keke zuku", "bb", "s", 0), (1002, "ba be " * 50_000, "aa", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, lang_pred int")
    found = identify(docs, fit(docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in found}
    assert by_id[1000].lang_pred == by_id[1001].lang_pred == "und" and by_id[1000].score == 0
    assert by_id[None].lang_pred == "aa" and by_id[1002].lang_pred == "aa"
    truth = {r[0]: r[2] for r in rows if r[2] and r[0] not in (None, 3, 1000, 1001)}
    held = [by_id[i].lang_pred == name for i, name in truth.items() if by_id[i].held_out]
    assert len(held) > 40 and sum(held) >= 0.98 * len(held)


def test_held_out_and_unlabelled_rows_are_not_learned_from(spark):
    rows = documents(random.Random(5))
    wrong = [(i, t, "wrong" if zlib.crc32(str(i).encode()) % 3 == 1 else n, s, x) for i, t, n, s, x in rows]
    docs = spark.createDataFrame(wrong, "doc_id long, text string, lang string, source string, n_chars int")
    assert "wrong" not in fit(docs).languages


def test_keep_identified(spark, model):
    docs = spark.createDataFrame([(1, "baba bebe", "x"), (2, None, "y"), (3, "123", None), (4, "kuku kezu", "z")],
                                 "doc_id long, text string, `__text` string")
    kept = keep_identified(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert fit(empty) is None and identify(empty, None).collect() == []
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert fit(docs) is None
    assert [(r.lang_pred, r.score) for r in identify(docs, None).collect()] == [("und", 0.0)]


def test_sample_is_bounded(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(lang, "train", lambda texts, names: taken.append((texts, names)))
    rows = [(k, "ba be bi " * 2000, "aa") for k in range(300)]
    fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=20)
    texts, _ = taken[0]
    assert 0 < len(texts) < 60 and max(len(t.split()) for t in texts) <= lang.SAMPLE_WORDS


@pytest.mark.parametrize("count", [1, 499, 501, 400_000_000, 500_001_000, 10 ** 13])
def test_sample_share_at_every_count(count):
    share = (lang.last_place(count, 500) + 1) / 2 ** 63
    assert share * count == pytest.approx(min(count, 500), rel=1e-6)


def test_sample_of_less_than_a_millionth(spark, monkeypatch):
    from pyspark.sql import functions as F
    taken = []
    monkeypatch.setattr(lang, "train", lambda texts, names: taken.append(texts))
    docs = spark.range(20_000_000).select(F.col("id").alias("doc_id"), F.lit("ba be").alias("text"), F.lit("aa").alias("lang"))
    fit(docs, sample_docs=10)
    assert taken and 1 <= len(taken[0]) <= 40


def test_every_label_is_learned(spark):
    rng = random.Random(8)
    names = [f"l{k:02}" for k in range(80)]
    own = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)] for n in names}
    rows = [(k, " ".join(rng.choices(own[n], k=20)), n) for k, n in enumerate(names * 40)]
    rare = [(-k, " ".join(["qxqx zyzy"] * 9), "rare") for k in range(1, 40) if zlib.crc32(str(-k).encode()) % 3 != 1][:1]
    model = fit(spark.createDataFrame(rows + rare, "doc_id long, text string, lang string"))
    assert model.languages == [*names, "rare"]
    best, _, _ = model.predict([t for _, t, _ in rows])
    assert np.mean([model.languages[b] == n for b, (_, _, n) in zip(best, rows)]) > 0.9


def test_sample_of_many_languages():
    assert lang.sample_sizes(1) == lang.sample_sizes(4) == lang.sample_sizes(32) == (500, 10)
    assert lang.sample_sizes(64) == (250, 10) and lang.sample_sizes(800) == (40, 5) and lang.sample_sizes(100_000) == (40, 1)
    assert lang.sample_sizes(4, 20) == (20, 10)


def test_sample_is_bounded_in_characters_and_repeated_rows(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(lang, "train", lambda texts, names: taken.append(texts))
    blob = "".join(chr(0x4E00 + k % 9000) for k in range(200_000))
    rows = [(k, "x " * 20 + blob[k:], "aa") for k in range(6)] + [(9, "ba be", "aa")] * 500 + [(9, "bi bo", "aa")]
    fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    most = (lang.STRETCH_CHARS + 1) * (lang.SAMPLE_WORDS // lang.STRETCH)
    texts = taken[0]
    long = [t for t in texts if len(t) > 5]
    assert long and max(map(len, long)) <= most and all(len(set(t)) > 1000 for t in long)
    assert sorted(t for t in texts if len(t) <= 5) == ["ba be", "bi bo"]


@pytest.mark.parametrize("left_out", list(SYLLABLES))
def test_a_label_left_out_is_rejected(left_out):
    rng = random.Random(9)
    use = [n for n in SYLLABLES if n != left_out]
    names = [rng.choice(use) for _ in range(200)]
    model = train([text(rng, n, rng.choice([5, 20, 80])) for n in names], names)
    foreign = model.judge([text(rng, left_out, 40) for _ in range(100)])[3]
    known = model.judge([text(rng, rng.choice(use), rng.choice([5, 40])) for _ in range(300)])[3]
    assert foreign.mean() < 0.1 and known.mean() >= 0.97


def test_languages_of_the_given_documents_left_out():
    """With any one label unlearned most of its documents are rejected, and few of the others."""
    import duckdb
    rows = duckdb.sql("SELECT doc_id, text, lang FROM '/root/testdata/sf0.1/documents.parquet' WHERE lang IS NOT NULL AND text IS NOT NULL").fetchall()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    for left_out in (None, *sorted({r[2] for r in rows})):
        by = {}
        for i, t, n in rows:
            if zlib.crc32(str(i).encode()) % 3 != 1 and n != left_out and len(by.setdefault(n, [])) < lang.SAMPLE_DOCS:
                by[n].append(" ".join(t.split()[:lang.SAMPLE_WORDS])[:6000])
        model = train([t for texts in by.values() for t in texts], [n for n, texts in by.items() for _ in texts])
        accepted = model.judge([r[1] for r in held])[3]
        out = np.array([r[2] == left_out for r in held])
        assert (~accepted[~out]).mean() < 0.015
        assert not out.any() or accepted[out].mean() < 0.25


def test_strangeness_of_short_texts(model):
    unseen, n = np.array([0, 1, 4, 9, 100]), np.array([10, 10, 10, 10, 200])
    assert lang.strangeness(unseen, n).tolist() == [0, 0, 0, 0.3, 0.4]
    assert lang.strangeness(np.array([0]), np.array([0])).tolist() == [0]


def test_what_one_label_showed_counts_as_unseen_without_it(model):
    for k, name in enumerate(model.languages):
        words = " ".join(text(random.Random(k), name, 30) for _ in range(3))
        _, n, unseen = model._read([words, words], [0, k + 1])
        assert unseen[0] < 0.02 * n[0] and unseen[1] > 0.2 * n[1]
