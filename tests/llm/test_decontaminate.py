from __future__ import annotations

import hashlib
import random
import re

import pytest

from adlake.llm.decontaminate import Automaton, Scanner, decontaminate, report, words_of


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, window):
    doc, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(window, len(w))
        if n:
            windows = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
            for k in range(len(doc) - n + 1):
                if tuple(doc[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found.add(item)
    return len(doc), len(hit), found


def test_words():
    for text in ["", "Ab-c_D9 é x\x7fy", "ÀB's 漢字 \x00z", "A`b{c}", "ß.ß"]:
        assert [w.decode() for w in words_of(text.encode())] == words(text)


@pytest.mark.parametrize("seed", range(12))
def test_automaton_matches_brute_force(seed):
    rng = random.Random(seed)
    letters = "abc" if seed % 2 else "abcdefg"
    window = rng.choice([1, 2, 3, 5])
    items = [(k, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))) for k in range(rng.randint(0, 8))]
    texts = [" ".join(rng.choice(letters + "xy") for _ in range(rng.randint(0, 60))) for _ in range(20)]
    scanner = Scanner([[(k, words_of(t.encode())) for k, t in items]], window)
    hits, found = scanner([words_of(t.encode()) for t in texts])
    for text, hit, items_found in zip(texts, hits, found):
        assert (len(hit), int(hit.sum()), items_found) == brute(text, items, window)


def test_automaton_size_is_linear():
    a = Automaton([(k, [b"%d" % ((7 * i + k) % 50) for i in range(200)]) for k in range(10)], 10)
    assert len(a.link) <= 2 * 2000 + 1


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefghi") for _ in range(rng.randint(1, 5)))
    items = [(k, " ".join(word() for _ in range(rng.choice([4, 9, 10, 25])))) for k in range(14)]
    items += [(90, None), (91, "--"), (None, "an item that has no id but has more than ten words in it"), (92, items[3][1]), (9, items[3][1])]
    docs = []
    for k in range(60):
        text = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            part = words(rng.choice(items)[1])
            a, b = sorted((rng.randint(0, len(part)), rng.randint(0, len(part))))
            at = rng.randint(0, len(text))
            text[at:at] = part if rng.random() < 0.6 else part[a:b]
        docs.append((k, ", ".join(w.upper() if rng.random() < 0.2 else w for w in text)))
    return items, docs + [(60, None), (61, ""), (None, docs[4][1]), (4, docs[4][1]), (62, "zz " * 50_000 + items[3][1] + " zz" * 9)]


@pytest.mark.parametrize("shard_words", [150_000, 30])
def test_report_matches_brute_force(spark, shard_words):
    items, docs = corpus(random.Random(4))
    got = report(spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_hit int"),
                 spark.createDataFrame(items, "item_id long, text string"), shard_words=shard_words).collect()
    want = []
    for i, t in docs:
        n, hit, found = brute(t, items, 10)
        names = ",".join(sorted("" if f is None else str(f) for f in found))
        want.append((i, n, hit, len(found), hashlib.sha256(names.encode()).hexdigest(), hit > 0))
    assert sorted([tuple(r)[:6] for r in got], key=repr) == sorted(want, key=repr)
    assert any(w[2] for w in want) and not all(w[2] for w in want)


def test_cleaned_texts_hold_no_window(spark):
    items, docs = corpus(random.Random(6))
    bench = spark.createDataFrame(items, "item_id long, text string")
    source = spark.createDataFrame([(i, t, len(t or ""), "s") for i, t in docs], "doc_id long, text string, n_chars long, `__cut` string")
    got = decontaminate(source, bench)
    assert got.columns == source.columns
    rows, dropped = got.collect(), 0
    kept = {}
    for r in rows:
        kept.setdefault(r.doc_id, []).append(r)
    for i, t in docs:
        n, hit, _ = brute(t, items, 10)
        if n and hit > 0.5 * n:
            assert i not in kept
            dropped += 1
        else:
            for r in kept[i]:
                assert brute(r.text, items, 10)[1] == 0
                assert hit or r.text == t
                assert r.n_chars == len(r.text or "")
    assert dropped and any(r.text != dict(docs)[r.doc_id] for r in rows if r.doc_id is not None)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r)[:4] for r in report(docs, none).collect()] == [(1, 2, 0, 0)]
    assert decontaminate(docs, none).collect() == docs.collect()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert report(empty, none).collect() == [] and decontaminate(empty, none).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_shards_share_a_vocabulary(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 2, 4])
    items = [(k, [b"%d" % rng.randrange(6) for _ in range(rng.randint(0, 9))]) for k in range(12)]
    documents = [[b"%d" % rng.randrange(8) for _ in range(rng.randint(0, 50))] for _ in range(15)]
    hits, found = Scanner([items], window)(documents)
    for size in (1, 3, 5):
        split_hits, split_found = Scanner([items[k:k + size] for k in range(0, 12, size)], window)(documents)
        assert [h.tolist() for h in hits] == [h.tolist() for h in split_hits] and found == split_found


def test_each_shard_is_built_once(monkeypatch):
    from adlake.llm import decontaminate as module
    built, plain = [], module.Automaton.__init__
    monkeypatch.setattr(module.Automaton, "__init__", lambda self, *a: (built.append(1), plain(self, *a))[1])
    items = [(k, [b"%d" % (100 * k + i) for i in range(30)]) for k in range(40)]
    scanner = Scanner([items[:10], items[10:20], items[20:30], items[30:]], 10)
    for k in range(6):
        hits, found = scanner([[b"x", *items[k][1], b"y"], *(w for _, w in items)])
        assert found[0] == {k} and hits[0].sum() == 30
        assert scanner.clean(b"x " + b" ".join(items[k][1]) + b" y").split() == [b"x", b"y"]
    assert len(built) == 4


def test_shards_cost_no_rescan():
    """Five documents of benchmark words with 1 and with 8 shards: the same lookups, so about the same time."""
    import time
    rng = random.Random(2)
    items = [(k, [b"w%d" % rng.randrange(3000) for _ in range(40)]) for k in range(1600)]
    documents = [[b"w%d" % rng.randrange(6000) for _ in range(60_000)] + items[k][1] for k in range(5)]
    seconds = {}
    for shards in (1, 8):
        scanner = Scanner([items[k::shards] for k in range(shards)], 10)
        scanner([[]])
        start = time.perf_counter()
        for _ in range(3):
            _, found = scanner(documents)
        seconds[shards] = time.perf_counter() - start
        assert all(k in f for k, f in enumerate(found))
    assert seconds[8] < 3 * seconds[1] + 0.5


def test_automaton_is_flat():
    a = Automaton([(k, [b"%d" % ((11 * i + k * i) % 997) for i in range(500)]) for k in range(20)], 10)
    flat = (a.first, a.words, a.targets, a.link, a.length, a.anchor, a.short, a.found, a.whole)
    assert sum(len(v) * v.itemsize for v in flat) < 110 * 20 * 500
