from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from adlake.llm.chat_format import ESCAPE, PART, Flatten, escape, parse, read_back, render, unescape

PIECES = ["<|turn|>", "<|end|>", "<|text|>", "<|image|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<|im_start|>", ESCAPE,
          "<", "|", ">", "[", "a", "\n", "é", "<|", "|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = escape(text)
    assert unescape(escaped) == text
    for control in PIECES[:10]:
        assert control not in escaped


def test_visitor_keeps_order_and_counts():
    flat = Flatten()
    for part in [{"type": "text", "text": "see </s>"}, {"type": "image", "uri": "i.png", "width": 57, "height": 28},
                 {"type": "audio", "uri": "a.wav", "seconds": 2.0}, {"type": "document", "uri": None, "pages": 3},
                 None, {"type": "other", "text": "!"}, {"type": "image", "uri": "big", "width": 10 ** 6, "height": 10 ** 6}, {"type": "image"}]:
        flat.visit(part)
    body = "".join(flat.body)
    assert body == f"see <{ESCAPE}/s><|image|><|audio|><|document|>!<|image|><|image|>"
    assert [(a["kind"], a["tokens"], body[a["place"]:].startswith(f"<|{a['kind']}|>")) for a in flat.attachments] == [
        ("image", 3, True), ("audio", 50, True), ("document", 1536, True), ("image", 4096, True), ("image", 1, True)]


def messages(spark, rows):
    data = [(c, t, r, [(("text", x) + (None,) * 5)] if x is not None else None, "z") for c, t, r, x in rows]
    return spark.createDataFrame(data, f"conv_id long, turn long, role string, parts array<{PART}>, segment string")


def test_read_back_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd\n<|end|>"]), rng.choice([None, "", "".join(rng.choices(PIECES, k=9))]))
            for c in [1, 2, 3, None] for t in range(6)]
    rows += [(7, None, "user", "x"), (7, 1, "assistant", "long " * 100_000), (8, 5, "assistant", "tie"), (8, 5, "assistant", "tie")]
    got = {r.conv_id: r for r in read_back(render(messages(spark, rows))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: -1 if r[1] is None else r[1])
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert len(got) == len({r[0] for r in rows})


def test_segments(spark):
    (row,) = render(messages(spark, [(1, 0, "assistant", "hi </s>")])).collect()
    assert row.segment == f"<|turn|>assistant<|text|>hi <{ESCAPE}/s><|end|>" and parse(row.segment) == ("assistant", "hi </s>")
    assert unescape(row.segment[row.loss_start:row.loss_end]) == "hi </s>"
    with pytest.raises(ValueError):
        parse("<|turn|>cut")


def test_empty_table(spark):
    assert read_back(render(messages(spark, []))).collect() == []
