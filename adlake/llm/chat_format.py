"""Operator 3: chat formatting of typed content parts.

A message is a role and a list of parts: text, image, audio or document. A visitor flattens
them in order: text is escaped and written out, every other part becomes a placeholder, its
reference is recorded with its place in the text and the tokens that it will expand to.

The template writes each turn as ``<|turn|>role<|text|>body<|end|>``. Control strings inside
texts and roles (those of this template and of common others) get an escape character after
their first character, and the escape character itself is doubled. So no control string is
left in a text, and reading back is exact. The loss mask covers the body of assistant turns.

Scale: formatting is one pass without a shuffle, a row per turn. Digests of conversations
need their turns in order, so rows are dealt by conversation, sorted inside the partition
(Spark spills) and streamed: a task holds one turn at a time however long a conversation is.
"""
from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adlake.llm.common import slices

ESCAPE = "\u241b"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Tokens that attachments expand to: a 14-pixel patch grid merged 2 x 2, audio frames, pages.
PATCH, MAX_PATCHES, AUDIO_FRAMES_PER_SECOND, TOKENS_PER_PAGE = 28, 4096, 25, 512
#: Control strings of this and other templates, in a form that RE2 and Python share.
CONTROL = r"<\|[^|<>\n]{1,40}\|>|</?s>|\[/?INST\]|<</?SYS>>"
_ESCAPED = re.compile(f"{ESCAPE}|(?:(?={CONTROL}).)")
_UNESCAPED = re.compile(f"{ESCAPE}(.?)", re.S)
_SEGMENT = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*){re.escape(END)}", re.S)
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENTS = "array<struct<kind:string,uri:string,place:int,tokens:long>>"


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group() + ESCAPE, text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(lambda m: ESCAPE if m.group(1) == ESCAPE else m.group(1), text)


class Flatten:
    """Visits the parts of one message in order. ``visit_<type>`` per type of part; a part of
    another type, or null, is text. Missing sizes count as the smallest attachment."""

    def __init__(self):
        self.body, self.attachments, self.length = [], [], 0

    def visit(self, part: dict | None) -> None:
        part = part or {}
        getattr(self, f"visit_{part.get('type')}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (max(1, math.ceil((part.get(side) or 1) / PATCH)) for side in ("width", "height"))
        self._attach("image", part, min(across * down, MAX_PATCHES))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * AUDIO_FRAMES_PER_SECOND)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 1) * TOKENS_PER_PAGE)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "uri": part.get("uri"), "place": self.length, "tokens": tokens})
        self._write(f"<|{kind}|>")

    def _write(self, text: str) -> None:
        self.body.append(text)
        self.length += len(text)


def render(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           parts_col: str = "parts") -> DataFrame:
    """One row per turn: conv_id, turn, segment, loss_start, loss_end, attachments, expanded_tokens.

    ``segment`` is the turn's text in the template; a conversation's output is its segments by
    turn (ties by segment). The mask is segment[loss_start:loss_end] in code points, empty for other roles
    than ``assistant``. A null role, part, part list or text counts as empty; null ids and turns
    stay null and sort first; repeated rows are repeated turns. Other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "role"):
            out = []
            for role, parts in zip(part.column("role").to_pylist(), part.column("parts").to_pylist()):
                flat = Flatten()
                for p in parts or ():
                    flat.visit(p)
                head = f"{TURN}{escape(role)}{TEXT}"
                start = len(head)
                end = start + flat.length if role == "assistant" else start
                places = [a | {"place": a["place"] + start} for a in flat.attachments]
                out.append(("".join([head, *flat.body, END]), start, end, places, sum(a["tokens"] for a in places)))
            segment, start, end, places, tokens = zip(*out) if out else [()] * 5
            attachment = pa.struct([("kind", pa.string()), ("uri", pa.string()), ("place", pa.int32()), ("tokens", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [part.column("conv_id"), part.column("turn"), pa.array(segment, pa.string()), pa.array(start, pa.int32()),
                 pa.array(end, pa.int32()), pa.array(places, pa.list_(attachment)), pa.array(tokens, pa.int64())],
                names=["conv_id", "turn", "segment", "loss_start", "loss_end", "attachments", "expanded_tokens"])

    source = messages.select(messages[conv_col].cast("long").alias("conv_id"), messages[turn_col].cast("long").alias("turn"),
                             F.coalesce(messages[role_col].cast("string"), F.lit("")).alias("role"),
                             messages[parts_col].cast(f"array<{PART}>").alias("parts"))
    return source.mapInArrow(run, "conv_id long, turn long, segment string, loss_start int, loss_end int, "
                                  f"attachments {ATTACHMENTS}, expanded_tokens long")


def parse(segment: str) -> tuple[str, str]:
    """Role and body text of one segment; raises ValueError for text outside the template."""
    found = _SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError("not a turn of this template")
    return unescape(found.group(1)), unescape(found.group(2))


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, from its segments alone: turns, digest of role and text of each turn,
    and length and digest of the text under the loss mask; and the output's length.

    A null conv_id is a conversation of its own. An empty table gives an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out = None, []
        for part in slices(batches, "segment"):
            for conv, segment, start, end in zip(*(part.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end"))):
                if at is None or conv != at[0]:
                    if at is not None:
                        out.append(done(at))
                    at = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                loss = unescape(segment[start:end])
                at[1] += 1
                at[2].update(f"{role}\n{text}\n".encode())
                at[3] += len(loss)
                at[4].update(loss.encode())
                at[5] += len(segment)
            if out:
                yield batch(out)
                out = []
        if at is not None:
            yield batch([done(at)])

    def done(at: list) -> tuple:
        return at[0], at[1], at[2].hexdigest(), at[3], at[4].hexdigest(), at[5]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [f.split()[0] for f in DIGEST.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows = segments.select("conv_id", "turn", "segment", "loss_start", "loss_end")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment").mapInArrow(run, DIGEST)
