"""Operator 12: target-distribution importance resampling over hashed word runs.

Features. A text's words are those of ``decontaminate.words_of``; every run of 1 to
``longest`` consecutive words, joined by single spaces and with repeats counted, falls into
the bucket crc32(UTF-8 bytes) mod ``buckets``. A bucket's gain compares its smoothed share of the
target's features with that of all documents'; a document's weight is the sum of its
features' gains, and its score adds Gumbel noise drawn from its id, so the highest scores
are a sample without replacement in proportion to the importance weights.

CRC by a position table. CRC-32 is affine: a message's value is a constant of its length, XOR
one contribution for each byte that depends only on the byte and its distance from the
end. The contributions are precomputed for BLOCK distances; the bytes of many spans are
looked up together and each span's are folded by one ``bitwise_xor.reduceat``. A longer span
is cut into blocks from its end, each block folded the same way; then neighbouring blocks
are merged pairwise, the earlier one advanced over the bytes that follow it, in as many rounds
as the number of blocks has binary digits. So no length is special and none is cut off.

Scale. Two passes over the documents, neither shuffling text: one counts buckets (a row per
bucket and task), one sums gains. Buckets are recomputed rather than stored, as they
would take more room than the text. Only ``buckets`` counts and gains pass through the driver. Places
come from a range sort of rows without text.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from adlake.llm.common import fresh, materialize, refuse_clashes, slices, text_column
from adlake.llm.decontaminate import words_of
from adlake.operators.ranking import ranked

BUCKETS, LONGEST, SEED, PERCENT, MIN_WORDS = 10_000, 3, 42, 5, 20
#: Distances in the position table, and bytes looked up at once.
BLOCK, LOOKUPS = 64, 1 << 15
#: Text whose features are held at once; a slice holds at least one text, however long.
SLICE_BYTES = 256 * 1024


@cache
def _contributions() -> np.ndarray:
    """At [distance * 256 + byte], what that byte adds to the CRC at that distance from the end."""
    poly = np.uint32(0xEDB88320)  # fixed value: the reflected CRC-32 polynomial
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ poly, step >> np.uint32(1))
    rows = [step]
    for _ in range(BLOCK - 1):
        rows.append(_past_zero(rows[-1], step))
    return np.concatenate(rows)


@cache
def _constants() -> np.ndarray:
    """CRC-32 of 0 to BLOCK zero bytes: what a message's length adds."""
    return np.array([zlib.crc32(bytes(n)) for n in range(BLOCK + 1)], dtype=np.uint32)


def _past_zero(state: np.ndarray, step: np.ndarray) -> np.ndarray:
    """CRC registers after one more zero byte."""
    return (state >> np.uint32(8)) ^ step[state & np.uint32(255)]


@cache
def _jump(level: int) -> np.ndarray:
    """Four rows of 256: what each byte of a register becomes after BLOCK * 2**level zero bytes."""
    if level:
        half = _jump(level - 1)
        return _advance(_advance_table(half), half)
    state, step = _advance_table(None), _contributions()[:256]
    for _ in range(BLOCK):
        state = _past_zero(state, step)
    return state


def _advance_table(jump: np.ndarray | None) -> np.ndarray:
    """Registers with one byte set, advanced by ``jump`` if there is one."""
    single = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return single if jump is None else _advance(single, jump)


def _advance(state: np.ndarray, jump: np.ndarray) -> np.ndarray:
    byte = np.uint32(255)
    return (jump[0][state & byte] ^ jump[1][(state >> np.uint32(8)) & byte]
            ^ jump[2][(state >> np.uint32(16)) & byte] ^ jump[3][state >> np.uint32(24)])


def _fold(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each span's bytes; spans are of 1 to BLOCK bytes."""
    out, table = np.empty(len(starts), dtype=np.uint32), _contributions()
    lengths = ends - starts
    upto = np.cumsum(lengths)
    at = 0
    while at < len(starts):
        base = int(upto[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(upto, base + LOOKUPS, side="right")))
        n = lengths[at:to]
        first = (upto[at:to] - n - base).astype(np.int32)
        k = np.arange(int(upto[to - 1]) - base, dtype=np.int32)
        place = k + np.repeat((starts[at:to] - first).astype(np.int64), n)
        left = np.repeat(first + n.astype(np.int32) - 1, n) - k
        out[at:to] = np.bitwise_xor.reduceat(table[(left << 8) + data[place]], first)
        at = to
    return out


def crc_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of ``data[start:end]`` for every span, of any length; ``data`` holds bytes."""
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    lengths = ends - starts
    constant = _constants()[np.minimum(lengths, BLOCK)]
    if not len(lengths) or 0 < lengths.min() and lengths.max() <= BLOCK:
        return _fold(data, starts, ends) ^ constant
    out = np.zeros(len(starts), dtype=np.uint32)
    short = (lengths > 0) & (lengths <= BLOCK)
    out[short] = _fold(data, starts[short], ends[short])
    long = np.flatnonzero(lengths > BLOCK)
    if len(long):
        out[long] = _fold_long(data, starts[long], ends[long])
        sizes, which = np.unique(lengths[long], return_inverse=True)
        constant[long] = np.array([zlib.crc32(bytes(int(n))) for n in sizes], dtype=np.uint32)[which]
    return out ^ constant


def _fold_long(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    blocks = -(-(ends - starts) // BLOCK)
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)  # counted from the span's end
    upto = np.repeat(ends, blocks) - place * BLOCK
    values = _fold(data, np.maximum(np.repeat(starts, blocks), upto - BLOCK), upto)
    level = 0
    while len(values) > len(starts):
        earlier = (place & 1).astype(bool)
        values[earlier] = _advance(values[earlier], _jump(level))
        pairs = np.flatnonzero(~earlier)
        values, place, level = np.bitwise_xor.reduceat(values, pairs), place[pairs] >> 1, level + 1
    return values


def features(texts: list[bytes], buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Each text's number of words; for runs of 1, 2, ... words the texts and buckets of all runs."""
    words = [words_of(t) for t in texts]
    n_words = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.frombuffer(b" ".join(b" ".join(w) for w in words if w), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), n_words)
    gaps = np.flatnonzero(flat == 32)
    starts, ends = np.r_[0, gaps + 1][:len(owner)], np.r_[gaps, len(flat)][:len(owner)]
    owners, found = [], []
    for n in range(1, longest + 1):
        whole = np.flatnonzero(owner[:len(owner) - n + 1] == owner[n - 1:])
        owners.append(owner[whole])
        found.append((crc_spans(flat, starts[whole], ends[whole + n - 1]) % np.uint32(buckets)).astype(np.int64))
    return n_words, owners, found


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``buckets`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, dtype=np.int64)
        for part in slices(batches, "text", SLICE_BYTES):
            for found in features(part.column("text").cast(pa.binary()).to_pylist(), buckets, longest)[2]:
                held += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some], pa.int64())], names=["bucket", "n"])

    rows = texts.select(text_column(texts, text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln) of its smoothed target share over its smoothed source share."""
    size, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + size) / ((a + 1.0) * (t + size))))
                     for a, b in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """``docs`` with n_words, n_features and weight after its own columns, which may not have those names."""
    refuse_clashes(tuple(docs.columns), ("n_words", "n_features", "weight"))
    held = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket
    texts = docs.withColumn(text_col, docs[text_col].cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = held.value
        for part in slices(batches, text_col, SLICE_BYTES):
            column = part.column(text_col).cast(pa.binary()).to_pylist()
            n_words, owners, found = features([t or b"" for t in column], len(gain), longest)
            n_features, weight = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
            for owner, bucket in zip(owners, found):
                n_features += np.bincount(owner, minlength=len(column))
                if len(owner):
                    new = np.flatnonzero(np.diff(owner, prepend=-1))
                    weight[owner[new]] += np.add.reduceat(gain[bucket], new)
            for name, values in (("n_words", n_words), ("n_features", n_features), ("weight", weight)):
                part = part.append_column(name, pa.array(values, pa.int64()))
            yield part

    fields = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    return texts.mapInArrow(run, T.StructType([*texts.schema.fields, *fields]))


def _noise(doc_id, seed: int):
    """floor(-1000 ln(-ln u)) for u from the id's digest; a null id counts as an empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def _scored(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, target_text_col: str, seed: int, buckets: int,
            longest: int, min_words: int, keep_text: bool, carry: tuple[str, ...]) -> DataFrame:
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_text_col, buckets, longest))
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("__text"), *[docs[f"`{c}`"] for c in carry])
    rows = weigh(source, gain, "__text", longest)
    rows = rows.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)).withColumn("__may", F.col("n_words") >= min_words)
    rows = rows.withColumn("__uid", F.monotonically_increasing_id())
    return materialize(rows if keep_text else rows.drop("__text"), "importance-scores")


_ORDER = [F.desc, "__may"], [F.desc, "score"], [F.asc_nulls_last, "doc_id"], [F.asc, "__uid"]
TAKEN = ("doc_id", "n_words", "n_features", "weight", "score", "rank", "__text", "__may", "__uid")


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
               percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS,
               longest: int = LONGEST, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (all long), then ``carry``.

    Of the N documents with at least ``min_words`` words the floor(percent * N / 100) highest scores
    are drawn and ranked from 1, ties to the smaller id, a null id last; other documents have a null
    rank. Null and empty texts have no features and weight 0. Repeated rows are documents of their
    own, with equal scores and neighbouring ranks. An empty table gives an empty result, and an empty
    target is one without features. ``carry`` columns may not have the result's names."""
    refuse_clashes(carry, TAKEN)
    rows = _scored(docs, target, id_col, text_col, target_text_col, seed, buckets, longest, min_words, False, carry)
    drawn = rows.filter("__may").count() * percent // 100
    placed = ranked(rows, [order(c) for order, c in _ORDER])
    rank = F.when(F.col("__may") & (F.col("rank") <= drawn), F.col("rank"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"), *carry)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS,
             longest: int = LONGEST) -> DataFrame:
    """The drawn rows of ``docs`` with their own columns, whatever those are named.

    Nulls, empties, ties and repeats are as for ``importance``. Texts are written once and not shuffled:
    the last drawn row's place in the order decides on every row by itself."""
    names = {c: fresh(docs, f"__carry_{i}") for i, c in enumerate(docs.columns)}
    inner = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in names.items()])
    carried = tuple(n for c, n in names.items() if c != text_col)
    rows = _scored(inner, target, names[id_col], names[text_col], target_text_col, seed, buckets, longest, min_words, True, carried)
    drawn = rows.filter("__may").count() * percent // 100
    order = [order(c) for order, c in _ORDER]
    last = ranked(rows.select("__may", "score", "doc_id", "__uid"), order).filter(F.col("rank") == drawn).first()
    if last is None:
        kept = rows.limit(0)
    else:
        tie = F.col("__uid") <= last["__uid"]
        same = F.col("doc_id").eqNullSafe(F.lit(last["doc_id"]).cast("long"))
        before = F.lit(False) if last["doc_id"] is None else F.col("doc_id") < last["doc_id"]
        if last["doc_id"] is None:
            before = F.col("doc_id").isNotNull()
        kept = rows.filter("__may").filter((F.col("score") > last["score"]) | (F.col("score") == last["score"]) & (before | same & tie))
    kinds = docs.schema
    return kept.select(*[F.col("__text" if c == text_col else n).cast(kinds[c].dataType).alias(c) for c, n in names.items()])
