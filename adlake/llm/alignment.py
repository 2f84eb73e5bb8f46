"""Operator 11: cross-tokenizer alignment by interval coalescing.

A text, a space before it, is encoded by a byte-level vocabulary (A) and a piece vocabulary
(B). Every token is an interval of the text's bytes. The tokens of both sides are
lexsorted by start and the maximum of their ends is accumulated: a group of tokens ends where the next
start reaches that maximum, which is where A and B both end. Overlaps are expanded
within groups only, each A token meeting the run of B tokens that its bytes touch.

Corpus counts. An id pair counts once for every document that holds it linked. Documents are
handled in blocks of bounded text, and a block lists each of its pairs once, with its number of
documents; documents point into that list. So what is shuffled to count pairs, and to bring
the counts back, is a row per pair and block, not per link. A block with its answers is
then read by one task. The highest count of each A id is a table of at most a vocabulary's size.

A text longer than STRETCH characters is aligned stretch by stretch, cut where both
vocabularies always cut: at a single space between two characters that aren't white space.
"""
from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from adlake.llm.common import materialize, refuse_clashes, slices, text_column
from adlake.llm.tokens import _JOINED, CACHE_CHUNKS, CACHED_CHARS, LATIN_END, VOCABULARY, encoder, vocabulary_paths

PIECES = "piece_bpe_32k.model"
#: Text of a block and of an alignment at once, in bytes, and the longest stretch of a text, in characters.
BLOCK_BYTES, ALIGN_BYTES, STRETCH = 2 * 1024 * 1024, 512 * 1024, 256 * 1024
#: Words encoded at once.
LEARNED = 20_000
_CUT = re.compile("(?<=[^\\s᠎​]) (?=[^\\s᠎​])")
_CHUNK = re.compile(" +[^ ]*")
_SIDES: dict[tuple, "Sides"] = {}


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in parts of about ``size`` characters; between two parts one space is left out."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def byte_tokens(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    # the format's rule: printable Latin-1 bytes stand for themselves, the others follow from 256 on
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    ids = dict(model["model"]["vocab"])
    out = [b""] * (max([*ids.values(), *(t["id"] for t in model["added_tokens"])]) + 1)
    for token in model["added_tokens"]:
        out[token["id"]] = token["content"].encode()
    for token, i in ids.items():
        if all(c in byte for c in token):
            out[i] = bytes(byte[c] for c in token)
    return out


class Sides:
    """Both vocabularies of a worker."""

    def __init__(self, names: tuple[str, str], pieces: str):
        import public_tokenizers
        import sentencepiece
        self.a = encoder(names)
        self.a_bytes = byte_tokens(vocabulary_paths(names)[0])
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
        plain = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search("[^\u2581]\u2581", p) for p in plain):
            raise ValueError(f"{pieces}: a piece goes on past a space, so texts can't be cut at spaces")
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("\u2581", " ").encode()
                        for i, p in enumerate(plain)]
        self.space = [self.model.piece_to_id("\u2581")]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        self.known: dict[str, bytes | None] = {}
        self.words: dict[str, tuple[bytes, bytes] | None] = {}
        # each id as text, followed by each separator
        self.marked = [f"{i}{mark}" for i in range(max(len(plain), len(self.a_bytes))) for mark in ",|;"]

    def _chunk(self, chunk: str) -> bytes | None:
        """B's ids of spaces and the characters after them; None if their bytes differ from the chunk's."""
        ids = self.model.encode(chunk[1:]) if len(chunk) > 1 else self.space
        if b"".join([self.b_bytes[i] for i in ids]) != chunk.encode():
            return None
        return np.array(ids, dtype="<u4").tobytes()

    def _whole(self, text: str) -> bytes | None:
        """A's ids; None if their bytes differ from the text's."""
        ids = self.a(text)
        same = b"".join([self.a_bytes[i] for i in np.frombuffer(ids, "<u4").tolist()]) == text.encode()
        return ids if same else None

    def _word(self, word: str) -> tuple[bytes, bytes] | None:
        found = self.words.get(word, 0)
        if found == 0:
            a, b = self._whole(f" {word}"), self._chunk(f" {word}")
            found = None if a is None or b is None else (a, b)
            if len(word) <= CACHED_CHARS:
                if len(self.words) >= CACHE_CHUNKS:
                    self.words.clear()
                self.words[word] = found
        return found

    def learn(self, texts: list[str]) -> None:
        """Put the words of texts into the cache, the new ones in a few calls to the encoders."""
        words: set[str] = set()
        for text in texts:
            if text and not _JOINED.search(f" {text}"):
                words.update(text.split(" "))
        new = words.difference(self.words)
        if len(self.words) + len(new) > CACHE_CHUNKS:
            self.words.clear()
            new = words
        short = sorted(w for w in new if len(w) <= CACHED_CHARS)
        latin = [w for w in short if w.isascii() or max(w) < LATIN_END]
        for group in (latin, sorted(set(short).difference(latin))):
            for at in range(0, len(group), LEARNED):
                self._learn(group[at:at + LEARNED])

    def _learn(self, words: list[str]) -> None:
        """Encode words as one text, which both sides cut at every space, and deal out the ids."""
        text = f" {' '.join(words)}"
        ids = [np.frombuffer(self.a.plain(text), "<u4"), np.array(self.model.encode(text[1:]), "<u4")]
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        cuts, data = [], text.encode()
        for found, table, sizes in zip(ids, (self.a_bytes, self.b_bytes), (self.a_sizes, self.b_sizes)):
            upto = np.r_[0, np.cumsum(sizes[found])]
            at = np.searchsorted(upto, ends)
            if at[-1] >= len(upto) or (upto[at] != ends).any() or b"".join([table[i] for i in found.tolist()]) != data:
                for word in words:  # some word isn't given back: which one, shows word by word
                    self._word(word)
                return
            raw, edges = found.tobytes(), [0, *(4 * at).tolist()]
            cuts.append([raw[low:high] for low, high in zip(edges, edges[1:])])
        self.words.update(zip(words, zip(*cuts)))

    def encode(self, stretch: str) -> tuple[np.ndarray, np.ndarray] | None:
        """A's and B's ids of a space and the stretch; None where either's bytes differ from them."""
        if not _JOINED.search(f" {stretch}"):
            # every space is followed by a character that isn't white space: both sides cut at every space
            words = stretch.split(" ")
            try:
                found = [self.words[w] for w in words]
            except KeyError:
                found = [self._word(w) for w in words]
            if None in found:
                return None
            a, b = zip(*found)
            return np.frombuffer(b"".join(a), "<u4"), np.frombuffer(b"".join(b), "<u4")
        text, known, parts = " " + stretch, self.known, []
        for chunk in _CHUNK.findall(text):
            ids = known.get(chunk, 0)
            if ids == 0:
                ids = self._chunk(chunk)
                if len(chunk) <= CACHED_CHARS:
                    if len(known) >= CACHE_CHUNKS:
                        known.clear()
                    known[chunk] = ids
            if ids is None:
                return None
            parts.append(ids)
        a = self._whole(text)
        return None if a is None else (np.frombuffer(a, "<u4"), np.frombuffer(b"".join(parts), "<u4"))


def sides(names: tuple[str, str], pieces: str) -> Sides:
    if (names, pieces) not in _SIDES:
        _SIDES[names, pieces] = Sides(names, pieces)
    return _SIDES[names, pieces]


class Aligned(NamedTuple):
    """Group of each A and B token, and the linked tokens' places."""
    a_group: np.ndarray
    b_group: np.ndarray
    a_linked: np.ndarray
    b_linked: np.ndarray


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Aligned:
    """Align two rows of tokens, given by their numbers of bytes, over the same bytes."""
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    start, end = np.concatenate([a_end - a_sizes, b_end - b_sizes]), np.concatenate([a_end, b_end])
    side = np.repeat(np.array([0, 1], np.int8), [len(a_end), len(b_end)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.zeros(len(order), dtype=np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(breaks)
    low = np.searchsorted(b_end, a_end - a_sizes, side="right")
    n = np.searchsorted(b_end - b_sizes, a_end, side="left") - low
    a_linked = np.repeat(np.arange(len(a_end)), n)
    b_linked = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - low, n)
    return Aligned(group[:len(a_end)], group[len(a_end):], a_linked, b_linked)


def _notation(a: np.ndarray, b: np.ndarray, found: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """Groups in order, A's ids then B's: for each token 3 * id + separator, and its group."""
    key = np.concatenate([2 * found.a_group, 2 * found.b_group + 1])
    order = np.argsort(key, kind="stable")
    key = key[order]
    last = np.append(key[1:] != key[:-1], True)
    return 3 * np.concatenate([a, b])[order].astype(np.int64) + np.where(last, 1 + (key & 1), 0), key >> 1


class Block:
    """The alignment of a block's documents."""

    def __init__(self, texts: list[str], held: Sides, with_groups: bool, align_bytes: int = ALIGN_BYTES, stretch: int = STRETCH):
        size = len(texts)
        self.sides, self.size = held, size
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(size, np.int64) for _ in range(4))
        self.digests: list = [None] * size
        self.groups: list[list[str]] | None = [[] for _ in texts] if with_groups else None
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting, room = [], align_bytes
        held.learn(texts)
        for doc, text in enumerate(texts):
            # a text has tokens only if all its stretches have, so a long one is tried out first
            parts = list(stretches(text, stretch)) if text else []
            if len(parts) > 1 and any(held.encode(p) is None for p in parts):
                continue
            for part in parts:
                if (ids := held.encode(part)) is not None:
                    waiting.append((doc, *ids))
                    room -= len(part)
                if room <= 0:
                    self._align(waiting)
                    waiting, room = [], align_bytes
        if waiting:
            self._align(waiting)

    def _align(self, parts: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        docs = np.array([p[0] for p in parts])
        a, b = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        a_part = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        b_part = np.repeat(np.arange(len(parts)), [len(p[2]) for p in parts])
        found = coalesce(self.sides.a_sizes[a], self.sides.b_sizes[b])
        np.add.at(self.n_a, docs, np.bincount(a_part, minlength=len(parts)))
        np.add.at(self.n_b, docs, np.bincount(b_part, minlength=len(parts)))
        of_group = a_part[np.flatnonzero(np.diff(found.a_group, prepend=-1))]
        np.add.at(self.n_groups, docs, np.bincount(of_group, minlength=len(parts)))
        of_link = a_part[found.a_linked]
        np.add.at(self.n_links, docs, np.bincount(of_link, minlength=len(parts)))
        marks, group = _notation(a, b, found)
        marked = self.sides.marked
        tokens = [marked[m] for m in marks.tolist()]
        edges = np.searchsorted(of_group[group], np.arange(len(parts) + 1)).tolist()
        for doc, low, high in zip(docs.tolist(), edges, edges[1:]):
            text = "".join(tokens[low:high])[:-1]
            if self.digests[doc] is None:
                self.digests[doc] = hashlib.sha256(text.encode())
            else:
                self.digests[doc].update(f";{text}".encode())
            if self.groups is not None:
                self.groups[doc].append(text)
        pair = (a[found.a_linked].astype(np.int64) << 32) | b[found.b_linked]
        self.found.append(_counted(docs[of_link], pair, np.ones(len(pair), np.int64)))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The block's pairs in order; for each document and pair in it: document, place of the pair, links."""
        doc, pair, n = (np.concatenate(c) for c in zip(*self.found)) if self.found else (np.zeros(0, np.int64),) * 3
        if len(self.found) > 1:
            doc, pair, n = _counted(doc, pair, n)
        every, place = np.unique(pair, return_inverse=True)
        return every, doc, place, n


def _counted(doc: np.ndarray, pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (document, pair) rows as one, in the order of documents and pairs."""
    every, place = np.unique(pair, return_inverse=True)
    key = doc * max(len(every), 1) + place
    if (n == 1).all():
        key, total = np.unique(key, return_counts=True)
    else:
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.diff(key[order], prepend=-1))
        key, total = key[order][new], np.add.reduceat(n[order], new) if len(new) else n
    return key // max(len(every), 1), every[key % max(len(every), 1)], total


PER_DOC = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
_INNER = ("__block", "__text", "__at", "__n", "__pairs", "__docs")


def blocks(docs: DataFrame, id_col: str, text_col: str, names: tuple[str, str], pieces: str, with_groups: bool,
           carry: tuple[str, ...], block_bytes: int) -> DataFrame:
    """Rows of documents (with places in their block's pairs) and one row for each block's pairs."""
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), text_column(docs, text_col).alias("__text"),
                         *[docs[f"`{c}`"] for c in carry])
    kept = [f for f in source.schema.fields if f.name != "__text"]
    text = [T.StructField("groups", T.StringType())] if with_groups else []
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], *[T.StructField(c, T.LongType()) for c in PER_DOC[:4]],
                           T.StructField(PER_DOC[4], T.StringType()), *text, T.StructField("__block", T.LongType()),
                           *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("__at", "__n")],
                           T.StructField("__pairs", T.ArrayType(T.LongType())), T.StructField("__docs", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = sides(names, pieces), TaskContext.get().partitionId() << 33
        for part in slices(batches, "__text", block_bytes):
            block = Block(part.column("__text").to_pylist(), held, with_groups)
            every, doc, place, n = block.pairs()
            edges = np.searchsorted(doc, np.arange(block.size + 1)).astype(np.int32)
            rest = part.drop_columns(["__text"])
            columns = {name: rest.column(name) for name in rest.schema.names}
            columns |= {c: pa.array(getattr(block, c), pa.int64()) for c in PER_DOC[:4]}
            columns["groups_sha256"] = pa.array([d.hexdigest() if d else "" for d in block.digests], pa.string())
            if with_groups:
                columns["groups"] = pa.array([";".join(g) for g in block.groups], pa.string())
            columns["__block"] = pa.array(np.full(block.size, number), pa.int64())
            for name, values in (("__at", place), ("__n", n)):
                columns[name] = pa.ListArray.from_arrays(pa.array(edges), pa.array(values.astype(np.int32)))
            rows = pa.table({c: columns.get(c, pa.nulls(block.size, kind)) for c, kind in kinds})
            yield from rows.combine_chunks().to_batches(max_chunksize=1024)
            own = {"__block": pa.array([number], pa.int64()), "__pairs": pa.array([every], pa.list_(pa.int64())),
                   "__docs": pa.array([np.bincount(place, minlength=len(every)).astype(np.int32)], pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_arrays([own.get(c, pa.nulls(1, kind)) for c, kind in kinds], names=[c for c, _ in kinds])
            number += 1

    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in schema]
    return source.mapInArrow(run, schema)


def _block_pairs(rows: DataFrame) -> DataFrame:
    return rows.filter("__pairs IS NOT NULL").select("__block", F.posexplode(F.arrays_zip("__pairs", "__docs")).alias("__k", "z")).select(
        "__block", "__k", F.col("z.__pairs").alias("pair"), F.col("z.__docs").alias("docs"))


def _pair_counts(rows: DataFrame) -> DataFrame:
    return _block_pairs(rows).groupBy("pair").agg(F.sum("docs").alias("count"))


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = VOCABULARY,
                pieces: str = PIECES) -> DataFrame:
    """(a, b, count): every pair of an A and a B id that is linked anywhere, and in how many documents.

    Documents without tokens (null, empty, or not given back by both vocabularies) count for none."""
    rows = blocks(docs, id_col, text_col, names, pieces, False, (), BLOCK_BYTES)
    return _pair_counts(rows).select(F.shiftright("pair", 32).alias("a"),
                                     F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "count")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = VOCABULARY,
          pieces: str = PIECES, with_groups: bool = False, carry: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256,
    then (with_groups) the groups as ``a1,a2|b1;a3|b2,b3``, then ``carry``.

    Null and empty texts, and texts that either vocabulary doesn't give back byte for byte, have
    no tokens: zeros and an empty string. Repeated rows and null ids are documents of their own. An empty
    table gives an empty result. ``carry`` columns may not have the result's names."""
    taken = ("doc_id", *PER_DOC, "groups", "n_best", "count_sum", *_INNER)
    refuse_clashes(carry, taken)
    rows = materialize(blocks(docs, id_col, text_col, names, pieces, with_groups, carry, block_bytes), "alignment-blocks")
    counts = materialize(_pair_counts(rows), "alignment-pairs")
    a_id = F.shiftright("pair", 32).alias("a")
    highest = counts.groupBy(a_id).agg(F.max("count").alias("highest"))  # a row per A id: bounded by the vocabulary
    known = counts.withColumn("a", F.shiftright("pair", 32)).join(F.broadcast(highest), "a").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = _block_pairs(rows).join(known, "pair").select(F.col("__block").alias("__of"), "__k", "count", "best")
    out = ["doc_id", *PER_DOC, *(["groups"] if with_groups else []), *carry]
    owned = rows.filter("__pairs IS NULL").select("__block", "__at", "__n", *[f"`{c}`" for c in out])
    fields = [owned.schema[c] for c in out] + [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]

    def total(_, left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        k = right.column("__k").to_numpy()
        count[k], best[k] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        at, n = (left.column(c).combine_chunks() for c in ("__at", "__n"))
        place, links = at.flatten().to_numpy(), n.flatten().to_numpy()
        doc = np.repeat(np.arange(left.num_rows), at.value_lengths().to_numpy())
        done = left.select(out)
        for name, values in (("n_best", best), ("count_sum", count)):
            sums = np.zeros(left.num_rows, np.int64)
            if len(doc):
                new = np.flatnonzero(np.diff(doc, prepend=-1))
                sums[doc[new]] = np.add.reduceat(links * values[place], new)
            done = done.append_column(name, pa.array(sums, pa.int64()))
        return done

    summed = owned.groupBy("__block").cogroup(answers.groupBy("__of")).applyInArrow(total, T.StructType(fields))
    head = ["doc_id", *PER_DOC[:4], "n_best", "count_sum", PER_DOC[4]]
    return summed.select(*head, *[f"`{c}`" for c in out if c not in head])
