"""Operator 2: packing by power-of-two decomposition.

A document's ids (its text's, then the end-of-document id) are cut into pieces whose lengths
are powers of two: full pieces of ``max_length``, then the set bits of the rest, longest
first. Every piece is a sequence by itself in the bucket of its length. So no sequence
crosses documents, none holds padding, and a trainer draws equal-length batches from the
buckets. One pass without a shuffle: a hot source or a very long text only means more rows.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adlake.llm.common import slices, text_column
from adlake.llm.tokens import VOCABULARY, encoder

MAX_LENGTH, END_ID = 1024, 0
#: Pieces handed over at once.
ROWS = 4096


def piece_lengths(n: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Powers of two that add up to ``n``, longest first. 2600 -> 1024, 1024, 512, 32, 8."""
    rest = n % max_length
    return [max_length] * (n // max_length) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH,
         end_id: int = END_ID, with_ids: bool = True, names: tuple[str, str] = VOCABULARY,
         added_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, then (with_ids) its
    ids as little-endian unsigned 32-bit bytes, then sequence_id, offset and bucket.

    A null or empty text is one piece that holds only the end id. Null ids stay null, and
    each repeated row is packed by itself. An empty table gives an empty result. Columns other
    than id and text are not read. ``max_length`` must be a power of two. With ``added_tokens`` the
    strings of the tokenizer file's added tokens get those tokens' ids, else they are ordinary text.

    sequence_id is unique among the result's rows and stays the same for the same input splits;
    it numbers pieces, so its order has no meaning."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    end = end_id.to_bytes(4, "little")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])
    schema = pa.schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, rows = encoder(names), []
        for part in slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = memoryview(encode(text, added_tokens) + end)
                total, start = len(ids) // 4, 0
                for n in piece_lengths(total, max_length):
                    piece = ids[4 * start:4 * (start + n)]
                    row = (doc_id, start, n, zlib.crc32(piece), total)
                    rows.append(row + (bytes(piece),) if with_ids else row)
                    start += n
                    if len(rows) >= ROWS:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if with_ids else "")
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), text_column(docs, text_col).alias("text"))
    return source.mapInArrow(cut, ddl).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.col("length").alias("bucket"))
