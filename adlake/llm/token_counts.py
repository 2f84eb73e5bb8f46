"""Operator 10: token counts by a separator scan over flat, unindexed token files.

A token stream is a sequence of files that hold nothing but unsigned little-endian ids; an
end-of-document id closes each document, which may start in one file and end in another.
``scan`` finds the separators of each file block by block with vectorised comparisons. What
a file can't know is where its first document began: a prefix scan over one small row per
file carries the open length and the document number from file to file.

``write_streams`` makes such files from documents: one stream per task, cut at FILE_IDS ids
wherever that falls, through Spark's text sink (one row per file; the line feed that the
sink adds is the odd last byte, which the scan leaves out). So the tasks' work survives lost
executors, any file system serves, and a reading task holds one file of bounded size.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from adlake.llm.common import materialize, slices, text_column
from adlake.llm.tokens import VOCABULARY, encoder
from adlake.session import scratch_path

#: Ids of a file and of a scanned block; the id after each document.
FILE_IDS, BLOCK_IDS, END_ID = 4 * 1024 * 1024, 256 * 1024, 50256


def write_streams(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                  names: tuple[str, str] = VOCABULARY, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the documents' ids as token streams under ``path``; return (stream, document, doc_id).

    The numbering is that of the tasks that read ``docs`` and of the rows in a task, so
    ``docs`` must deal its rows the same way twice in a row, as a scan of files does; ``count_tokens``
    fails if it didn't. Ids of the vocabulary must stay below 65536, and the end id must not occur in texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held = encoder(names), bytearray()
        for part in slices(batches, "text"):
            for text in part.column("text").to_pylist():
                held += np.append(np.frombuffer(encode(text), "<u4"), end_id).astype("<u2").tobytes()
                while len(held) >= 2 * file_ids:
                    yield row(held[:2 * file_ids])
                    del held[:2 * file_ids]
        if held:
            yield row(held)

    def row(ids: bytearray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([bytes(ids)], pa.binary())], names=["value"])

    texts = docs.select(text_column(docs, text_col).alias("text")).mapInArrow(run, "value binary")
    texts.select(F.col("value").cast("string")).write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)
    number = F.monotonically_increasing_id()
    rows = docs.select(F.shiftright(number, 33).cast("int").alias("stream"),
                       number.bitwiseAND(F.lit((1 << 33) - 1)).alias("document"), docs[id_col].cast("long").alias("doc_id"))
    return materialize(rows, "token-documents")


def block_lengths(ids: np.ndarray, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> tuple[np.ndarray, int]:
    """Ids before each separator since the one before it (or the start), and those after the last.

    Separators are searched block by block; each block's are shifted by what precedes it."""
    found = [np.flatnonzero(ids[at:at + block_ids] == end_id) + at for at in range(0, len(ids), block_ids)]
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    lengths = np.diff(ends, prepend=-1) - 1
    return lengths, len(ids) - (int(ends[-1]) + 1 if len(ends) else 0)


def scan(spark: SparkSession, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per document of the streams under ``path``: stream, document (from 0), n_tokens
    (without the separator) and complete (whether a separator closes it).

    Stream and file numbers are those of the part files' names. Ids after the last separator of a stream are
    an incomplete document. No files, or empty ones, give an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = zlib.decompress(batch.column("content")[i].as_py(), 31)
                lengths, tail = block_lengths(np.frombuffer(data, "<u2", count=len(data) // 2), end_id, block_ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("path").slice(i, 1), pa.array([lengths], pa.list_(pa.int64())), pa.array([tail], pa.int64())],
                    names=["path", "lengths", "tail"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    found = files.mapInArrow(run, "path string, lengths array<long>, tail long")
    name = F.regexp_extract("path", r"part-(\d+)-[^/]*-c(\d+)\.[^/]*$", 1), F.regexp_extract("path", r"part-(\d+)-[^/]*-c(\d+)\.[^/]*$", 2)
    found = found.select(name[0].cast("int").alias("stream"), name[1].cast("int").alias("file"), "lengths", "tail")
    before = Window.partitionBy("stream").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("stream").orderBy("file").rowsBetween(1, Window.unboundedFollowing)
    n = F.size("lengths")
    # open length: the tails since the last file with a separator, that file's own included
    tails = F.sum("tail").over(before)
    closed = F.last(F.when(n > 0, F.col("seen") - F.col("tail")), ignorenulls=True).over(before)
    found = (found.withColumn("first", F.coalesce(F.sum(n).over(before), F.lit(0)))
             .withColumn("seen", F.coalesce(F.sum("tail").over(before), F.lit(0)) + F.col("tail"))
             .withColumn("open", F.coalesce(tails - F.coalesce(closed, F.lit(0)), F.lit(0)))
             .withColumn("last", F.coalesce(F.count(F.lit(1)).over(after), F.lit(0)) == 0))
    ends = found.select("stream", "first", "open", F.posexplode("lengths").alias("k", "length")).select(
        "stream", (F.col("first") + F.col("k")).alias("document"),
        (F.col("length") + F.when(F.col("k") == 0, F.col("open")).otherwise(0)).alias("n_tokens"), F.lit(True).alias("complete"))
    rest = F.col("tail") + F.when(n == 0, F.col("open")).otherwise(0)
    cut = found.filter("last").select("stream", (F.col("first") + n).alias("document"), rest.alias("n_tokens"),
                                      F.lit(False).alias("complete")).filter("n_tokens > 0")
    return ends.unionByName(cut)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 names: tuple[str, str] = VOCABULARY, file_ids: int = FILE_IDS) -> DataFrame:
    """(doc_id, n_tokens) of every document, from token files written in the shared scratch folder.

    Null and empty texts have no tokens; repeated rows and null ids are counted row by row;
    an empty table gives an empty result. Other columns are not read. A document without a counterpart in the
    files raises an error when the result is read."""
    path = scratch_path(docs.sparkSession, "token-streams")
    rows = write_streams(docs, path, id_col, text_col, end_id, names, file_ids)
    counted = scan(docs.sparkSession, path, end_id)
    whole = F.col("complete") & F.col("present")
    both = rows.withColumn("present", F.lit(True)).join(counted, ["stream", "document"], "full")
    return both.select("doc_id", F.when(whole, F.col("n_tokens")).otherwise(
        F.raise_error(F.lit("documents and token files were dealt differently")).cast("long")).alias("n_tokens"))
