"""Shared helpers of the training-data operators."""
from __future__ import annotations

import weakref
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame, functions as F

from adlake.session import delete_scratch, scratch_path

#: Text a Python task handles at once; a batch holds at least one text, however long.
CHUNK_BYTES = 4 * 1024 * 1024


#: Where the tables that ``materialize`` wrote lie.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared scratch folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialize`` gave and that nothing reads any more; others are left alone."""
    for table in tables:
        if table in _PATHS:
            delete_scratch(table.sparkSession, _PATHS.pop(table))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (Spark resolves names without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def refuse_clashes(carry: tuple[str, ...], taken: tuple[str, ...]) -> None:
    """Carried columns come under their own names, which the result's or inner ones may not repeat."""
    bad = sorted({c.lower() for c in carry} & set(taken))
    if bad:
        raise ValueError(f"cannot carry columns named {bad}")


def text_column(df: DataFrame, name: str = "text"):
    """The column as a string, null counted as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds about ``limit`` bytes of ``column``."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + (size or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if start < len(sizes):
            yield batch.slice(start)
