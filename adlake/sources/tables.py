"""Layered table storage (S3-S9): ``<root>/<layer>/<name>`` directories.

Parquet is the default format; ``delta`` is used only when its package is
installed. Writes are create-only: a second write to the same table raises.
"""
from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from adlake.model import Options, layer_schema
from adlake.session import delta_available
from adlake.sources.csv import read_impressions_csv


#: Row-group size of clustered tables.
CLUSTER_GROUP_BYTES = 16 * 1024 * 1024


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def _format(fmt: str) -> str:
    if fmt == "delta" and not delta_available():
        raise RuntimeError("delta format requested but the delta package is not installed")
    return fmt


def read_table(spark: SparkSession, root: str, layer: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Read a layer table (CSV tables are read with the layer's declared schema)."""
    reader = spark.read.format(_format(fmt))
    if fmt == "csv":
        reader = (reader.schema(layer_schema(layer, name)).option("header", True)
                  .option("enforceSchema", False).option("mode", "FAILFAST"))
    return reader.load(table_path(root, layer, name))


def write_table(df: DataFrame, root: str, layer: str, name: str, opts: Options | None = None,
                *, partition_by: tuple[str, ...] = (), cluster_by: tuple[str, ...] = (), observe: tuple[Observation, list[Column]] | None = None) -> str:
    """Create-only write with the run's format, codec and optional partitioning.

    Rows of a partitioned write are rebalanced by the partition columns: one hash shuffle
    without a sampling pass, in which adaptive execution splits a hot partition value over
    several tasks and puts small ones together. A clustered write deals rows by ranges of the given
    columns (a sampling pass over those columns, then one shuffle) and sorts them within files,
    whose row groups are small enough (CLUSTER_GROUP_BYTES) that their smallest and largest values
    let a reader skip nearly all others. So files are as many as bytes call for, not as values do;
    a second column splits a value that is too frequent for one task. ``observe`` collects metrics
    of the rows while the last stage writes them, whose tasks count once however often they are retried."""
    opts = opts or Options()
    path = table_path(root, layer, name)
    if partition_by and cluster_by:
        raise ValueError("a table is partitioned by columns or clustered by them")
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    if observe:
        df = df.observe(observe[0], *observe[1])
    writer = df.write.format(_format(opts.fmt)).mode("errorifexists").option("compression", opts.codec)
    if opts.fmt == "parquet":
        writer = writer.option("parquet.block.size", min(opts.row_group_bytes, CLUSTER_GROUP_BYTES) if cluster_by else opts.row_group_bytes)
    if opts.fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def csv_to_parquet(spark: SparkSession, source: str, target: str, codec: str = "uncompressed") -> dict:
    """Convert typed impressions CSV to Parquet; returns the target path, the
    conversion time and the written Parquet files and bytes (a distributed listing)."""
    frame = read_impressions_csv(spark, source)
    started = time.perf_counter()
    frame.write.mode("errorifexists").option("compression", codec).parquet(target)
    seconds = time.perf_counter() - started
    stats = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(target)
             .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first())
    return {"path": target, "conversion_seconds": seconds,
            "parquet_files": stats["files"], "parquet_bytes": stats["bytes"]}


def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """One row: partition columns, data-file count and bytes of a table directory.

    A distributed file listing (``binaryFile`` without reading contents); partition
    columns come from ``key=value`` path segments.
    """
    root = path.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(root).select("path", "length"))
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _escape_tail(root) + "/", "")
    segments = F.split(rel, "/")
    keys = F.filter(F.transform(F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(1))),
                                lambda s: F.when(s.contains("="), F.split(s, "=")[0])),
                    lambda s: s.isNotNull())
    return files.agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(keys)))).alias("partition_columns"),
        # a directory per combination of partition values; none without partition columns
        F.count_distinct(F.when(F.size(keys) > 0, F.regexp_extract("path", r"^(.*)/[^/]+$", 1))).alias("partitions"),
        F.count("*").alias("num_files"),
        F.sum("length").alias("size_in_bytes"),
    )


def _escape_tail(root: str) -> str:
    import re
    tail = root.split(":", 1)[-1].lstrip("/")
    return re.escape(tail)

