"""Storage and provenance measurements as Spark jobs.

Data files are listed by the ``binaryFile`` source selecting only ``path``/``length``, which
reads no content; Parquet footers and file hashes are read on executors with
``mapInPandas`` (one task handles a slice of the file list), never on the driver. Spark hides
files whose names start with ``_`` or ``.``; ``all_files`` lists those too, level by level of the
folders, each level's folders dealt over tasks that ask the file system.
"""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adlake.model import LAYERS
from adlake.operators.quality import row_hash
from adlake.session import materialize

#: Bytes of a file that a hashing task holds at once.
HASH_BLOCK = 1024 * 1024
#: Bytes that one leaf of a hash tree covers, and children of a node.
TREE_RANGE, TREE_FANOUT = 64 * 1024 * 1024, 1024


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length")


def listing_state(spark: SparkSession, root: str) -> str:
    """A fingerprint of which files lie under ``root``, their sizes and times, without reading them."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path", "length", "modificationTime"))
    n, total = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{n}-{total}"


def _relative(root: str) -> F.Column:
    tail = re.escape(root.rstrip("/").split(":", 1)[-1].lstrip("/"))
    return F.regexp_replace(F.col("path"), r"^[a-z]+:/*" + tail + "/", "")


def _file_system(path: str):
    """The file system of a path, and the path in it."""
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def all_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file under ``root``, hidden ones and sidecars too: its path below the root, and length."""
    root = root.rstrip("/")

    def listed(batches):
        import pandas as pd
        import pyarrow.fs as pafs
        fs, top = _file_system(root)
        for batch in batches:
            rows = []
            for folder in batch["path"]:
                for info in fs.get_file_info(pafs.FileSelector(f"{top}/{folder}" if folder else top)):
                    rows.append((f"{folder}/{info.base_name}" if folder else info.base_name, info.size or 0,
                                 info.type == pafs.FileType.Directory))
            yield pd.DataFrame(rows, columns=["path", "length", "folder"])

    folders, levels = spark.createDataFrame([("",)], "path string"), []
    while True:
        found = materialize(folders.repartition("path").mapInPandas(listed, "path string, length long, folder boolean"), "listing")
        levels.append(found.filter("NOT folder").select("path", "length"))
        folders = found.filter("folder").select("path")
        if folders.isEmpty():
            return reduce(DataFrame.unionByName, levels)


def storage_totals(spark: SparkSession, root: str) -> DataFrame:
    """M1: per layer/table: bytes of all files; of data files, which no name below the table's hides; of Parquet files,
    and their count."""
    parts = F.split("path", "/")
    hidden = F.exists(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), lambda p: p.rlike("^[_.]"))
    parquet = F.col("path").endswith(".parquet")
    files = all_files(spark, root).filter(parts[0].isin(*LAYERS) & (F.size(parts) > 2)).select(
        parts[0].alias("layer"), parts[1].alias("table_name"), "length", hidden.alias("hidden"), parquet.alias("parquet"))
    size = lambda chosen: F.coalesce(F.sum(F.when(chosen, F.col("length"))), F.lit(0)).cast("long")
    return files.groupBy("layer", "table_name").agg(
        F.sum("length").alias("total_bytes"), size(~F.col("hidden")).alias("data_bytes"),
        size(F.col("parquet")).alias("parquet_bytes"), F.count_if("parquet").alias("parquet_files"))


def file_sizes(spark: SparkSession, table_dir: str) -> DataFrame:
    """Data files of one table with their sizes (input of E7's size distribution)."""
    return list_files(spark, table_dir, "*.parquet").select("path", F.col("length").alias("bytes"))


def open_file(path: str):
    """A seekable input stream for a path as the ``binaryFile`` source gives it."""
    fs, inner = _file_system(path)
    return fs.open_input_file(inner)


def _hash_files(batches):
    import hashlib
    import pandas as pd
    for batch in batches:
        out = []
        for path, length in zip(batch["path"], batch["length"]):
            digest = hashlib.sha256()
            with open_file(path) as handle:
                while block := handle.read(HASH_BLOCK):
                    digest.update(block)
            out.append((path.rsplit("/", 1)[-1], int(length), digest.hexdigest()))
        yield pd.DataFrame(out, columns=["file_name", "bytes", "sha256"])


def fingerprint(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """M2: bytes and SHA-256 of every file, whatever its size: executors stream files in blocks."""
    return list_files(spark, path, glob).mapInPandas(_hash_files, "file_name string, bytes long, sha256 string")


def _hash_ranges(batches):
    import hashlib
    import pandas as pd
    for batch in batches:
        out = []
        for path, k, start, size in zip(batch["path"], batch["k"], batch["start"], batch["size"]):
            digest = hashlib.sha256()
            with open_file(path) as handle:
                handle.seek(int(start))
                left = int(size)
                while left:
                    block = handle.read(min(HASH_BLOCK, left))
                    if not block:
                        raise EOFError(f"{path} is shorter than when it was listed")
                    digest.update(block)
                    left -= len(block)
            out.append((path, int(k), digest.digest()))
        yield pd.DataFrame(out, columns=["path", "k", "digest"])


def hash_tree(spark: SparkSession, path: str, glob: str | None = None, *, range_bytes: int = TREE_RANGE, fanout: int = TREE_FANOUT) -> DataFrame:
    """M2 beside ``fingerprint``, for files of any size: (file_name, bytes, ranges, tree_sha256).

    Leaves are the SHA-256 of a file's byte ranges, read by a task each; a node is the SHA-256 of its
    up to ``fanout`` children's digests in order, level by level up to one root. Spark lists
    no empty files, so these have no row. So a file's tasks are as many as its ranges, and no task joins more than ``fanout`` digests."""
    files = list_files(spark, path, glob)
    count = F.ceil(F.col("length") / range_bytes).cast("long")
    ranges = files.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).select(
        "path", "k", (F.col("k") * range_bytes).alias("start"), F.least(F.lit(range_bytes), F.col("length") - F.col("k") * range_bytes).alias("size"))
    most = ranges.agg(F.max("k")).first()[0]
    level = ranges.repartition("path", "k").mapInPandas(_hash_ranges, "path string, k long, digest binary")
    while most:
        children = F.array_sort(F.collect_list(F.struct("k", "digest")))
        whole = F.aggregate(children, F.lit(b""), lambda acc, c: F.concat(acc, c["digest"]))
        # a file that has its root already keeps it
        level = level.groupBy("path", F.expr(f"k div {fanout}").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first"), F.first("digest").alias("one"),
            whole.alias("whole")).withColumn("alone", (F.col("k") == 0) & (F.col("n") == 1)).select(
            "path", "k", F.when(F.col("alone"), F.col("one")).otherwise(F.unhex(F.sha2("whole", 256))).alias("digest"))
        most //= fanout
    return level.join(files, "path").select(F.regexp_extract("path", "[^/]+$", 0).alias("file_name"), F.col("length").alias("bytes"),
                                            count.alias("ranges"), F.lower(F.hex("digest")).alias("tree_sha256"))


def row_fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent content fingerprint of a table: row count and the exact sum of its row
    hashes. Equal tables always agree; so it can reject equality, never prove it."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(row_hash(df)).alias("hash_sum"))


FOOTER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()),
    T.StructField("row_groups", T.LongType()), T.StructField("rows", T.LongType()),
    T.StructField("column_chunks", T.LongType()), T.StructField("codecs", T.ArrayType(T.StringType())),
])


def _read_footers(batches):
    import pandas as pd
    import pyarrow.parquet as pq
    for batch in batches:
        out = []
        for path, length in zip(batch["path"], batch["length"]):
            with open_file(path) as handle:
                meta = pq.ParquetFile(handle).metadata
            codecs, chunks = set(), 0
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for c in range(group.num_columns):
                    chunks += 1
                    codecs.add(str(group.column(c).compression).upper())
            out.append((path, int(length), meta.num_row_groups, meta.num_rows, chunks, sorted(codecs)))
        yield pd.DataFrame(out, columns=[f.name for f in FOOTER_SCHEMA])


def parquet_footers(spark: SparkSession, table_dir: str) -> DataFrame:
    """One row per Parquet data file with its footer facts (read on executors)."""
    files = list_files(spark, table_dir, "*.parquet")
    return files.mapInPandas(_read_footers, FOOTER_SCHEMA)


def codec_audit(spark: SparkSession, table_dir: str, expected: str | None = None) -> DataFrame:
    """M3: files, bytes, row groups, rows, column chunks and codecs of a table."""
    footers = parquet_footers(spark, table_dir)
    out = footers.agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
        F.sum("row_groups").alias("row_groups"), F.sum("rows").alias("rows"),
        F.sum("column_chunks").alias("column_chunks"),
        # collect_set over per-file codec lists is bounded by the distinct combinations
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("codecs")))).alias("codecs"))
    if expected is not None:
        out = out.withColumn("matches_expected", F.col("codecs") == F.array(F.lit(expected.upper())))
    return out


def report_against_files(spark: SparkSession, root: str, tables: dict[str, dict]) -> DataFrame:
    """Per table of a run's report (``layer/name`` -> rows, total_bytes, parquet_bytes, parquet_files), what it says
    beside what the files' footers and the listing say, and whether all agree."""
    said = spark.createDataFrame([(*k.split("/"), *(v.get(c) for c in SAID)) for k, v in sorted(tables.items())],
                                 "layer string, table_name string, " + ", ".join(f"{c} long" for c in SAID))
    parts = F.split(_relative(root), "/")
    footers = reduce(DataFrame.unionByName, [parquet_footers(spark, f"{root.rstrip('/')}/{k}") for k in sorted(tables)])
    rows = footers.groupBy(parts[0].alias("layer"), parts[1].alias("table_name")).agg(F.sum("rows").alias("rows"))
    found = storage_totals(spark, root).join(rows, ["layer", "table_name"], "full").select(
        "layer", "table_name", *[F.col(c).alias(f"found_{c}") for c in SAID])
    both = said.join(found, ["layer", "table_name"], "left")
    agree = [F.col(c).eqNullSafe(F.col(f"found_{c}")) for c in SAID]
    return both.withColumn("agrees", reduce(lambda a, b: a & b, agree))


#: What a run's report says of each table.
SAID = ("rows", "total_bytes", "parquet_bytes", "parquet_files")


def check_report_against_files(spark: SparkSession, root: str, report: dict) -> dict[str, int]:
    """Raise if a table's files don't hold what the run's report says; returns rows per table."""
    found = report_against_files(spark, root, report["tables"]).collect()  # one row per table
    wrong = {f"{r['layer']}/{r['table_name']}": {c: (r[c], r[f"found_{c}"]) for c in SAID if r[c] != r[f"found_{c}"]}
             for r in found if not r["agrees"]}
    if wrong:
        raise ValueError(f"files disagree with the run's report: {wrong}")
    return {f"{r['layer']}/{r['table_name']}": r["rows"] for r in found}
