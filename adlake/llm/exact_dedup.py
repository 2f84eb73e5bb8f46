"""Operator 1: exact dedup by 128-bit content hash, native DataFrame code only.

Texts are equal when identical after every run of ASCII white space becomes one space.
Only 16-byte hashes are counted over all rows. Texts move only for rows whose hash occurs
more than once: those are grouped by hash *and* whole text, so the comparison is of bytes
and two texts with one hash stay apart.

Scale: the hash count and the text grouping aggregate before they shuffle, so a text that
a third of all rows share costs one row per map task. Both are written to the shared
scratch folder; the joins that follow therefore read plain shuffles on both sides, which
adaptive execution may split when one key is hot, or broadcast when the side is small.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adlake.llm.common import fresh, materialize, refuse_clashes, text_column

WHITE_SPACE = r"[\x20\x09-\x0D]+"
RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE_SPACE, " ")


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: RESULT columns, then the ``carry`` columns of ``docs``.

    Null text counts as empty, and empty texts equal each other. A null id ranks after
    every other id. Rows that repeat one id and text form a group like any other: exactly one
    of them is kept. An empty table gives an empty result.
    ``carry`` columns come under their own names, so they may not be named like RESULT."""
    refuse_clashes(carry, (*RESULT, "__norm", "__h", "__uid", "__first"))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), normalised(text_column(docs, text_col)).alias("__norm"),
                       *[docs[c] for c in carry])
    rows = rows.withColumn("__h", F.unhex(F.md5("__norm")))
    repeated = materialize(rows.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__h"),
                           "dedup-hashes")
    sha = F.sha2("__norm", 256).alias("text_sha256")
    single = rows.select("doc_id", "__h", sha, *carry).join(repeated, "__h", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", *carry)
    members = materialize(rows.join(repeated, "__h").withColumn("__uid", F.monotonically_increasing_id()),
                          "dedup-members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("__uid").alias("uid")))
    groups = materialize(members.groupBy("__h", "__norm").agg(first.alias("__first"), F.count(F.lit(1)).alias("group_size")),
                         "dedup-groups")
    copies = members.join(groups, ["__h", "__norm"]).select(
        "doc_id", F.col("__first.id").alias("keep_id"), "group_size",
        (F.col("__uid") == F.col("__first.uid")).alias("kept"), sha, *carry)
    return single.unionByName(copies)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with their own columns, whatever
    those are named. Null texts count as empty and are one group with the empty ones. A null id ranks after
    all others; of repeated rows one stays. An empty table gives an empty result."""
    names = {c: fresh(docs, f"__carry_{i}") for i, c in enumerate(docs.columns)}
    inner = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in names.items()])
    marked = mark_duplicates(inner, names[id_col], names[text_col], tuple(names.values()))
    return marked.filter("kept").select(*[F.col(n).alias(c) for c, n in names.items()])
