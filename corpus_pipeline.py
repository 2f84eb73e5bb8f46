"""A training corpus from ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All
but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlake.llm.common import materialize
from adlake.llm.decontaminate import decontaminate
from adlake.llm.exact_dedup import drop_duplicates
from adlake.llm.language_id import fit, keep_identified
from adlake.llm.packing import pack
from adlake.llm.simhash import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents whose language the calibrated model accepts.

    The model learns from the labels of ``docs`` (rows with a null id, label or text aside). Documents without
    a letter, null and empty texts among them, go here; so does everything if no row has a usable label.
    Repeated rows are judged alike. An empty table stays empty. Columns may have any names."""
    return keep_identified(docs, fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the smallest id of each group of equal texts, a null id only if there is no other;
    one of repeated rows. Null texts, which a stage of its own may still have, count as empty."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the smallest id of each group of near copies, a null id only if there is no other;
    one of repeated rows. Texts without words, null ones too, are near copies of each other."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: benchmark passages cut out, documents that are mostly such passages dropped.

    Null and empty texts have no words and stay as they are, as all documents do if the benchmark is empty.
    Each row is judged by itself, repeated or not; ``n_chars`` follows a cut text."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token sequences of power-of-two lengths. A null or empty text is one piece that holds
    only the end id; each repeated row is packed by itself; other columns are not read."""
    return pack(docs, added_tokens=True)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: A trained model and a tokenizer have no SQL; tests compare the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written once and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
