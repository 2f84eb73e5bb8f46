"""Exact, order-independent table comparison.

Tables are equal when they have the same columns (by name, whatever their order or
nullability) and the same rows as multisets: nulls equal, multiplicity kept, doubles exact.
Both tables are tagged +1/-1, stacked and grouped by every column once; a group whose tags
don't cancel differs. Grouping is null-safe and collapses repeated rows before the shuffle.
"""
from __future__ import annotations

from collections import Counter
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

_TAG = "__side_tag"


class Comparison(NamedTuple):
    """Columns (name, type) that one table lacks or types otherwise; rows only on one side."""

    schema_differences: frozenset
    left_only: bool
    right_only: bool

    @property
    def equal(self) -> bool:
        return not (self.schema_differences or self.left_only or self.right_only)


def schema_differences(left: DataFrame, right: DataFrame) -> frozenset:
    """(name, type) pairs found on one side only; a repeated column name is an error."""
    sides = []
    for df in (left, right):
        repeated = sorted(c for c, n in Counter(df.columns).items() if n > 1)
        if repeated:
            raise ValueError(f"columns named more than once: {repeated}")
        sides.append({(f.name, f.dataType.json()) for f in df.schema})
    return frozenset(sides[0] ^ sides[1])


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs: ``side`` ('left'/'right'), ``multiplicity`` and the row."""
    if differing := schema_differences(left, right):
        raise ValueError(f"tables have other columns: {sorted(differing)}")
    cols = sorted(left.columns)
    stacked = (left.select(*cols, F.lit(1).alias(_TAG))
               .unionByName(right.select(*cols, F.lit(-1).alias(_TAG))))
    diff = stacked.groupBy(*cols).agg(F.sum(_TAG).alias("_net")).filter(F.col("_net") != 0)
    return diff.select(F.when(F.col("_net") > 0, F.lit("left")).otherwise(F.lit("right")).alias("side"),
                       F.abs("_net").cast("long").alias("multiplicity"), *cols)


def compare(left: DataFrame, right: DataFrame) -> Comparison:
    """Compare two tables; only the sides that differ come to the driver."""
    differing = schema_differences(left, right)
    if differing:
        return Comparison(differing, False, False)
    sides = {r["side"] for r in table_diff(left, right).select("side").distinct().collect()}
    return Comparison(differing, "left" in sides, "right" in sides)
