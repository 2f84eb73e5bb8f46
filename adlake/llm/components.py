"""Connected components of a link table, by alternating large-star and small-star steps.

Links stay in tables: every step is two shuffles of the links, and each round is written to
the shared scratch folder, so a lost executor costs at most one round. The number of rounds
grows with the logarithm of the longest path.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adlake.llm.common import materialize


def _smallest(links: DataFrame) -> DataFrame:
    """Per node ``a`` the smallest node it is linked with, itself included. The exchange by
    key after the aggregate lets adaptive execution split a hub on the other side of the join."""
    return links.groupBy("a").agg(F.least("a", F.min("b")).alias("m")).repartition("a")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_smallest(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _smallest(down)
    others = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: integers) but the roots themselves,
    which are the smallest nodes of their components. Self-links and repeats don't matter."""
    links = materialize(links.filter("a != b").select("a", "b").distinct(), "links")
    state = None
    while True:
        links = materialize(_small_star(_large_star(links)), "links")
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(seen)
