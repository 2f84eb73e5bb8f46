"""Places in a total order and exact order statistics, with no task that sees all rows.

Rows are dealt over partitions by ranges of the order and sorted there. A row's place is its
place in the partition plus the sizes of the partitions before it, of which there is one
small row per partition. The sorted rows are written once to the shared scratch folder, so
the sizes and the places come from the same partitions, whatever executors are lost.
"""
from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

from adlake.session import materialize

#: ``monotonically_increasing_id`` holds the partition above these bits and the row's place below.
_PLACE_BITS = 33


def _fresh(columns: list[str], base: str) -> str:
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def _in_ranges(df: DataFrame, order: list[Column], at: str, name: str) -> DataFrame:
    """``df`` sorted by ranges, with the partition and the place there packed into ``at``."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranged.withColumn(at, F.monotonically_increasing_id()), name)


def ranked(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """``df`` with each row's place in ``order``, counted from 1 without gaps.

    Rows that ``order`` doesn't tell apart get neighbouring places in no stated order. They
    share a partition, so a caller with many of those adds a column that tells them apart."""
    if rank.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the frame has a column {rank!r}")
    at, part, before = (_fresh([*df.columns, rank], c) for c in ("__at", "__part", "__before"))
    rows = _in_ranges(df, order, at, "ranked")
    parts = F.shiftright(at, _PLACE_BITS)
    # one row per partition of the sort, however many rows there are
    sizes = sorted((r[0], r[1]) for r in rows.groupBy(parts.alias(part)).count().collect())
    starts = itertools.accumulate((n for _, n in sizes), initial=0)
    offsets = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], f"`{part}` long, `{before}` long")
    place = F.col(at).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + F.col(before) + 1
    joined = rows.withColumn(part, parts).join(F.broadcast(offsets), part)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], place.alias(rank))


def values_at(df: DataFrame, by: list[str], value: str, picks: dict[str, tuple[int, int, int]]) -> DataFrame:
    """Per group the exact values at chosen places of its sorted non-null ``value``s.

    ``picks`` maps a result column to (a, b, c): the place ``floor((a * n + b) / c)`` among the
    group's n values, counted from 1; (1, 1, 2) and (1, 2, 2) are the two middle ones. Values
    are counted before they are dealt by (group, value) ranges, so a frequent value is one
    row per map task and a group of any size is spread over many tasks. Groups without
    values have no row; null group keys are groups like any other."""
    names = {c: f"__by_{i}" for i, c in enumerate(by)}
    groups = list(names.values())
    source = df.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(value).alias("__v")).filter("__v IS NOT NULL")
    counted = source.groupBy(*groups, "__v").agg(F.count(F.lit(1)).alias("__n"))
    rows = _in_ranges(counted, [F.col(c) for c in (*groups, "__v")], "__at", "counted-values")
    rows = rows.withColumn("__part", F.shiftright("__at", _PLACE_BITS))
    # per group at most one row for each partition of the sort
    totals = rows.groupBy(*groups, "__part").agg(F.sum("__n").alias("__held"))
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(c).alias(f"{c}t") for c in groups], F.col("__part").alias("__part_t"),
                           F.coalesce(F.sum("__held").over(earlier), F.lit(0)).alias("__start"),
                           F.sum("__held").over(whole).alias("__total"), "__held")
    wanted = [F.expr(f"({a} * __total + {b}) div {c}") for a, b, c in picks.values()]
    inside = [(w > F.col("__start")) & (w <= F.col("__start") + F.col("__held")) for w in wanted]
    holding = totals.filter(F.expr("false") if not inside else _any(inside))
    same = [F.col(c).eqNullSafe(F.col(f"{c}t")) for c in groups] + [F.col("__part") == F.col("__part_t")]
    # only partitions that hold a wanted place are summed up row by row
    found = rows.join(holding, _all(same))
    running = Window.partitionBy("__part", *groups).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("__end", F.col("__start") + F.sum("__n").over(running))
    here = [F.when((w > F.col("__end") - F.col("__n")) & (w <= F.col("__end")), F.col("__v")) for w in wanted]
    result = found.groupBy(*groups).agg(*[F.max(h).alias(c) for h, c in zip(here, picks)])
    return result.select(*[F.col(n).alias(c) for c, n in names.items()], *picks)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out
