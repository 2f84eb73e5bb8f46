"""Join-strategy selection for dimension sides.

``auto`` adds no hint: Catalyst broadcasts only when its size statistics are
under ``spark.sql.autoBroadcastJoinThreshold`` and AQE may switch a sort-merge
join to a broadcast (or split skewed partitions) at runtime from real shuffle
sizes. ``broadcast`` is honoured only after a size check of the projected side;
beyond the limit the join falls back to the planner's shuffle join.
"""
from __future__ import annotations

import re
import uuid
import warnings

from pyspark.sql import DataFrame, functions as F

_UNITS = {"B": 1, "KiB": 1024, "MiB": 1024 ** 2, "GiB": 1024 ** 3, "TiB": 1024 ** 4,
          "PiB": 1024 ** 5, "EiB": 1024 ** 6}
_STATS = re.compile(r"Statistics\(sizeInBytes=([0-9.E+]+)\s*(B|KiB|MiB|GiB|TiB|PiB|EiB)")


def _cost_text(df: DataFrame) -> str:
    spark = df.sparkSession
    name = f"adlake_size_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    try:
        return spark.sql(f"EXPLAIN COST SELECT * FROM {name}").first()[0]
    finally:
        spark.catalog.dropTempView(name)


def _bytes(match) -> float:
    return float(match.group(1)) * _UNITS[match.group(2)]


def estimated_size_bytes(df: DataFrame, *, bounded_by_inputs: bool = False) -> float:
    """Catalyst's size estimate of ``df`` (optimized plan root), via ``EXPLAIN COST``.

    Without CBO, a join's estimate is the product of its children's, so with
    ``bounded_by_inputs`` the result is capped by the summed size of the plan's
    leaf relations (what the query actually reads)."""
    text = _cost_text(df)
    optimized = text.split("== Physical Plan ==")[0]
    match = _STATS.search(optimized)
    if not match:
        return float("inf")
    root = _bytes(match)
    if not bounded_by_inputs:
        return root
    leaves = [_bytes(m) for line in optimized.splitlines()
              if "Relation" in line for m in [_STATS.search(line)] if m]
    return min(root, sum(leaves)) if leaves else root


def dimension_side(df: DataFrame, strategy: str, broadcast_limit: int) -> DataFrame:
    """Apply a join strategy to the (right) dimension side of a left join."""
    if strategy == "auto":
        return df
    if strategy == "broadcast":
        size = estimated_size_bytes(df)
        if size <= broadcast_limit:
            return F.broadcast(df)
        warnings.warn(f"dimension estimated at {size:.0f} B exceeds the broadcast limit "
                      f"{broadcast_limit} B; using a shuffle join", stacklevel=2)
        return df
    if strategy in ("merge", "shuffle_hash"):
        return df.hint(strategy)
    raise ValueError(f"unknown join strategy {strategy!r}")


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
#: From here on an estimate is Catalyst's default for sources whose size it doesn't know.
UNKNOWN_BYTES = float(1 << 62)


def shuffle_partitions_for(df: DataFrame, target_bytes: int = SHUFFLE_PARTITION_BYTES) -> int | None:
    """Initial shuffle partitions so that each holds about ``target_bytes`` of ``df``, never
    fewer than the default parallelism; None (keep the session's number) for unknown sizes.
    AQE can coalesce partitions that turn out small but not split ones that are too big."""
    size = estimated_size_bytes(df, bounded_by_inputs=True)
    if size >= UNKNOWN_BYTES:
        return None
    return max(df.sparkSession.sparkContext.defaultParallelism, int(size // target_bytes) + 1)


def _threshold_bytes(spark) -> float:
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().removesuffix("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1], 1)
    return float(text.rstrip("kmg")) * scale


def shuffles_the_fact(dim: DataFrame, strategy: str, broadcast_limit: int) -> bool:
    """Whether joining the fact to this side is planned as a shuffle of the fact."""
    limit = {"auto": _threshold_bytes(dim.sparkSession), "broadcast": broadcast_limit}.get(strategy, -1)
    return estimated_size_bytes(dim) > limit
