"""Named presets of physical options (L1-L9): one control, one change each.

A variant is data, not a copied pipeline: every preset is an :class:`Options`
that differs from the control in exactly the declared settings.
"""
from __future__ import annotations

from adlake.model import Options

CONTROL = Options()

PRESETS: dict[str, tuple[Options, str]] = {
    "control": (CONTROL, "Parquet, Snappy, broadcast-eligible joins, AQE coalescing on"),
    "csv_tables": (CONTROL.with_(fmt="csv"), "L1: tables stored as CSV instead of Parquet"),
    "zstd": (CONTROL.with_(codec="zstd"), "L2: ZSTD instead of Snappy"),
    "date_partitioned": (CONTROL.with_(codec="zstd", partition_by=("reporting_date",)),
                         "L3: silver impressions partitioned by reporting_date"),
    "date_clustered": (CONTROL.with_(codec="zstd", cluster_by=("reporting_date", "timestamp_seconds")),
                       "L3: silver impressions sorted by reporting_date within files"),
    "ads_merge": (CONTROL.with_(ads_join="merge"), "L4: sort-merge join for the ads dimension"),
    "profiles_merge": (CONTROL.with_(profile_join="merge"), "L5: sort-merge join for profiles"),
    "ads_broadcast": (CONTROL.with_(ads_join="broadcast", profile_join="broadcast"),
                      "L4/L5: explicit broadcast of both dimensions behind a size check"),
    "shuffle_hash": (CONTROL.with_(ads_join="shuffle_hash", profile_join="shuffle_hash"),
                     "L4/L5: shuffled hash joins"),
    "shuffle_32": (CONTROL.with_(shuffle_partitions=32), "L6: 32 initial shuffle partitions"),
    "cached": (CONTROL.with_(cache=True), "L7: shared enrichment cached for both reports"),
    "no_coalesce": (CONTROL.with_(coalesce=False), "L8: AQE post-shuffle coalescing off"),
    "python_udf": (CONTROL.with_(date_impl="python"), "L9: reporting date by a row-at-a-time Python UDF"),
    "arrow_udf": (CONTROL.with_(date_impl="arrow"), "L9: reporting date by an Arrow-batched Python UDF"),
    "shared_rollup": (CONTROL.with_(shared_rollup=True),
                      "both reports from one rollup of a single enrichment pass"),
}


def declared_changes(name: str) -> dict:
    """The option fields that differ from the control (must be the only difference)."""
    opts = PRESETS[name][0]
    return {k: v for k, v in opts.__dict__.items() if CONTROL.__dict__[k] != v}
