"""Read workloads over impressions.

A workload is a row of a table: which rows it wants and what it sums per placement. Its
predicate is on plain columns with literal bounds, so Catalyst pushes it into the scan
(row-group skipping, or partition pruning on a date-partitioned table).
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from adlake.model import TYPED_IMPRESSIONS
from adlake.operators.ranking import ranked

# --- Fixed values of the read workloads (our test data's calendar) -----------------
# One reporting day and its half-open epoch range [DAY_START, DAY_START + 86400):
# 2024-01-08T00:00:00+08:00.
ONE_DAY = dt.date(2024, 1, 8)
DAY_START = 1704643200
DAY_SECONDS = 86400
# ---------------------------------------------------------------------------------------


class Workload(NamedTuple):
    group: str
    sums: dict[str, str]
    wanted: Callable[..., Column] | None = None  # from the workload's day

    def run(self, frame: DataFrame, day) -> DataFrame:
        rows = frame if self.wanted is None else frame.where(self.wanted(day))
        totals = [F.sum(c).cast("long").alias(name) for name, c in self.sums.items()]
        return rows.groupBy(self.group).agg(F.count(F.lit(1)).alias("impressions"), *totals)


def _seconds_of(start: int) -> Column:
    t = F.col("time_stamp")
    return (t >= F.lit(start)) & (t < F.lit(start + DAY_SECONDS))


def _days(count: int) -> Callable[[dt.date], Column]:
    def wanted(first: dt.date) -> Column:
        date = F.col("reporting_date")
        if count == 1:
            return date == F.lit(first)
        return date.between(F.lit(first), F.lit(first + dt.timedelta(days=count - 1)))
    return wanted


_SUMMED = [f.name for f in TYPED_IMPRESSIONS.fields if f.name != "pid"]
#: A3-A5: over typed impressions (CSV or Parquet); the day is its first epoch second.
FORMAT_WORKLOADS = {
    "narrow": Workload("pid", {"clicks": "clk"}),
    "wide": Workload("pid", {f"sum_{c}": c for c in _SUMMED}),
    "one_day": Workload("pid", {"clicks": "clk"}, _seconds_of),
}
#: Over Silver impressions; the day is a date.
SILVER_WORKLOADS = {
    "one_day": Workload("placement_id", {"clicks": "clicked"}, _days(1)),
    "three_days": Workload("placement_id", {"clicks": "clicked"}, _days(3)),
    "full_period": Workload("placement_id", {"clicks": "clicked"}),
}


def day_start_epoch(day: dt.date, utc_offset_hours: int = 8) -> int:
    """Epoch second of local midnight of ``day`` at a fixed offset (for literal bounds)."""
    midnight = dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone(dt.timedelta(hours=utc_offset_hours)))
    return int(midnight.timestamp())


def typed_impressions(bronze_impressions: DataFrame) -> DataFrame:
    """Typed 6-column impressions of the format experiment, from Bronze strings."""
    return bronze_impressions.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                       for f in TYPED_IMPRESSIONS])


def _pick(workloads: dict[str, Workload], name: str) -> Workload:
    if name not in workloads:
        raise ValueError(f"no workload {name!r}; there are {sorted(workloads)}")
    return workloads[name]


def format_query(frame: DataFrame, workload: str, day_start: int = DAY_START) -> DataFrame:
    return _pick(FORMAT_WORKLOADS, workload).run(frame, day_start)


def silver_query(frame: DataFrame, workload: str, day: dt.date = ONE_DAY) -> DataFrame:
    return _pick(SILVER_WORKLOADS, workload).run(frame, day)


def in_order(report: DataFrame, *descending: str) -> DataFrame:
    """O2: a report in a total order, whatever partitions it came from: by the given columns,
    largest first, then by all others; ``place`` counts from 1. The order and the places come
    from a range sort, so a report of any length is dealt over tasks."""
    rest = [F.col(c).asc_nulls_last() for c in sorted(report.columns) if c not in descending]
    order = [F.col(c).desc_nulls_last() for c in descending] + rest
    return ranked(report, order, "place").orderBy("place")
