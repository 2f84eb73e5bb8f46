"""Reporting-date implementations: built-in expression and two Python UDFs.

The Python ones exist to measure the cost of leaving the JVM; all give the same date for
every input, in any session or process time zone. The UDF is made of a closure over the
zone's name, so workers need no import of this package.
"""
from __future__ import annotations

from functools import partial

from pyspark.sql import Column, functions as F

from adlake.functions.columns import reporting_date
from adlake.model import REPORTING_ZONE


def _by_udf(seconds: str, zone: str, arrow: bool) -> Column:
    def local_date(value):
        import datetime as dt
        import zoneinfo
        if value is not None:
            instant = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=value)
            return instant.astimezone(zoneinfo.ZoneInfo(zone)).date()
    return F.udf(local_date, "date", useArrow=arrow)(F.col(seconds))


IMPLEMENTATIONS = {
    "builtin": reporting_date,
    "python": partial(_by_udf, arrow=False),  # X1: BatchEvalPython, a row at a time
    "arrow": partial(_by_udf, arrow=True),  # X2: ArrowEvalPython, in batches
}


def reporting_date_column(seconds: str, impl: str = "builtin", zone: str = REPORTING_ZONE) -> Column:
    if impl not in IMPLEMENTATIONS:
        raise ValueError(f"unknown date implementation {impl!r}")
    return IMPLEMENTATIONS[impl](seconds, zone)
