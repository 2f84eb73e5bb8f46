"""Scalar column expressions (all JVM-side, codegen friendly)."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from adlake.model import NULL_TOKENS, REPORTING_ZONE

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def numeric(name: str, datatype: str, alias: str | None = None) -> Column:
    """Trim spaces; '' or exact 'NULL' -> null; otherwise a strict cast.

    A malformed value raises at execution instead of turning into a silent null,
    whatever ``spark.sql.ansi.enabled`` says: the lenient cast's null on a
    non-null input is turned into an error.
    """
    value = F.trim(F.col(name))
    cleaned = F.when(value.isin(*NULL_TOKENS), F.lit(None)).otherwise(value)
    parsed = cleaned.try_cast(datatype)
    malformed = F.raise_error(F.concat(F.lit(f"CAST_INVALID_INPUT: cannot cast to {datatype} in column {name}: '"),
                                       cleaned, F.lit("'")))
    return (F.when(cleaned.isNotNull() & parsed.isNull(), malformed.cast(datatype))
            .otherwise(parsed).alias(alias or name))


def epoch_seconds(ts_ntz: str | Column) -> Column:
    """Whole seconds since the epoch of a UTC wall-clock ``timestamp_ntz`` (no session zone)."""
    col = F.col(ts_ntz) if isinstance(ts_ntz, str) else ts_ntz
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), col)


def utc_wall_clock(seconds: str | Column) -> Column:
    """Epoch seconds -> ``timestamp_ntz`` in UTC, independent of the session zone."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_add("SECOND", col, F.expr(_EPOCH_NTZ))


def event_timestamp(seconds: str | Column) -> Column:
    """P5: epoch seconds -> instant (TimestampType)."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.timestamp_seconds(col)


def reporting_date(seconds: str | Column, zone: str = REPORTING_ZONE) -> Column:
    """Calendar date of an epoch second in ``zone``.

    Uses the zone database (so historic offsets and DST are right) and never the
    session time zone: ``from_utc_timestamp`` with a literal zone shifts the
    instant by that zone's UTC offset (the zone is resolved once per task), the
    shifted epoch seconds are the local wall clock, and their floor-day is the
    date. Same result as ``to_date(convert_timezone('UTC', zone, ...))`` on every
    second from 1890 to 2040, about 8x cheaper.
    """
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    local_seconds = F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(col), zone))
    return F.date_from_unix_date(F.floor(local_seconds / 86400).cast("int"))


def missing_flag(marker: str) -> Column:
    """1 when an outer-join marker column is null, else 0 (long)."""
    return F.col(marker).isNull().cast("long")


def ratio(numerator: str, denominator: str) -> Column:
    """Double division (the denominator is >= 1 by construction)."""
    return F.col(numerator) / F.col(denominator)
