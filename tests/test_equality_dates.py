"""Multiset equality (FIXTURES section 4) and date semantics (section 5)."""
from __future__ import annotations

import datetime as dt

import pytest

from adlake.functions.dates import reporting_date_column
from adlake.operators.equality import compare, table_diff
from adlake.session import conf_scope


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_equal_ignores_order_and_column_order(spark):
    left = frame(spark, [(1, None), (1, None), (2, "x")], "id long, value string")
    right = frame(spark, [("x", 2), (None, 1), (None, 1)], "value string, id long")
    assert compare(left, right).equal


def test_multiplicity_matters(spark):
    left = frame(spark, [(1, None), (1, None), (2, "x")], "id long, value string")
    right = frame(spark, [(1, None), (2, "x"), (2, "x")], "id long, value string")
    result = compare(left, right)
    assert not result.equal and result.left_only and result.right_only and not result.schema_differences
    diff = {(r.side, r.multiplicity, r.id, r.value) for r in table_diff(left, right).collect()}
    assert diff == {("left", 1, 1, None), ("right", 1, 2, "x")}


def test_same_totals_wrong_groups(spark):
    ddl = "campaign string, impressions long, clicks long"
    assert not compare(frame(spark, [("a", 10, 1), ("b", 10, 0)], ddl),
                     frame(spark, [("a", 10, 0), ("b", 10, 1)], ddl)).equal


def test_empty_tables(spark):
    empty = frame(spark, [], "id long, value string")
    assert compare(empty, frame(spark, [], "value string, id long")).equal
    other = compare(empty, frame(spark, [], "id string, value string"))
    assert other.schema_differences == {("id", '"long"'), ("id", '"string"')} and not other.equal
    assert not compare(empty, frame(spark, [(1, None)], "id long, value string")).equal


def test_duplicate_names_rejected(spark):
    df = spark.range(1).selectExpr("id", "id")
    with pytest.raises(ValueError, match="more than once"):
        compare(df, df)


CASES = [
    (int(dt.datetime(2017, 5, 5, 15, 59, 59, tzinfo=dt.timezone.utc).timestamp()), dt.date(2017, 5, 5)),
    (int(dt.datetime(2017, 5, 5, 16, 0, 0, tzinfo=dt.timezone.utc).timestamp()), dt.date(2017, 5, 6)),
    (int(dt.datetime(2020, 2, 28, 16, 0, 0, tzinfo=dt.timezone.utc).timestamp()), dt.date(2020, 2, 29)),
    (int(dt.datetime(1969, 12, 31, 15, 59, 59, tzinfo=dt.timezone.utc).timestamp()), dt.date(1969, 12, 31)),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
@pytest.mark.parametrize("impl", ["builtin", "python", "arrow"])
def test_reporting_date_boundaries_any_session_zone(spark, zone, impl):
    df = spark.createDataFrame([(s,) for s, _ in CASES], "seconds long")
    with conf_scope(spark, {"spark.sql.session.timeZone": zone}):
        got = [r.d for r in df.select(reporting_date_column("seconds", impl).alias("d")).collect()]
    assert got == [d for _, d in CASES]


def test_reporting_date_sweep_matches_zoneinfo(spark):
    """1890-2040 (pre-1901 local mean time, the 1986-1991 DST years) in 20k steps."""
    from pyspark.sql import functions as F
    lo, hi = -2524521600, 2208988800
    df = spark.range(lo, hi, (hi - lo) // 20000 + 7, numPartitions=8).select(F.col("id").alias("s"))
    dst = spark.range(515520000, 686000000, 3607, numPartitions=8).select(F.col("id").alias("s"))
    for frame in (df, dst):
        builtin, python = reporting_date_column("s", "builtin"), reporting_date_column("s", "arrow")
        assert frame.filter(builtin != python).count() == 0
