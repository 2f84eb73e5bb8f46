"""Total order and order statistics without a task that sees all rows."""
from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from adlake.operators.ranking import _in_ranges, ranked, values_at
from adlake.operators.reads import in_order
from adlake.operators.stats import MIDDLE, distribution, right_vs_left, size_distribution
from adlake.plans.inspect import plan_text
from adlake.session import conf_scope


def test_a_million_rows_over_many_partitions(spark):
    n = 1_000_000
    rows = spark.range(0, n, 1, 16).select(((F.col("id") * 7919) % n).alias("v"), F.lit("x").alias("tag"))
    out = ranked(rows, [F.col("v").desc()])
    assert out.columns == ["v", "tag", "rank"]
    assert out.filter(F.col("rank") != n - F.col("v")).count() == 0
    assert out.agg(F.countDistinct("rank")).first()[0] == n


def test_no_window_without_partition(spark):
    report = spark.range(1000).select((F.col("id") % 7).alias("impressions"), F.col("id").cast("string").alias("pid"))
    out = in_order(report, "impressions")
    assert "SinglePartition" not in plan_text(out) and "Window" not in plan_text(out)
    got = [tuple(r) for r in out.collect()]
    want = sorted(((i % 7, str(i)) for i in range(1000)), key=lambda r: (-r[0], r[1]))
    assert got == [(*r, k + 1) for k, r in enumerate(want)]


def test_ties_nulls_and_empty(spark):
    rows = spark.createDataFrame([(None,), (3,), (3,), (1,), (None,)], "v int")
    got = sorted((r["rank"], r["v"]) for r in ranked(rows, [F.col("v").desc_nulls_last()]).collect())
    assert [v for _, v in got] == [3, 3, 1, None, None] and [k for k, _ in got] == [1, 2, 3, 4, 5]
    assert ranked(rows.limit(0), [F.col("v")]).count() == 0
    assert in_order(rows.limit(0), "v").columns == ["v", "place"]
    with pytest.raises(ValueError, match="rank"):
        ranked(rows.withColumnRenamed("v", "Rank"), [F.col("Rank")])


def test_one_group_of_many_distinct_values(spark):
    n = 10_000_000
    big = spark.range(0, n, 1, 16).select(F.lit("big").alias("g"), ((F.col("id") * 7919) % n).alias("v"))
    small = spark.createDataFrame([("small", 5), ("small", 5), ("small", 9), ("none", None), (None, 4)], "g string, v long")
    got = {r["g"]: r for r in size_distribution(big.unionByName(small), ["g"], "v").collect()}
    assert tuple(got["big"])[1:] == (n, n * (n - 1) // 2, 0, (n - 1) / 2, n * 95 // 100 - 1, n - 1)
    assert tuple(got["small"])[1:] == (3, 19, 5, 5.0, 9, 9)
    assert tuple(got["none"])[1:] == (0, None, None, None, None, None)
    assert tuple(got[None])[1:] == (1, 4, 4, 4.0, 4, 4)


def test_a_group_is_spread_over_tasks(spark):
    rows = spark.range(0, 200_000, 1, 8).select(F.lit(1).alias("g"), (F.col("id") * 3).alias("v"))
    assert values_at(rows, ["g"], "v", MIDDLE).first()[1:] == (299_997, 300_000)
    with conf_scope(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        dealt = _in_ranges(rows, [F.col("g"), F.col("v")], "at", "test")
    parts = dealt.groupBy(F.shiftright("at", 33)).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 100_000


def test_statistics_against_plain_python(spark):
    rows = [(g, s, (i * 37 % 11) / 4) for g in ("a", "b") for s in ("left", "right") for i in range(5 + len(g + s))]
    frame = spark.createDataFrame([*rows, ("c", "left", 1.0), ("d", "left", 0.0), ("d", "right", 2.0)], "g string, s string, v double")
    got = {(r["g"], r["s"]): r for r in distribution(frame, ["g", "s"], "v", with_samples=True).collect()}
    for key, r in got.items():
        values = sorted(v for g, s, v in map(tuple, frame.collect()) if (g, s) == key)
        assert r["n"] == len(values) and r["median"] == statistics.median(values)
        assert r["samples"] == ",".join(str(v) for v in values)
        assert r["stdev"] == (pytest.approx(statistics.stdev(values)) if len(values) > 1 else None)
    change = {r["g"]: r for r in right_vs_left(frame, ["g"], "s", "v").collect()}
    left, right = (got["a", s]["median"] for s in ("left", "right"))
    assert change["a"]["right_vs_left_percent"] == pytest.approx((right - left) / left * 100)
    assert tuple(change["c"])[1:] == (1.0, None, None) and tuple(change["d"])[1:] == (0.0, 2.0, None)
    overall = distribution(frame, [], "v").first()
    assert overall["median"] == statistics.median(r["v"] for r in frame.collect())
