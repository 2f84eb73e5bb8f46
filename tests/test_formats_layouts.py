"""Format round trip (CSV vs Parquet), codecs, date partitioning and table detail."""
from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from adlake.model import TYPED_IMPRESSIONS, Options
from adlake.operators import transforms as tx
from adlake.operators.equality import compare
from adlake.operators.reads import DAY_SECONDS, day_start_epoch, format_query, silver_query
from adlake.operators.storage import codec_audit, storage_totals
from adlake.plans.inspect import plan_text
from adlake.plans.pipeline import gold_table, run_pipeline
from adlake.sources.csv import read_impressions_csv, read_source_csv, write_typed_csv
from adlake.sources.tables import csv_to_parquet, table_detail, write_table
from conftest import IMPRESSIONS, write_sources

DAY_START = 1494172800  # 2017-05-08T00:00:00+08:00


def typed_rows():
    return [(1, DAY_START, 10, 'slot,"quoted"', 0, 1), (1, DAY_START, 10, 'slot,"quoted"', 0, 1),
            (None, DAY_START + 86399, 20, "", 1, 0), (2, DAY_START - 1, 20, "p2", 1, 0),
            (3, DAY_START + 86400, 20, "p2", 0, 1)]


def test_day_start_literal():
    import datetime as dt
    assert day_start_epoch(dt.date(2017, 5, 8)) == DAY_START


def test_csv_parquet_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(typed_rows(), TYPED_IMPRESSIONS)
    csv_path = write_typed_csv(frame, str(tmp_path / "typed.csv"))
    from_csv = read_impressions_csv(spark, csv_path)
    assert compare(from_csv, frame).equal  # quotes, duplicates, typed nulls survive
    result = csv_to_parquet(spark, csv_path, str(tmp_path / "parquet"))
    from_parquet = spark.read.parquet(result["path"])
    assert compare(from_parquet, frame).equal
    for fmt_frame in (from_csv, from_parquet):
        one_day = format_query(fmt_frame, "one_day", DAY_START).agg(F.sum("impressions"), F.sum("clicks")).first()
        assert tuple(one_day) == (3, 2)
        narrow = {r.pid: r.impressions for r in format_query(fmt_frame, "narrow").collect()}
        assert sum(narrow.values()) == 5 and narrow[""] == 1
        wide = format_query(fmt_frame, "wide").collect()
        assert sum(r.sum_clk for r in wide) == 3
    audit = codec_audit(spark, result["path"], "uncompressed").first()
    assert audit.codecs == ["UNCOMPRESSED"] and audit.matches_expected and audit.rows == 5
    assert (audit.files, audit.bytes) == (result["parquet_files"], result["parquet_bytes"])
    assert DAY_SECONDS == 86400


def test_one_day_filter_pushed_to_parquet_scan(spark, tmp_path):
    frame = spark.createDataFrame(typed_rows(), TYPED_IMPRESSIONS)
    frame.write.parquet(str(tmp_path / "p"))
    text = plan_text(format_query(spark.read.parquet(str(tmp_path / "p")), "one_day", DAY_START))
    assert "PushedFilters: [IsNotNull(time_stamp), GreaterThanOrEqual(time_stamp," in text
    assert "ReadSchema: struct<time_stamp:bigint,pid:string,clk:int>" in text


def shifted_sources(tmp_path):
    rows = [(u, ts + 2 * 86400, a, p, n, c) for (u, ts, a, p, n, c) in IMPRESSIONS]
    return write_sources(tmp_path / "raw", impressions=rows)


def test_partitioned_rebuild_equal_and_pruned(spark, tmp_path):
    directory = shifted_sources(tmp_path)
    read = {n: read_source_csv(spark, directory, n) for n in ("impressions", "ads", "user_profiles")}
    plain, parted = str(tmp_path / "plain"), str(tmp_path / "parted")
    run_pipeline(spark, read, plain, Options(codec="zstd"))
    report = run_pipeline(spark, read, parted, Options(codec="zstd", partition_by=("reporting_date",)))
    for name in ("campaign_daily", "audience_daily"):
        assert compare(gold_table(spark, plain, name), gold_table(spark, parted, name)).equal
    imp = spark.read.parquet(f"{parted}/silver/impressions")
    one_day = silver_query(imp, "one_day", __import__("datetime").date(2017, 5, 8)).collect()
    assert sum(r.impressions for r in one_day) == 4 and sum(r.clicks for r in one_day) == 2
    text = plan_text(silver_query(imp, "one_day", __import__("datetime").date(2017, 5, 8)))
    assert "PartitionFilters: [isnotnull(reporting_date" in text
    detail = table_detail(spark, f"{parted}/silver/impressions").first()
    assert detail.partition_columns == ["reporting_date"] and detail.num_files >= 2
    assert table_detail(spark, f"{parted}/silver/ads").first().partition_columns == []
    totals = {(r.layer, r.table_name): r for r in storage_totals(spark, parted).collect()}
    assert totals[("silver", "impressions")].parquet_files == report["tables"]["silver/impressions"]["parquet_files"]
    assert codec_audit(spark, f"{parted}/gold/campaign_daily", "zstd").first().matches_expected


def test_csv_table_format_gives_same_gold(spark, tmp_path):
    directory = shifted_sources(tmp_path)
    read = {n: read_source_csv(spark, directory, n) for n in ("impressions", "ads", "user_profiles")}
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    run_pipeline(spark, read, a, Options())
    run_pipeline(spark, read, b, Options(fmt="csv"))
    for name in ("campaign_daily", "audience_daily"):
        assert compare(gold_table(spark, a, name), gold_table(spark, b, name, Options(fmt="csv"))).equal


def test_delta_requires_package(spark, tmp_path):
    from adlake.session import delta_available
    from adlake.sources.tables import write_table
    if delta_available():
        pytest.skip("delta installed")
    with pytest.raises(RuntimeError, match="delta"):
        write_table(spark.range(1), str(tmp_path), "bronze", "x", Options(fmt="delta"))


def test_silver_from_events_matches_reporting_zone(spark):
    from conftest import SF_SMALL
    from adlake.sources.adapter import bronze_views
    s = tx.silver_views(bronze_views(spark, SF_SMALL))["impressions"]
    bad = s.filter(F.col("reporting_date") != F.to_date(
        F.from_unixtime(F.col("timestamp_seconds") + 8 * 3600, "yyyy-MM-dd"))).count()
    assert bad == 0


def test_a_frequent_value_is_split_by_the_second_column(spark, tmp_path):
    from adlake.session import conf_scope
    rows = spark.range(0, 100_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("day"))
    with conf_scope(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        path = write_table(rows, str(tmp_path), "silver", "t", cluster_by=("day", "id"))
    per_file = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_name").count().collect()]
    assert len(per_file) >= 6 and max(per_file) < 25_000
    with pytest.raises(ValueError, match="clustered"):
        write_table(rows, str(tmp_path), "silver", "u", cluster_by=("id",), partition_by=("day",))


def test_clustered_layout_is_sorted_and_skips_row_groups(spark, tmp_path):
    """A clustered table keeps few files; a one-day read touches only the row groups that may hold the day."""
    import pyarrow.parquet as pq
    from adlake.sources import tables
    rows = spark.range(0, 200_000, 1, 16).select(
        F.col("id"), F.expr("date_add(date'2024-01-01', cast(id % 400 as int))").alias("day"), F.expr("md5(cast(id as string))").alias("v"))
    held = tables.CLUSTER_GROUP_BYTES
    tables.CLUSTER_GROUP_BYTES = 256 * 1024
    try:
        path = tables.write_table(rows, str(tmp_path), "silver", "t", cluster_by=("day",))
        folders = tables.write_table(rows, str(tmp_path), "silver", "folders", partition_by=("day",))
    finally:
        tables.CLUSTER_GROUP_BYTES = held
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) <= 8 < len(os.listdir(folders))
    overlapping = groups = 0
    for f in files:
        meta = pq.ParquetFile(f"{path}/{f}").metadata
        bounds = [(s.min, s.max) for s in (meta.row_group(g).column(1).statistics for g in range(meta.num_row_groups))]
        assert bounds == sorted(bounds) and all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
        groups += len(bounds)
        overlapping += sum(a <= dt.date(2024, 3, 5) <= b for a, b in bounds)
    assert groups > 8 and overlapping <= 2
    day = spark.read.parquet(path).filter("day = date'2024-03-05'")
    assert day.count() == 500 and "PushedFilters: [IsNotNull(day), EqualTo(day,2024-03-05)]" in plan_text(day, "formatted")
    assert spark.read.parquet(path).exceptAll(rows).isEmpty() and spark.read.parquet(path).count() == 200_000
