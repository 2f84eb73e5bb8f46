"""Statistics operators (FIXTURES section 6) and the driver contract."""
from __future__ import annotations

import __spark_entry__ as entry
from adlake.model import RECORDED_SETTINGS
from adlake.operators.stats import (distribution, right_vs_left, settings_diff, settings_frame,
                                    size_distribution, undeclared)


def test_distribution_median_max_and_single_sample(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 99), ("b", 5)], "g string, v long")
    rows = {r.g: r for r in distribution(df, ["g"], "v", with_samples=True).collect()}
    assert (rows["a"].median, rows["a"].max, rows["a"].samples) == (2.0, 99, "1,2,99")
    assert rows["b"].stdev is None


def test_size_distribution_nearest_rank(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 21)], "v long")
    row = size_distribution(df, [], "v").first()
    assert (row["count"], row.total, row.min, row.median, row.p95, row.max) == (20, 210, 1, 10.5, 19, 20)


def test_right_vs_left_percent_and_zero_left(spark):
    df = spark.createDataFrame([("m", "left", 10.0), ("m", "left", 20.0), ("m", "right", 8.0), ("m", "right", 10.0),
                                ("z", "left", 0.0), ("z", "right", 5.0)], "metric string, side string, v double")
    rows = {r.metric: r for r in right_vs_left(df, ["metric"], "side", "v").collect()}
    assert rows["m"].right_vs_left_percent == -40.0
    assert rows["z"].right_vs_left_percent is None


def test_settings_diff_declared_and_undeclared(spark):
    ref = spark.createDataFrame([("codec", "snappy"), ("mem", "2g"), ("gone", None)], "key string, value string")
    cur = spark.createDataFrame([("codec", "zstd"), ("mem", "2g"), ("new", "1")], "key string, value string")
    diff = settings_diff(ref, cur, declared=("codec",))
    assert {r.key for r in diff.collect()} == {"codec", "new"}
    assert undeclared(diff) == ["new"]
    frame = settings_frame(spark, RECORDED_SETTINGS)
    assert frame.count() == len(RECORDED_SETTINGS)
    assert settings_diff(frame, frame).isEmpty()


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"reporting_date", "campaign_id", "advertiser_id", "impressions", "clicks",
                               "missing_profile_impressions", "ctr"}
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) >= 55


def _report(run_id="a", status="succeeded", sources=None, tables=("gold/x",), codec="snappy", spark_v="4.1.2", python="3.13"):
    import json
    return json.dumps({"run_id": run_id, "status": status,
                       "sources": sources or {"raw_sample.csv": {"rows": 5, "row_hash_sum": "123"}},
                       "tables": {t: {"rows": 1} for t in tables},
                       "environment": {"spark": spark_v, "python": python, "java": "17", "master": "local[8]",
                                       "driver_memory": "8g", "spark_sql_settings": {
                           "spark.sql.parquet.compression.codec": codec, "spark.sql.shuffle.partitions": "200"}}})


def _rows(spark, text):
    from adlake.operators.stats import report_rows
    return report_rows(spark.createDataFrame([(text,)], "value string")).drop("run_id")


def test_run_comparability_rules(spark):
    import pytest
    from adlake.operators.stats import validate_comparable
    ref = _rows(spark, _report())
    assert validate_comparable(ref, _rows(spark, _report(run_id="b"))) == {}
    for bad in (_report(status="failed"), _report(sources={"raw_sample.csv": {"rows": 6, "row_hash_sum": "1"}}),
                _report(tables=("gold/x", "gold/y")), _report(spark_v="4.0.1"), _report(python="3.12"), _report(codec="zstd")):
        with pytest.raises(ValueError, match="not comparable"):
            validate_comparable(ref, _rows(spark, bad))
    diff = validate_comparable(ref, _rows(spark, _report(codec="zstd")),
                               declared=("spark.sql.parquet.compression.codec",))
    assert diff == {"settings.spark.sql.parquet.compression.codec": ("snappy", "zstd")}
