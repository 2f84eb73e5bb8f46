"""Hand-checkable fixture: cleaning, enrichment, reports, checks, full rebuild."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adlake.model import Options
from adlake.operators import quality as qc
from adlake.operators import transforms as tx
from adlake.operators.equality import compare
from adlake.plans.pipeline import gold_table, load_report, run_pipeline
from adlake.sources.csv import read_source_csv
from conftest import ADS, IMPRESSIONS, write_sources


def sources(spark, directory):
    return {name: read_source_csv(spark, directory, name) for name in ("impressions", "ads", "user_profiles")}


@pytest.fixture()
def fixture_dir(tmp_path):
    return write_sources(tmp_path / "raw")


def test_bronze_is_strings_with_provenance_and_trimmed_header(spark, fixture_dir):
    bronze = sources(spark, fixture_dir)
    profiles = bronze["user_profiles"]
    assert profiles.columns[-2:] == ["new_user_class_level", "source_file"]
    assert all(t == "string" for _, t in profiles.dtypes)
    assert {r.source_file for r in bronze["ads"].collect()} == {"ad_feature.csv"}
    assert bronze["ads"].filter(F.col("brand") == "NULL").count() == 1  # literal NULL stays text


def test_cleaning_nulls_outliers_and_types(spark, fixture_dir):
    silver = tx.silver_views(sources(spark, fixture_dir))
    ads = {r.adgroup_id: r for r in silver["ads"].collect()}
    assert ads[10].brand_id is None and ads[20].product_price == 99999999.0
    users = {r.user_id: r for r in silver["user_profiles"].collect()}
    assert users[1].pvalue_level is None and users[2].new_user_class_level is None
    assert dict(silver["impressions"].dtypes)["reporting_date"] == "date"


def test_totals_counts_ctr_and_timezone(spark, fixture_dir):
    silver = tx.silver_views(sources(spark, fixture_dir))
    totals = qc.fact_totals(silver["impressions"], silver["user_profiles"]).first()
    assert (totals.impressions, totals.clicks, totals.missing_profile_impressions) == (5, 2, 1)
    assert (totals.first_date, totals.last_date) == ("2017-05-06", "2017-05-07")
    e = tx.enrich(silver)
    campaign = {(r.reporting_date, r.campaign_id): (r.impressions, r.clicks, r.ctr)
                for r in tx.campaign_daily(e).collect()}
    assert campaign == {(dt.date(2017, 5, 6), 100): (2, 1, 0.5), (dt.date(2017, 5, 6), 200): (2, 1, 0.5),
                        (dt.date(2017, 5, 7), 100): (1, 0, 0.0)}
    audience = tx.audience_daily(e).collect()
    unknown = [r for r in audience if r.age_level is None]
    assert len(audience) == 4 and len(unknown) == 1
    assert (unknown[0].impressions, unknown[0].missing_profile_impressions) == (1, 1)


def test_overall_ctr_is_ratio_of_sums(spark, fixture_dir):
    silver = tx.silver_views(sources(spark, fixture_dir))
    e = tx.enrich(silver)
    row = tx.overall_ctr(tx.campaign_daily(e)).first()
    assert (row.impressions, row.clicks, row.ctr) == (5, 2, 0.4)


def test_duplicate_ad_key_rejected(spark, fixture_dir):
    silver = tx.silver_views(sources(spark, fixture_dir))
    ads = silver["ads"].unionByName(silver["ads"].filter("adgroup_id = 10"))
    with pytest.raises(ValueError, match="repeated values of adgroup_id"):
        qc.validate_dimensions(ads, silver["user_profiles"])


def test_bad_click_flag_rejected(spark, tmp_path):
    bad = [IMPRESSIONS[0][:5] + ("2",)] + IMPRESSIONS[1:]
    silver = tx.silver_views(sources(spark, write_sources(tmp_path / "raw", impressions=bad)))
    with pytest.raises(ValueError, match="1 rows break the row rules"):
        qc.validate_impressions(silver["impressions"], silver["ads"], silver["user_profiles"])


def test_missing_ad_rejected(spark, tmp_path):
    silver = tx.silver_views(sources(spark, write_sources(tmp_path / "raw", ads=ADS[:1])))
    with pytest.raises(ValueError, match="2 rows have no ad"):
        qc.validate_impressions(silver["impressions"], silver["ads"], silver["user_profiles"])


def test_malformed_number_raises_not_null(spark, tmp_path):
    bad = [("1", "broken", "10", "p1", "0", "1")] + IMPRESSIONS[1:]
    silver = tx.silver_views(sources(spark, write_sources(tmp_path / "raw", impressions=bad)))
    with pytest.raises(PySparkException):
        silver["impressions"].collect()


def test_wrong_header_raises(spark, tmp_path):
    directory = write_sources(tmp_path / "raw", impressions_header=["wrong", "header", "a", "b", "c", "d"])
    with pytest.raises(ValueError, match="wanted"):
        read_source_csv(spark, directory, "impressions")


def test_reconcile_detects_wrong_groups(spark, fixture_dir):
    silver = tx.silver_views(sources(spark, fixture_dir))
    e = tx.enrich(silver)
    expected = qc.fact_totals(silver["impressions"], silver["user_profiles"]).first().asDict()
    gold = tx.campaign_daily(e)
    assert qc.validate_gold(gold, expected, "campaign_daily")["rows"] == 3
    with pytest.raises(ValueError, match="3 clicks too many"):
        qc.validate_gold(gold.withColumn("clicks", F.col("clicks") + 1), expected, "campaign_daily")


def test_two_rebuilds_equal_and_protected(spark, fixture_dir, tmp_path):
    roots = [str(tmp_path / f"run{i}") for i in (1, 2)]
    reports = [run_pipeline(spark, sources(spark, fixture_dir), root, Options()) for root in roots]
    assert all(r["status"] == "succeeded" for r in reports)
    assert reports[0]["tables"]["gold/campaign_daily"]["rows"] == 3
    assert reports[0]["tables"]["gold/audience_daily"]["rows"] == 4
    for name in ("campaign_daily", "audience_daily"):
        assert compare(gold_table(spark, roots[0], name), gold_table(spark, roots[1], name)).equal
    assert load_report(spark, f"{roots[0]}/_report")["status"] == "succeeded"
    kept = load_report(spark, f"{roots[0]}/_report")
    with pytest.raises(FileExistsError):  # the root belongs to a run; nothing in it changes
        run_pipeline(spark, sources(spark, fixture_dir), roots[0], Options())
    assert load_report(spark, f"{roots[0]}/_report") == kept
    assert compare(gold_table(spark, roots[0], "campaign_daily"), gold_table(spark, roots[1], "campaign_daily")).equal


@pytest.mark.parametrize("release_fails", [False, True])
@pytest.mark.parametrize("options", [Options(cache=True), Options(shared_rollup=True)])
def test_first_error_survives_a_failing_release(spark, fixture_dir, tmp_path, monkeypatch, options, release_fails):
    from adlake.plans import pipeline
    released = []

    def between_reports(*_):
        raise RuntimeError("between reports")

    def release(run, shared, really=pipeline.release):
        really(run, shared)
        released.append(shared.storageLevel.useMemory)
        if release_fails:
            raise RuntimeError("while releasing")

    monkeypatch.setattr(pipeline.qc, "validate_gold", between_reports)
    monkeypatch.setattr(pipeline, "release", release)
    root = str(tmp_path / "run")
    with pytest.raises(RuntimeError, match="between reports"):
        run_pipeline(spark, sources(spark, fixture_dir), root, options)
    report = load_report(spark, f"{root}/_report")
    assert report["status"] == "failed" and "between reports" in report["error"]
    assert "gold.audience_daily" not in report["seconds"] and "gold.cache_release" in report["seconds"]
    assert report.get("cache_cleanup_error") == ("while releasing" if release_fails else None)
    assert released == [False]


def test_report_counts_match_tables(spark, fixture_dir, tmp_path):
    """What was observed while writing is what the tables hold."""
    root = str(tmp_path / "run")
    report = run_pipeline(spark, sources(spark, fixture_dir), root, Options(partition_by=("reporting_date",)),
                          source_path=str(fixture_dir))
    for table, facts in report["tables"].items():
        assert facts["rows"] == spark.read.parquet(f"{root}/{table}").count(), table
    assert report["checks"]["silver_totals"]["missing_profile_impressions"] == 1
    assert report["storage"]["source_bytes"] > 0 and report["storage"]["table_bytes"] > 0
    assert {"python", "java", "master", "driver_memory", "spark"} <= set(report["environment"])


def test_failed_run_report_persisted(spark, tmp_path):
    bad = [IMPRESSIONS[0][:5] + ("2",)] + IMPRESSIONS[1:]
    directory = write_sources(tmp_path / "raw", impressions=bad)
    root = str(tmp_path / "run")
    with pytest.raises(ValueError):
        run_pipeline(spark, sources(spark, directory), root, Options())
    report = load_report(spark, f"{root}/_report")
    assert report["status"] == "failed" and "break the row rules" in report["error"]


def test_malformed_number_raises_even_without_ansi(spark, tmp_path):
    from adlake.session import conf_scope
    bad = [("1", "12x", "10", "p1", "0", "1")] + IMPRESSIONS[1:]
    silver = tx.silver_views(sources(spark, write_sources(tmp_path / "raw", impressions=bad)))
    with conf_scope(spark, {"spark.sql.ansi.enabled": "false"}):
        with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
            silver["impressions"].collect()


def test_gold_phase_sizes_partitions_only_for_a_shuffled_fact(spark, fixture_dir, tmp_path):
    plain = run_pipeline(spark, sources(spark, fixture_dir), str(tmp_path / "a"), Options())
    assert "gold_shuffle_partitions" not in plain  # both dimensions are broadcast
    merged = run_pipeline(spark, sources(spark, fixture_dir), str(tmp_path / "b"), Options(ads_join="merge"))
    assert merged["gold_shuffle_partitions"] == spark.sparkContext.defaultParallelism


def test_each_row_names_its_file(spark, tmp_path):
    """A source of several files: every row's own file; a folder that Spark wrote: the folder."""
    import csv
    import os
    write_sources(tmp_path / "one")
    folder = tmp_path / "many" / "ad_feature.csv"
    os.makedirs(folder)
    header = ["adgroup_id", "cate_id", "campaign_id", "customer", "brand", "price"]
    for name, ids in (("ads 2016.csv", ("1", "2")), ("ads-2017.csv", ("3",))):
        with open(folder / name, "w", newline="") as handle:
            csv.writer(handle).writerows([header, *([i, "1", "100", "1", "NULL", "5"] for i in ids)])
    many = read_source_csv(spark, str(tmp_path / "many"), "ads")
    assert {(r.adgroup_id, r.source_file) for r in many.collect()} == {("1", "ads 2016.csv"), ("2", "ads 2016.csv"), ("3", "ads-2017.csv")}
    one = read_source_csv(spark, str(tmp_path / "one"), "ads")
    assert {r.source_file for r in one.collect()} == {"ad_feature.csv"}
    from adlake.sources.csv import write_source_csv
    write_source_csv(one, str(tmp_path / "written"), "ads")
    again = read_source_csv(spark, str(tmp_path / "written"), "ads")
    assert {r.source_file for r in again.collect()} == {"ad_feature.csv"} and again.columns == one.columns
