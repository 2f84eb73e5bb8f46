"""Run reports under crashes, and tables kept for later queries."""
from __future__ import annotations

import os

import pytest
from conftest import write_sources

from adlake.model import SOURCES
from adlake.plans import pipeline, reports
from adlake.plans.pipeline import run_pipeline
from adlake.plans.reports import ReportFolder, load_report, report_frame, save_report
from adlake.sources.csv import read_source_csv


def bronze(spark, folder):
    return {name: read_source_csv(spark, write_sources(str(folder)) if not os.path.exists(f"{folder}/raw_sample.csv") else str(folder), name)
            for name in SOURCES}


def test_newest_version_is_read_and_older_ones_go(spark, tmp_path):
    path = f"{tmp_path}/deep/_report"
    with pytest.raises(FileNotFoundError):
        load_report(spark, path)
    for n in range(4):
        save_report(spark, {"n": n, "text": "a\nb é"}, path)
        assert load_report(spark, path) == {"n": n, "text": "a\nb é"}
        assert ReportFolder(spark, path).versions() == [n + 1]
    assert report_frame(spark, path).count() == 1


@pytest.mark.parametrize("step", ["_write", "_publish"])
def test_a_crash_while_saving_leaves_the_version_before(spark, tmp_path, monkeypatch, step):
    path = f"{tmp_path}/_report"
    save_report(spark, {"n": 1}, path)
    plain = getattr(ReportFolder, step)

    def killed(self, *args):
        if step == "_write":
            plain(self, *args)  # written, not published
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(ReportFolder, step, killed)
        with pytest.raises(KeyboardInterrupt):
            save_report(spark, {"n": 2}, path)
    assert load_report(spark, path) == {"n": 1}
    save_report(spark, {"n": 3}, path)
    assert load_report(spark, path) == {"n": 3}


def test_a_crash_before_older_versions_go(spark, tmp_path, monkeypatch):
    folder = ReportFolder(spark, f"{tmp_path}/_report")
    folder.save({"n": 1})
    folder._publish(folder._write({"n": 2}))
    assert folder.versions() == [1, 2] and folder.load() == {"n": 2}
    with open(f"{tmp_path}/_report/report-000000003.json", "w") as torn:
        torn.write('{"n": ')
    assert folder.load() == {"n": 2}


def test_only_one_writer_claims(spark, tmp_path):
    folder = ReportFolder(spark, f"{tmp_path}/_report")
    folder.claim({"n": 1})
    for other in (ReportFolder(spark, f"{tmp_path}/_report"), folder):
        with pytest.raises(FileExistsError):
            other.claim({"n": 2})
    os.makedirs(f"{tmp_path}/b/_report")
    open(f"{tmp_path}/b/_report/_claimed", "w").close()  # claimed by a writer that has not yet reported
    with pytest.raises(FileExistsError):
        ReportFolder(spark, f"{tmp_path}/b/_report").claim({"n": 2})


def test_a_killed_run_shows_its_phases(spark, tmp_path, monkeypatch):
    plain = pipeline.write_table

    def killed(df, root, layer, name, *args, **how):
        if (layer, name) == ("gold", "audience_daily"):
            monkeypatch.setattr(pipeline._Run, "finish", lambda self, started: None)  # nothing runs after a kill
            monkeypatch.setattr(ReportFolder, "save", lambda self, report: None)
            raise KeyboardInterrupt
        return plain(df, root, layer, name, *args, **how)

    monkeypatch.setattr(pipeline, "write_table", killed)
    with pytest.raises(KeyboardInterrupt):
        run_pipeline(spark, bronze(spark, tmp_path / "src"), f"{tmp_path}/run")
    report = load_report(spark, f"{tmp_path}/run/_report")
    assert report["status"] == "running" and report["tables"]["gold/campaign_daily"]["rows"] > 0
    assert "validate.campaign_daily" in report["seconds"] and "gold.audience_daily" not in report["seconds"]
    assert report["checks"]["silver_totals"] and report["environment"]["spark"] == spark.version


def test_report_is_saved_after_every_phase(spark, tmp_path, monkeypatch):
    saved, plain = [], ReportFolder.save
    monkeypatch.setattr(ReportFolder, "save", lambda self, report: (saved.append(sorted(report["seconds"])), plain(self, report))[1])
    report = run_pipeline(spark, bronze(spark, tmp_path / "src"), f"{tmp_path}/run")
    phases = [k for k in report["seconds"] if "." in k or k == "storage"]
    for phase in phases:
        assert any(phase in s for s in saved)
    assert len(saved) >= len(phases) + 2
    assert load_report(spark, f"{tmp_path}/run/_report")["status"] == "succeeded"


def test_kept_tables_follow_releases_and_files(tmp_path):
    from pyspark.sql import SparkSession
    from adlake import session
    spark = session.build_session("local[*]", "adlake-tests", shuffle_partitions=8)
    assert isinstance(spark, SparkSession)
    from adlake.operators.storage import listing_state
    source, built = f"{tmp_path}/src", []

    def table():
        def build():
            path = session.scratch_path(spark, "kept")
            spark.read.parquet(source).write.parquet(path)
            built.append(path)
            return path
        return spark.read.parquet(session.kept_table(spark, (source, listing_state(spark, source)), build)).count()

    spark.range(5).write.parquet(source)
    assert (table(), table(), len(built)) == (5, 5, 1)
    spark.range(3).write.mode("append").parquet(source)
    assert (table(), table(), len(built)) == (8, 8, 2)
    held = session._SCRATCH.pop(spark.sparkContext.applicationId)  # other tests' tables stay
    session._SCRATCH[spark.sparkContext.applicationId] = list(built)
    try:
        assert session.release_scratch(spark) == 2
    finally:
        session._SCRATCH[spark.sparkContext.applicationId] = [p for p in held if p not in built]
    assert (table(), len(built)) == (8, 3)


def test_queries_after_a_release(spark):
    """A read workload finds its table again after the scratch was released."""
    from adlake import session
    from adlake.plans.catalog import QUERIES
    from conftest import SF_SMALL
    before = sorted(map(tuple, QUERIES["parquet_narrow"](spark, SF_SMALL).collect()))
    session.release_scratch(spark)
    assert sorted(map(tuple, QUERIES["parquet_narrow"](spark, SF_SMALL).collect())) == before
