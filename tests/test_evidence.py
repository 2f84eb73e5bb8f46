"""Evidence jobs over event logs recorded with Spark's default log settings (rolled, zstd), and
altered logs that the checks must refuse."""
from __future__ import annotations

import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from adlake.operators import evidence as evd
from adlake.operators.evidence import EvidenceError
from adlake.sources.eventlog import applications, read_event_log
from conftest import SF_SMALL

HERE = os.path.dirname(os.path.abspath(__file__))
BROADCAST = {"adgroup_id": "BroadcastHashJoin", "user_id": "BroadcastHashJoin"}
UDF_GROUPS = ("silver.impressions", *evd.GOLD_GROUPS)


@pytest.fixture(scope="module")
def recorded(tmp_path_factory):
    out = str(tmp_path_factory.mktemp("recording"))
    done = subprocess.run([sys.executable, f"{HERE}/recorder.py", SF_SMALL, out], capture_output=True, text=True, timeout=1200)
    assert done.returncode == 0, done.stderr
    return out


@pytest.fixture(scope="module")
def logs(spark, recorded, tmp_path_factory):
    """The events of each run, parsed once and kept as tables."""
    path = str(tmp_path_factory.mktemp("parsed") / "events")
    read_event_log(spark, f"{recorded}/events").write.parquet(path)
    log = spark.read.parquet(path)
    names = applications(log).select("application", F.regexp_replace("app_name", "^record-", "").alias("run"))
    ids = {r.run: r.application for r in names.collect()}
    return {run: log.filter(F.col("application") == i) for run, i in ids.items()}


def silver_rows(spark, recorded, run):
    return spark.read.parquet(f"{recorded}/runs/{run}/silver/impressions").count()


def test_logs_are_spark_defaults(recorded, logs):
    files = glob.glob(f"{recorded}/events/eventlog_v2_*/events_1_*")
    assert len(files) == 5 and all(f.endswith(".zstd") for f in files)
    assert set(logs) == {"control", "ads_merge", "cached", "python_udf", "no_coalesce"}
    assert all(log.count() > 100 for log in logs.values())


def test_plain_single_file_logs_read_the_same(spark, logs, tmp_path):
    """The same events as one uncompressed file, in order."""
    rows = [r.json for r in logs["control"].orderBy("seq").collect()]
    os.makedirs(tmp_path / "plain")
    (tmp_path / "plain" / "local-1").write_text("\n".join(rows) + "\n")
    plain = read_event_log(spark, str(tmp_path / "plain"))
    assert {r.application for r in plain.select("application").distinct().collect()} == {"local-1"}
    assert [r.json for r in plain.orderBy("seq").collect()] == rows
    evd.check_join_strategies(plain, BROADCAST)


def test_rolled_files_belong_together(spark, logs, tmp_path):
    """Stages in one rolled file meet their tasks in the next."""
    rows = [r.json for r in logs["control"].orderBy("seq").collect()]
    folder = tmp_path / "eventlog_v2_app-7"
    os.makedirs(folder)
    step = len(rows) // 11 + 1
    for n in range(11):  # eleven files: their order is that of numbers, not of names
        (folder / f"events_{n + 1}_app-7").write_text("".join(r + "\n" for r in rows[n * step:(n + 1) * step]))
    rolled = read_event_log(spark, str(tmp_path))
    assert [r.json for r in rolled.orderBy("seq").collect()] == rows
    evd.check_join_strategies(rolled, BROADCAST)
    evd.check_reader_stages(rolled)


def test_task_metrics_by_group(logs):
    rows = {r.job_group: r for r in evd.task_metrics(logs["control"]).collect()}
    assert {"bronze.impressions", "silver.impressions", "gold.campaign_daily", "validate.silver"} <= set(rows)
    assert all(r.failed_task_attempts == 0 for r in rows.values())
    assert rows["bronze.impressions"].input_bytes > 0 and rows["gold.campaign_daily"].task_attempts > 0
    totals = evd.processing_totals(evd.task_metrics(logs["control"])).first()
    assert totals.task_attempts == sum(r.task_attempts for g, r in rows.items() if g.startswith(evd.PROCESSING_PREFIXES))


def test_join_strategies(logs):
    evd.check_join_strategies(logs["control"], BROADCAST)
    evd.check_join_strategies(logs["ads_merge"], {**BROADCAST, "adgroup_id": "SortMergeJoin"})
    with pytest.raises(EvidenceError, match="operators is"):
        evd.check_join_strategies(logs["ads_merge"], BROADCAST)


def test_partitions_stages_and_coalescing(logs):
    evd.check_shuffle_partitions(logs["control"], 16)
    with pytest.raises(EvidenceError, match="expected only 200"):
        evd.check_shuffle_partitions(logs["control"], 200)
    evd.check_reader_stages(logs["control"])
    evd.check_coalescing(logs["control"], enabled=True)
    off = evd.check_coalescing(logs["no_coalesce"], enabled=False)
    assert all(r["reader_tasks"] == 16 for r in off.values())
    with pytest.raises(EvidenceError, match="no coalesced reader"):
        evd.check_coalescing(logs["control"], enabled=False)


def test_cache(spark, recorded, logs):
    n = silver_rows(spark, recorded, "cached")
    evd.check_cache_reuse(logs["cached"], n, cached=True)
    evd.check_cache_reuse(logs["control"], n, cached=False)
    for log, cached in ((logs["control"], True), (logs["cached"], False)):
        with pytest.raises(EvidenceError):
            evd.check_cache_reuse(log, n, cached)
    shared = [r for r in evd.cache_lifecycle(logs["cached"]).collect() if r.groups == sorted(evd.GOLD_GROUPS)]
    assert len(shared) == 1  # one cached relation, used by both reports
    r = shared[0]
    assert r.storage_level == "memory,disk,deserialized" and r.replication == 1 and r.partitions > 0
    assert r.released and r.released_after_last_use
    assert evd.cache_lifecycle(logs["control"]).isEmpty()


def test_python_udf(spark, recorded, logs):
    n = silver_rows(spark, recorded, "python_udf")
    evd.check_python_eval(logs["python_udf"], n)
    with pytest.raises(EvidenceError, match="rows is"):
        evd.check_python_eval(logs["python_udf"], n + 1)
    with pytest.raises(EvidenceError, match="no evidence"):
        evd.check_python_eval(logs["control"], n)


def test_scans_and_files(spark, recorded, logs):
    from adlake.operators.stats import size_distribution
    from adlake.operators.storage import file_sizes
    from adlake.plans.pipeline import load_report
    evd.check_scan_metrics(logs["control"], ("workload.narrow", "workload.one_day"))
    with pytest.raises(EvidenceError, match="no evidence"):
        evd.check_scan_metrics(logs["control"], ("no.such.group",))
    tables = load_report(spark, f"{recorded}/runs/control/_report")["tables"]
    found = file_sizes(spark, f"{recorded}/runs/control").withColumn(
        "table_name", F.regexp_extract("path", r"/runs/control/([^/]+/[^/]+)/", 1))
    sizes = size_distribution(found, ["table_name"], "bytes")
    counts = {name: t["parquet_files"] for name, t in tables.items()}
    evd.check_written_files(sizes, counts)
    with pytest.raises(EvidenceError):
        evd.check_written_files(sizes, {**counts, "gold/campaign_daily": 99})


def test_plan_trees_match_a_recursive_walk(logs):
    import json
    from adlake.functions.plan_nodes import plan_nodes
    plans = evd.latest_plans(logs["control"])

    def walk(node, path):
        yield path, node["nodeName"]
        for k, child in enumerate(node["children"]):
            yield from walk(child, f"{path}.{k}")
    want = {(r.execution_id, *x) for r in plans.collect() for x in walk(json.loads(r.plan), "0")}
    nodes = plan_nodes(plans).collect()
    assert {(r.execution_id, r.node_path, r.node_name) for r in nodes} == want and len(nodes) == len(want)
    assert all(r.depth == r.node_path.count(".") for r in nodes)


def test_deep_plan_tree(spark):
    from adlake.functions.plan_nodes import plan_nodes
    text = '{"nodeName":"n","simpleString":"s","metrics":[],"children":[' * 400 + '{"nodeName":"leaf"}' + "]}" * 400
    plans = spark.createDataFrame([("a", 1, text), ("a", 2, None)], "application string, execution_id long, plan string")
    assert plan_nodes(plans).count() == 401


# --- altered logs ---------------------------------------------------------------------------------

def altered(log, change):
    return log.withColumn("json", change(F.col("json")))


def test_sql_error_is_refused(logs):
    bad = altered(logs["control"], lambda j: F.when(j.contains("SparkListenerSQLExecutionEnd"), F.regexp_replace(
        j, '"errorMessage":""', '"errorMessage":"boom"')).otherwise(j))
    for check in (lambda: evd.check_join_strategies(bad, BROADCAST), lambda: evd.check_cache_reuse(bad, 1, cached=False),
                  lambda: evd.check_reader_stages(bad)):
        with pytest.raises(EvidenceError, match="sql_succeeded is False"):
            check()


def test_latest_plan_wins(logs):
    bad = altered(logs["control"], lambda j: F.when(j.contains("SparkListenerSQLAdaptiveExecutionUpdate"), F.regexp_replace(
        j, "BroadcastHashJoin", "SortMergeJoin")).otherwise(j))
    with pytest.raises(EvidenceError, match="operators is"):
        evd.check_join_strategies(bad, BROADCAST)


def test_dropped_or_repeated_task_ends_are_unhealthy(logs):
    log = logs["control"]
    dropped = log.filter(F.col("event") != "SparkListenerTaskEnd")
    with pytest.raises(EvidenceError, match="stages_healthy is False"):
        evd.check_reader_stages(dropped)
    # every task of a stage reported as its first: as many ends as tasks, but not of each task
    same = altered(log, lambda j: F.when(j.contains('"SparkListenerTaskEnd"'), F.regexp_replace(j, '"Index":\\d+', '"Index":0')).otherwise(j))
    assert not evd.stage_rollup(same).filter("scheduled_tasks > 1 AND healthy").count()


def test_missing_group_and_empty_log(spark, logs):
    with pytest.raises(EvidenceError, match="gold.audience_daily: no evidence"):
        evd.check_join_strategies(logs["control"].filter(~F.col("json").contains("gold.audience_daily")), BROADCAST)
    with pytest.raises(EvidenceError, match="no events"):
        evd.require_events(logs["control"].limit(0))


def test_run_reports_and_outputs(spark, recorded):
    from adlake.operators.stats import report_rows, validate_comparable
    from adlake.plans.compare import output_equality, report_measurements, summarize
    reports = spark.read.option("recursiveFileLookup", True).text(f"{recorded}/runs/*/_report")
    rows = report_rows(reports)
    side = {run: rows.filter(F.col("run_id") == run).drop("run_id") for run in ("control", "ads_merge", "no_coalesce")}
    assert validate_comparable(side["control"], side["ads_merge"]) == {}  # same sources, tables and settings
    with pytest.raises(ValueError, match="not comparable"):
        validate_comparable(side["control"], side["no_coalesce"])
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    assert validate_comparable(side["control"], side["no_coalesce"], (setting,)) == {f"settings.{setting}": ("true", "false")}
    runs = {r: f"{recorded}/runs/{r}" for r in ("control", "ads_merge", "cached", "python_udf", "no_coalesce")}
    found = output_equality(spark, runs, "control").collect()
    assert len(found) == 4 * 8 and all(r.equal and r.control_rows == r.run_rows > 0 for r in found)
    m = report_measurements(reports)
    sides = m.select("run_id").distinct().withColumn("side", F.when(F.col("run_id") == "control", "left").otherwise("right"))
    summary = {r.metric: r for r in summarize(m, sides).collect()}
    assert summary["storage.parquet_files"].left_median > 0
    assert summary["seconds.total"].right_max >= summary["seconds.total"].right_min


def test_output_differences_are_counted(spark, tmp_path):
    from adlake.plans.compare import output_equality
    for run, values in (("control", [1, 1, 2, None]), ("other", [1, 2, 2, 3])):
        spark.createDataFrame([(v,) for v in values], "v long").write.parquet(f"{tmp_path}/{run}/gold/t")
    (row,) = output_equality(spark, {r: f"{tmp_path}/{r}" for r in ("control", "other")}, "control", (("gold", "t"),)).collect()
    assert (row.control_only_rows, row.run_only_rows, row.equal) == (2, 2, False)
