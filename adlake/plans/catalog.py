"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables under ``sf_dir`` (or tables Spark derives
from them) in full.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlake.model import GOLD_KEYS, Options
from adlake.operators import transforms as tx
from adlake.sources.adapter import bronze_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


def silver(spark: SparkSession, sf_dir: str, opts: Options | None = None) -> dict[str, DataFrame]:
    return tx.silver_views(bronze_views(spark, sf_dir), opts)


def enriched(spark: SparkSession, sf_dir: str, opts: Options | None = None) -> DataFrame:
    s = silver(spark, sf_dir, opts)
    return tx.enrich(s, opts)


@register("campaign_daily")
def q_campaign_daily(spark, sf_dir):
    return tx.campaign_daily(enriched(spark, sf_dir))


@register("audience_daily")
def q_audience_daily(spark, sf_dir):
    return tx.audience_daily(enriched(spark, sf_dir))


# --- P1: layers ---------------------------------------------------------------------
NO_LTZ = "event_timestamp"  # instants are not compared across engines; seconds + date are


@register("silver_impressions")
def q_silver_impressions(spark, sf_dir):
    """P2/P5/P6; the instant is compared as its epoch second."""
    from pyspark.sql import functions as F
    rows = silver(spark, sf_dir)["impressions"]
    return rows.withColumn("event_epoch", F.unix_seconds(NO_LTZ)).drop(NO_LTZ)


@register("silver_ads")
def q_silver_ads(spark, sf_dir):
    return silver(spark, sf_dir)["ads"]


@register("silver_user_profiles")
def q_silver_user_profiles(spark, sf_dir):
    return silver(spark, sf_dir)["user_profiles"]


@register("enriched")
def q_enriched(spark, sf_dir):
    return enriched(spark, sf_dir).drop(NO_LTZ)


@register("overall_ctr")
def q_overall_ctr(spark, sf_dir):
    return tx.overall_ctr(tx.campaign_daily(enriched(spark, sf_dir)))


def _through_csv(spark, sf_dir) -> dict[str, DataFrame]:
    """The three sources written as raw CSV, read back strictly, typed."""
    from adlake.session import scratch_path
    from adlake.sources.csv import read_source_csv, write_source_csv
    source_dir = scratch_path(spark, "raw-csv")
    bronze = bronze_views(spark, sf_dir)
    for name, df in bronze.items():
        write_source_csv(df, source_dir, name)
    return tx.silver_views({name: read_source_csv(spark, source_dir, name) for name in bronze})


@register("bronze_csv_roundtrip")
def q_bronze_csv_roundtrip(spark, sf_dir):
    return tx.campaign_daily(tx.enrich(_through_csv(spark, sf_dir)))


@register("profiles_csv_roundtrip")
def q_profiles_csv_roundtrip(spark, sf_dir):
    """Padded, blank and literal NULL fields after the round trip."""
    return _through_csv(spark, sf_dir)["user_profiles"]


# --- P2: quality ----------------------------------------------------------------------
def dirty_silver(spark, sf_dir):
    from adlake.sources.adapter import dirty_views
    return tx.silver_views(dirty_views(spark, sf_dir))


@register("check_dimension_keys")
def q_check_dimension_keys(spark, sf_dir):
    from adlake.operators.quality import dimension_violations
    s = dirty_silver(spark, sf_dir)
    return (dimension_violations(s["ads"], "adgroup_id", ("campaign_id", "advertiser_id"), "ads")
            .unionByName(dimension_violations(s["user_profiles"], "user_id", (), "user_profiles")))


@register("check_invalid_impressions")
def q_check_invalid_impressions(spark, sf_dir):
    from adlake.operators.quality import impression_violations
    return impression_violations(dirty_silver(spark, sf_dir)["impressions"])


@register("unmatched_ads")
def q_unmatched_ads(spark, sf_dir):
    from adlake.operators.quality import unmatched
    s = dirty_silver(spark, sf_dir)
    return unmatched(s["impressions"], s["ads"], "adgroup_id").drop(NO_LTZ)


@register("missing_profiles")
def q_missing_profiles(spark, sf_dir):
    from pyspark.sql import functions as F
    from adlake.operators.quality import unmatched
    s = silver(spark, sf_dir)
    return unmatched(s["impressions"], s["user_profiles"], "user_id").agg(
        F.count(F.lit(1)).alias("missing_profile_impressions"))


@register("fact_totals")
def q_fact_totals(spark, sf_dir):
    from adlake.operators.quality import fact_totals
    s = silver(spark, sf_dir)
    return fact_totals(s["impressions"], s["user_profiles"])


@register("gold_reconciliation")
def q_gold_reconciliation(spark, sf_dir):
    """Both reports reconcile; a copy of campaign_daily with clicks+1 on campaigns
    whose id ends in 3 must not."""
    from pyspark.sql import functions as F
    from adlake.operators.quality import fact_totals, reconcile
    s = silver(spark, sf_dir)
    e = tx.enrich(s)
    totals = fact_totals(s["impressions"], s["user_profiles"])
    campaign = tx.campaign_daily(e)
    tampered = campaign.withColumn(
        "clicks", F.col("clicks") + F.when(F.col("campaign_id") % 10 == 3, 1).otherwise(0))
    return (reconcile(campaign, totals, "campaign_daily")
            .unionByName(reconcile(tx.audience_daily(e), totals, "audience_daily"))
            .unionByName(reconcile(tampered, totals, "campaign_daily_tampered")))


@register("row_count_match")
def q_row_count_match(spark, sf_dir):
    from adlake.operators.quality import row_counts
    bronze = bronze_views(spark, sf_dir)
    s = tx.silver_views(bronze)
    return row_counts({name: (bronze[name], s[name]) for name in bronze})


@register("table_diff")
def q_table_diff(spark, sf_dir):
    """Exact multiset difference between clean and fault-injected Silver impressions."""
    from adlake.operators.equality import table_diff
    return table_diff(silver(spark, sf_dir)["impressions"].drop(NO_LTZ),
                      dirty_silver(spark, sf_dir)["impressions"].drop(NO_LTZ))


# --- P3: reads, formats and layouts ----------------------------------------------------
def _materialized(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """Write the table a read workload scans, in the shared scratch: once per application and
    state of the files it comes from."""
    from adlake.operators.storage import listing_state
    from adlake.session import kept_table
    return kept_table(spark, (sf_dir, listing_state(spark, sf_dir), layout), lambda: _write_layout(spark, sf_dir, layout))


def _write_layout(spark: SparkSession, sf_dir: str, layout: str) -> str:
    from adlake.operators.reads import typed_impressions
    from adlake.session import scratch_path
    from adlake.sources.csv import write_typed_csv
    from adlake.sources.tables import csv_to_parquet, write_table
    if layout == "typed_csv":
        return write_typed_csv(typed_impressions(bronze_views(spark, sf_dir)["impressions"]), scratch_path(spark, "typed-csv"))
    if layout == "typed_parquet":
        return csv_to_parquet(spark, _materialized(spark, sf_dir, "typed_csv"), scratch_path(spark, "typed-parquet"))["path"]
    if layout not in SILVER_LAYOUTS:
        raise ValueError(layout)
    root = scratch_path(spark, layout)
    opts = SILVER_LAYOUTS[layout]
    write_table(silver(spark, sf_dir)["impressions"], root, "silver", "impressions", opts,
                partition_by=opts.partition_by, cluster_by=opts.cluster_by)
    return f"{root}/silver/impressions"


#: Silver impressions as the read workloads find them.
SILVER_LAYOUTS = {"silver": Options(codec="snappy"), "silver_zstd": Options(codec="zstd"),
                  "silver_by_date": Options(codec="zstd", partition_by=("reporting_date",)),
                  "silver_clustered": Options(codec="zstd", cluster_by=("reporting_date", "timestamp_seconds"))}


def _format_query(source: str, workload: str):
    def run(spark, sf_dir):
        from adlake.operators.reads import format_query
        from adlake.sources.csv import read_impressions_csv
        path = _materialized(spark, sf_dir, f"typed_{source}")
        frame = read_impressions_csv(spark, path) if source == "csv" else spark.read.parquet(path)
        return format_query(frame, workload)
    return run


def _silver_query(layout: str, workload: str):
    def run(spark, sf_dir):
        from adlake.operators.reads import silver_query
        return silver_query(spark.read.parquet(_materialized(spark, sf_dir, layout)), workload)
    return run


from adlake.operators.reads import FORMAT_WORKLOADS, SILVER_WORKLOADS  # noqa: E402

for _w in FORMAT_WORKLOADS:
    register(f"placement_{_w}")(_format_query("csv", _w))
    register(f"parquet_{_w}")(_format_query("parquet", _w))
for _w in SILVER_WORKLOADS:
    register(f"silver_{_w}")(_silver_query("silver", _w))
    register(f"partitioned_{_w}")(_silver_query("silver_by_date", _w))
    register(f"clustered_{_w}")(_silver_query("silver_clustered", _w))


@register("placement_ordered")
def q_placement_ordered(spark, sf_dir):
    """O2: the full-period report in its total order, with each row's place."""
    from adlake.operators.reads import in_order, silver_query
    return in_order(silver_query(spark.read.parquet(_materialized(spark, sf_dir, "silver")), "full_period"), "impressions")


@register("table_detail")
def q_table_detail(spark, sf_dir):
    """What of a table's detail doesn't depend on how Spark dealt its rows."""
    from pyspark.sql import functions as F
    from adlake.sources.tables import table_detail
    detail = table_detail(spark, _materialized(spark, sf_dir, "silver_by_date"))
    return detail.select(F.array_join("partition_columns", ",").alias("partition_columns"), "partitions",
                         (F.col("num_files") >= F.col("partitions")).alias("every_partition_has_files"))


@register("codec_audit")
def q_codec_audit(spark, sf_dir):
    """M3: rows, codecs and whether they are the expected one, from the files' footers."""
    from pyspark.sql import functions as F
    from adlake.operators.storage import codec_audit
    audit = codec_audit(spark, _materialized(spark, sf_dir, "silver_zstd"), "zstd")
    return audit.select("rows", F.array_join("codecs", ",").alias("codecs"), "matches_expected")


@register("source_fingerprint")
def q_source_fingerprint(spark, sf_dir):
    from adlake.operators.storage import fingerprint
    return fingerprint(spark, sf_dir, "*.parquet")


@register("row_fingerprint")
def q_row_fingerprint(spark, sf_dir):
    from adlake.operators.storage import row_fingerprint
    out = row_fingerprint(silver(spark, sf_dir)["impressions"].drop(NO_LTZ))
    return out.withColumn("hash_sum", out["hash_sum"].cast("string"))


#: The runs that U3, Q9 and M1 compare: the control, and one that changes all that may change.
RUN_OPTIONS = {"control": Options(), "variant": Options(codec="zstd", partition_by=("reporting_date",), ads_join="merge",
                                                        profile_join="merge", shared_rollup=True)}


def _runs(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Roots of both runs, rebuilt once per application in the caller's session."""
    from adlake.operators.storage import listing_state
    from adlake.plans.pipeline import run_pipeline
    from adlake.session import kept_table, scratch_path

    def run(name: str, opts: Options) -> str:
        root = scratch_path(spark, f"run-{name}")
        run_pipeline(spark, bronze_views(spark, sf_dir, dealt=True), root, opts, run_id=name)
        return root

    state = listing_state(spark, sf_dir)
    return {name: kept_table(spark, (sf_dir, state, f"run-{name}"), lambda: run(name, opts)) for name, opts in RUN_OPTIONS.items()}


@register("storage_totals")
def q_storage_totals(spark, sf_dir):
    """M1: every table of a run with its rows, and that its files hold bytes, all of them Parquet."""
    from functools import reduce
    from pyspark.sql import functions as F
    from adlake.operators.storage import storage_totals
    from adlake.plans.compare import COMPARED_TABLES
    root = _runs(spark, sf_dir)["control"]
    rows = reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{root}/{layer}/{name}").agg(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                                                         F.count(F.lit(1)).alias("rows")) for layer, name in COMPARED_TABLES])
    return storage_totals(spark, root).join(rows, ["layer", "table_name"]).select(
        "layer", "table_name", "rows", ((F.col("parquet_files") > 0) & (F.col("parquet_bytes") > 0)
                                        & (F.col("data_bytes") == F.col("parquet_bytes"))
                                        & (F.col("total_bytes") >= F.col("data_bytes"))).alias("only_parquet_files"))


@register("report_against_files")
def q_report_against_files(spark, sf_dir):
    """Rows of every table of both runs by the files' footers, and whether footers, bytes and file counts are
    those of the run's report."""
    from functools import reduce
    from pyspark.sql import functions as F
    from adlake.operators.storage import report_against_files
    from adlake.plans.reports import load_report
    frames = []
    for name, root in _runs(spark, sf_dir).items():
        found = report_against_files(spark, root, load_report(spark, f"{root}/_report")["tables"])
        frames.append(found.select(F.lit(name).alias("run"), "layer", "table_name", F.col("found_rows").alias("rows"), "agrees"))
    return reduce(DataFrame.unionByName, frames)


@register("runs_output_equality")
def q_runs_output_equality(spark, sf_dir):
    """Every table of the variant run against the control run's."""
    from adlake.plans.compare import output_equality
    return output_equality(spark, _runs(spark, sf_dir), "control")


@register("runs_comparability")
def q_runs_comparability(spark, sf_dir):
    """Q9: what decides whether the two runs are comparable: status, table set, rows of each source, and the
    declared setting, which alone may differ."""
    from pyspark.sql import functions as F
    from adlake.operators.stats import report_rows, validate_comparable
    from adlake.plans.reports import report_frame
    roots, declared = _runs(spark, sf_dir), ("spark.sql.parquet.compression.codec",)
    sides = {name: report_rows(report_frame(spark, f"{root}/_report")).drop("run_id") for name, root in roots.items()}
    validate_comparable(sides["control"], sides["variant"], declared)
    shown = F.col("key").isin("status", "tables", *[f"settings.{d}" for d in declared]) | F.col("key").rlike(r"^sources\..*\.rows$")
    return (sides["control"].withColumnRenamed("value", "control_value").join(
        sides["variant"].withColumnRenamed("value", "variant_value"), "key", "full").filter(shown)
        .withColumn("same", F.col("control_value").eqNullSafe(F.col("variant_value"))))


# --- P4: strategies (metamorphic: same result and SQL as the control) --------------------
def _report_under(spark: SparkSession, sf_dir: str, preset: str, report: str) -> DataFrame:
    """Build ``report`` with a preset's options; settings that act at planning time are
    scoped to the write of the result into the shared scratch, which is then read back."""
    from adlake.plans.variants import PRESETS
    from adlake.session import conf_scope, scratch_path
    opts = PRESETS[preset][0]
    s = silver(spark, sf_dir, opts)
    keys = GOLD_KEYS[report]
    if opts.cache:
        from pyspark import StorageLevel
        from adlake.plans.pipeline import REPORT_COLUMNS
        shared = tx.enrich(s, opts).select(*REPORT_COLUMNS)
        shared.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        try:
            path = scratch_path(spark, f"{preset}-{report}")
            with conf_scope(spark, opts.session_conf()):
                for other in GOLD_KEYS:  # both reports reuse the cached enrichment
                    out = tx.daily_report(shared, GOLD_KEYS[other])
                    out.write.parquet(path if other == report else scratch_path(spark, other))
        finally:
            shared.unpersist(blocking=True)
        return spark.read.parquet(path)
    e = tx.enrich(s, opts)
    out = (tx.report_from_rollup(tx.gold_rollup(e), keys) if opts.shared_rollup
           else tx.daily_report(e, keys))
    if opts.session_conf() == Options().session_conf():
        return out
    path = scratch_path(spark, f"{preset}-{report}")
    with conf_scope(spark, opts.session_conf()):
        out.write.parquet(path)
    return spark.read.parquet(path)

_VARIANT_QUERIES = {
    "campaign_merge_ads": ("ads_merge", "campaign_daily"),
    "audience_merge_ads": ("ads_merge", "audience_daily"),
    "campaign_merge_profiles": ("profiles_merge", "campaign_daily"),
    "audience_merge_profiles": ("profiles_merge", "audience_daily"),
    "campaign_broadcast": ("ads_broadcast", "campaign_daily"),
    "campaign_shuffle_hash": ("shuffle_hash", "campaign_daily"),
    "campaign_shuffle_32": ("shuffle_32", "campaign_daily"),
    "reports_cached": ("cached", "audience_daily"),
    "campaign_no_coalesce": ("no_coalesce", "campaign_daily"),
    "campaign_zstd": ("zstd", "campaign_daily"),
    "reporting_date_udf": ("python_udf", "campaign_daily"),
    "reporting_date_arrow": ("arrow_udf", "audience_daily"),
    "campaign_shared_rollup": ("shared_rollup", "campaign_daily"),
    "audience_shared_rollup": ("shared_rollup", "audience_daily"),
}


def _variant(preset: str, report: str):
    return lambda spark, sf_dir: _report_under(spark, sf_dir, preset, report)


for _name, (_preset, _report) in _VARIANT_QUERIES.items():
    register(_name)(_variant(_preset, _report))


#: Settings under which the presets' evidence is taken: a known number of partitions, and dimensions that fit a broadcast.
EVIDENCE_CONF = {"spark.sql.shuffle.partitions": "48", "spark.sql.autoBroadcastJoinThreshold": str(64 << 20)}
EVIDENCE_PRESETS = ("control", "ads_merge", "profiles_merge", "shuffle_hash", "shuffle_32", "cached", "no_coalesce",
                    "python_udf", "arrow_udf", "shared_rollup")


def _run_for_evidence(spark: SparkSession, sf_dir: str, preset: str, look) -> list:
    """Run both reports in full under a preset and ``look(report name, totals frame, its row)`` at each."""
    from pyspark import StorageLevel
    from adlake.operators.live import totals
    from adlake.plans.pipeline import REPORT_COLUMNS
    from adlake.plans.variants import PRESETS
    from adlake.session import conf_scope
    opts, found = PRESETS[preset][0], []
    e = tx.enrich(silver(spark, sf_dir, opts), opts)
    if opts.cache:
        e = e.select(*REPORT_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        with conf_scope(spark, {**EVIDENCE_CONF, **opts.session_conf()}):
            for name, keys in GOLD_KEYS.items():
                out = tx.report_from_rollup(tx.gold_rollup(e), keys) if opts.shared_rollup else tx.daily_report(e, keys)
                frame = totals(out)
                found.append(look(name, frame))
    finally:
        if opts.cache:
            e.unpersist(blocking=True)
    return found


def _evidence_together() -> list[tuple[str, ...]]:
    """The presets whose reports may share one execution: those without a cache and with the same settings."""
    from adlake.plans.variants import PRESETS
    groups: dict[tuple, list[str]] = {}
    for preset in EVIDENCE_PRESETS:
        opts = PRESETS[preset][0]
        groups.setdefault((opts.cache and preset, *sorted(opts.session_conf().items())), []).append(preset)
    return [tuple(g) for g in groups.values()]


def _evidence_of_presets(spark: SparkSession, sf_dir: str, presets: tuple[str, ...]) -> list:
    """Both reports in full under each of the presets, which have the same settings. A report's presets are branches of
    one execution: a dimension that several of them broadcast reaches the driver once, not once for each of them. The
    reports themselves run one after the other, or a rollup that both come from would run in one branch only."""
    from functools import reduce
    from pyspark.sql import functions as F
    from adlake.model import DIMENSIONS
    from adlake.operators.live import branches, evidence_of, final_plan, totals
    from adlake.plans.variants import PRESETS
    from adlake.session import conf_scope
    enriched = {p: tx.enrich(silver(spark, sf_dir, PRESETS[p][0]), PRESETS[p][0]) for p in presets}
    found = []
    with conf_scope(spark, {**EVIDENCE_CONF, **PRESETS[presets[0]][0].session_conf()}):
        for report, keys in GOLD_KEYS.items():
            made = [tx.report_from_rollup(tx.gold_rollup(e), keys) if PRESETS[p][0].shared_rollup else tx.daily_report(e, keys)
                    for p, e in enriched.items()]
            frames = [totals(out).select(F.lit(p).alias("preset"), "rows", "impressions") for p, out in zip(presets, made)]
            frame = reduce(DataFrame.unionByName, frames)
            rows = {r["preset"]: r for r in frame.collect()}  # a row per preset; an action on this very frame
            plan = final_plan(frame)
            parts = branches(plan) if len(presets) > 1 else [plan]
            seen = [evidence_of(part) for part in parts]
            if len(seen) != len(presets) or any(d.key not in s.joins for s in seen for d in DIMENSIONS):
                raise ValueError(f"not every preset's joins are in the plan: {plan}")
            found += [(p, report, s, rows[p]) for p, s in zip(presets, seen)]
    return found


@register("plan_evidence")
def q_plan_evidence(spark, sf_dir):
    """For each preset and report, what its final adaptive plan shows, beside the report's totals."""
    from adlake.operators.live import plan_evidence
    from adlake.plans.variants import PRESETS

    def cached(preset):
        def one(report, frame):
            row = frame.collect()[0]  # one row; an action on this very frame
            return preset, report, plan_evidence(frame), row
        return _run_for_evidence(spark, sf_dir, preset, one)

    found = [r for presets in _evidence_together() for r in (
        cached(presets[0]) if PRESETS[presets[0]][0].cache else _evidence_of_presets(spark, sf_dir, presets))]
    found.sort(key=lambda r: (EVIDENCE_PRESETS.index(r[0]), list(GOLD_KEYS).index(r[1])))
    rows = [(preset, report, seen.joins.get("adgroup_id"), seen.joins.get("user_id"), ",".join(map(str, seen.initial_partitions)),
             seen.coalesced, seen.cache_scans, seen.python_node, row["rows"], row["impressions"]) for preset, report, seen, row in found]
    return spark.createDataFrame(rows, "preset string, report string, ads_join string, profile_join string, initial_partitions string, "
                                       "coalesced boolean, cache_scans int, python_node string, report_rows long, impressions long")


@register("task_evidence")
def q_task_evidence(spark, sf_dir):
    """For both reports without coalescing, the tasks of their job groups by the status tracker: all completed,
    and one stage with a task for each shuffle partition."""
    import uuid
    from adlake.operators.live import check_group_tasks, group_tasks
    from adlake.plans.pipeline import job_group
    partitions, run = int(EVIDENCE_CONF["spark.sql.shuffle.partitions"]), uuid.uuid4().hex

    def look(report, frame):
        with job_group(spark, f"gold.{report}-{run}"):
            row = frame.collect()[0]  # one row; an action on this very frame
        found = check_group_tasks(group_tasks(spark, f"gold.{report}-{run}"))
        return (f"gold.{report}", found.tasks_by_stage.count(partitions), found.completed_tasks == sum(found.tasks_by_stage),
                found.failed_tasks, row["rows"], row["impressions"])

    return spark.createDataFrame(_run_for_evidence(spark, sf_dir, "no_coalesce", look),
                                 "job_group string, partition_stages int, all_completed boolean, failed_tasks int, report_rows long, impressions long")


@register("gold_pipeline_campaign")
def q_gold_pipeline_campaign(spark, sf_dir):
    """The whole rebuild (write Bronze/Silver/Gold with checks) under date partitioning;
    returns the written campaign report."""
    from adlake.plans.pipeline import gold_table, run_pipeline
    from adlake.plans.variants import PRESETS
    from adlake.session import scratch_path
    opts = PRESETS["date_partitioned"][0]
    root = scratch_path(spark, "pipeline")
    run_pipeline(spark, bronze_views(spark, sf_dir), root, opts)
    return gold_table(spark, root, "campaign_daily", opts)


# --- P5: statistics over data-derived measurements (A13-A15, J8) ---------------------------
SPLIT_DAY = "2024-01-16"  # left/right periods of the right-vs-left comparison


def _daily_clicks(imp: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F
    return imp.groupBy("placement_id", "reporting_date").agg(F.sum("clicked").cast("long").alias("clicks"))


@register("run_distribution")
def q_run_distribution(spark, sf_dir):
    """Per placement, the distribution of its daily click totals."""
    from pyspark.sql import functions as F
    from adlake.operators.stats import distribution
    # one sample per day: the group size is bounded by the calendar, not by the data
    out = distribution(_daily_clicks(silver(spark, sf_dir)["impressions"]), ["placement_id"], "clicks",
                       with_samples=True)
    return out.withColumn("stdev", F.round("stdev", 9))


@register("size_distribution")
def q_size_distribution(spark, sf_dir):
    """Per day, the distribution of campaign impressions (nearest-rank p95)."""
    from adlake.operators.stats import size_distribution
    return size_distribution(tx.campaign_daily(enriched(spark, sf_dir)), ["reporting_date"], "impressions")


@register("right_vs_left")
def q_right_vs_left(spark, sf_dir):
    """Per placement, median daily clicks before (left) and from (right) SPLIT_DAY."""
    from pyspark.sql import functions as F
    from adlake.operators.stats import right_vs_left
    daily = _daily_clicks(silver(spark, sf_dir)["impressions"]).withColumn(
        "side", F.when(F.col("reporting_date") < F.lit(SPLIT_DAY).cast("date"), "left").otherwise("right"))
    return right_vs_left(daily, ["placement_id"], "side", "clicks")


@register("settings_diff")
def q_settings_diff(spark, sf_dir):
    """(key, value) diff of per-placement click totals, clean vs fault-injected facts."""
    from pyspark.sql import functions as F
    from adlake.operators.stats import settings_diff

    def kv(imp):
        return imp.groupBy(F.col("placement_id").alias("key")).agg(
            F.sum("clicked").cast("string").alias("value"))
    return settings_diff(kv(silver(spark, sf_dir)["impressions"]), kv(dirty_silver(spark, sf_dir)["impressions"]),
                         declared=("click",))


@register("fact_checks")
def q_fact_checks(spark, sf_dir):
    """Q3-Q5 folded into one pass over the fault-injected fact."""
    from adlake.operators.quality import fact_checks
    s = dirty_silver(spark, sf_dir)
    return fact_checks(s["impressions"], s["ads"], s["user_profiles"])


@register("storage_by_layout")
def q_storage_by_layout(spark, sf_dir):
    """L1-L3 storage: the same impressions as typed CSV, uncompressed Parquet, and Silver Parquet in
    Snappy, ZSTD and ZSTD by date: rows read back, partitions, and whether an unpartitioned layout takes fewer
    bytes than CSV (by date it depends on how many small files the days make)."""
    from functools import reduce
    from pyspark.sql import functions as F
    from adlake.operators.storage import list_files
    from adlake.sources.csv import read_impressions_csv
    sizes, frames = {}, []
    for layout, ending in (("typed_csv", "*.csv"), ("typed_parquet", "*.parquet"), ("silver", "*.parquet"),
                           ("silver_zstd", "*.parquet"), ("silver_by_date", "*.parquet")):
        path = _materialized(spark, sf_dir, layout)
        rows = read_impressions_csv(spark, path) if layout == "typed_csv" else spark.read.parquet(path)
        sizes[layout] = list_files(spark, path, ending).agg(F.sum("length")).first()[0]
        days = F.count_distinct("reporting_date") if layout == "silver_by_date" else F.lit(0).cast("long")
        frames.append(rows.agg(F.lit(layout).alias("layout"), F.count(F.lit(1)).alias("data_rows"), days.alias("partitions"))
                      .withColumn("smaller_than_csv", F.lit(sizes[layout] < sizes["typed_csv"]) if layout != "silver_by_date"
                                  else F.lit(None).cast("boolean")))
    return reduce(DataFrame.unionByName, frames)
