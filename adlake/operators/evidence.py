"""Execution evidence from Spark event logs, as Spark jobs.

Inputs are the event-log tables of :mod:`adlake.sources.eventlog`. Every
function returns a DataFrame of evidence rows; the ``check_*`` helpers collect
those (small, per-report) rows and raise ``ValueError`` when evidence is missing,
ambiguous or contradicts the expectation. Task-level tables are only ever
aggregated or joined to small per-stage / per-execution tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adlake.functions.plan_nodes import plan_nodes
from adlake.model import JOIN_OPERATORS
from adlake.operators.stats import size_distribution
from adlake.plans.inspect import HASH_EXCHANGE_LINE, JOIN_LINE
from adlake.sources import eventlog as ev

# Fixed names of the task counters that run reports carry.
TASK_COUNTERS = ("executor_run_ms", "executor_cpu_ns", "input_bytes", "input_records", "shuffle_read_bytes",
                 "shuffle_write_bytes", "memory_spill_bytes", "disk_spill_bytes")
STAGE_KEY = ["application", "stage_id", "attempt_id"]
GOLD_GROUPS = ("gold.campaign_daily", "gold.audience_daily")
PROCESSING_PREFIXES = ("bronze.", "silver.", "gold.", "workload.")


def _stage_groups(log: DataFrame) -> DataFrame:
    """Stage attempt -> job group / SQL execution (one row per submitted stage attempt)."""
    return ev.stage_submitted(log).dropDuplicates(STAGE_KEY)


def task_metrics(log: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Task counters per job group ('internal' when a stage has no group),
    optionally also per ``by`` columns (e.g. ``application`` for one row set per application)."""
    tasks = ev.task_end(log).join(_stage_groups(log).select(*STAGE_KEY, "job_group"), STAGE_KEY, "left")
    return tasks.groupBy(*by, F.coalesce("job_group", F.lit("internal")).alias("job_group")).agg(
        F.count(F.lit(1)).alias("task_attempts"), F.sum("failed").cast("long").alias("failed_task_attempts"),
        *[F.sum(c).cast("long").alias(c) for c in TASK_COUNTERS],
        F.max("peak_execution_memory_bytes").alias("peak_task_execution_memory_bytes"))


def processing_totals(metrics: DataFrame, prefixes: tuple[str, ...] = PROCESSING_PREFIXES,
                      by: tuple[str, ...] = ()) -> DataFrame:
    """Sums of the task counters over processing job groups; max of peak memory."""
    pattern = "^(" + "|".join(p.replace(".", r"\.") for p in prefixes) + ")"
    return metrics.filter(F.col("job_group").rlike(pattern)).groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("task_attempts", "failed_task_attempts", *TASK_COUNTERS)],
        F.max("peak_task_execution_memory_bytes").alias("peak_task_execution_memory_bytes"))


def latest_plans(log: DataFrame) -> DataFrame:
    """Last plan event per SQL execution (file order) and how the execution ended."""
    plans = ev.sql_plans(log).groupBy("application", "execution_id").agg(
        F.max_by("plan", "seq").alias("plan"), F.max_by("plan_description", "seq").alias("plan_description"),
        F.count(F.lit(1)).alias("plan_events"))
    # a successful execution ends with an empty error message
    ends = ev.sql_end(log).groupBy("application", "execution_id").agg(
        F.max(F.nullif(F.col("error_message"), F.lit(""))).alias("error_message"), F.lit(True).alias("ended"))
    return (plans.join(ends, ["application", "execution_id"], "left")
            .withColumn("ended", F.coalesce("ended", F.lit(False)))
            .withColumn("succeeded", F.col("ended") & F.col("error_message").isNull()))


def execution_groups(log: DataFrame, groups: tuple[str, ...] | None = None) -> DataFrame:
    """(application, execution) -> job group, from the stages each execution submitted."""
    s = _stage_groups(log).filter(F.col("execution_id").isNotNull())
    if groups:
        s = s.filter(F.col("job_group").isin(*groups))
    return s.select("application", "execution_id", "job_group").distinct()


def nodes_of(log: DataFrame, groups: tuple[str, ...] | None = None) -> DataFrame:
    """Flattened latest plans of the executions that ran under ``groups``."""
    plans = latest_plans(log).join(execution_groups(log, groups), ["application", "execution_id"], "left_semi")
    return plan_nodes(plans)


def join_nodes(nodes: DataFrame) -> DataFrame:
    """Physical equi-join nodes with their first key and join type, read from the node's text."""
    part = {name: F.regexp_extract("simple_string", JOIN_LINE, k) for k, name in ((2, "key"), (3, "join_type"))}
    return nodes.filter(F.col("node_name").isin(*JOIN_OPERATORS)).select(
        "application", "execution_id", "node_path", F.col("node_name").alias("operator"), *[c.alias(n) for n, c in part.items()])


def join_strategies(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS) -> DataFrame:
    """Per joined execution of each group: its joins (key -> operator) and end status.
    Executions without joins (metadata queries in the same group) are ignored."""
    nodes = nodes_of(log, groups)
    joins = join_nodes(nodes).groupBy("application", "execution_id").agg(
        F.count(F.lit(1)).alias("joins"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "operator")))).alias("operators"),
        F.array_sort(F.collect_set("join_type")).alias("join_types"))
    return (joins.join(execution_groups(log, groups), ["application", "execution_id"])
            .join(latest_plans(log).select("application", "execution_id", "succeeded"), ["application", "execution_id"]))


def shuffle_exchanges(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS) -> DataFrame:
    """Initial hash-partition counts and AQE shuffle readers per execution."""
    nodes = nodes_of(log, groups)
    partitions = F.regexp_extract("simple_string", HASH_EXCHANGE_LINE, 1)
    exchanges = nodes.filter(F.col("node_name") == "Exchange").withColumn("n", partitions).filter("n != ''")
    reads = nodes.filter(F.col("node_name") == "AQEShuffleRead")
    e = exchanges.groupBy("application", "execution_id").agg(
        F.array_sort(F.collect_list(F.col("n").cast("int"))).alias("initial_partitions"))
    r = reads.groupBy("application", "execution_id").agg(
        F.count(F.lit(1)).alias("aqe_shuffle_reads"),
        F.max(F.lower("simple_string").contains("coalesced")).alias("coalesced"))
    return (e.join(r, ["application", "execution_id"], "left")
            .join(execution_groups(log, groups), ["application", "execution_id"]))


def stage_rollup(log: DataFrame, groups: tuple[str, ...] | None = None) -> DataFrame:
    """Per stage attempt: scheduled vs attempted vs failed tasks, completion,
    shuffle read/write, spill and CPU, with its group and SQL execution."""
    stages = _stage_groups(log)
    if groups:
        stages = stages.filter(F.col("job_group").isin(*groups))
    tasks = ev.task_end(log).groupBy(*STAGE_KEY).agg(
        F.count(F.lit(1)).alias("task_attempts"), F.sum("failed").cast("long").alias("failed_task_attempts"),
        F.count_distinct("task_index").alias("distinct_tasks"),
        *[F.sum(c).cast("long").alias(c) for c in ("shuffle_read_bytes", "shuffle_write_bytes",
                                                  "disk_spill_bytes", "memory_spill_bytes", "executor_cpu_ns")])
    done = ev.stage_completed(log).groupBy(*STAGE_KEY).agg(
        F.lit(True).alias("completed"), F.max("failure_reason").alias("failure_reason"))
    out = stages.join(tasks, STAGE_KEY, "left").join(done, STAGE_KEY, "left")
    return (out.fillna({"task_attempts": 0, "failed_task_attempts": 0, "distinct_tasks": 0, "shuffle_read_bytes": 0,
                        "shuffle_write_bytes": 0, "disk_spill_bytes": 0, "memory_spill_bytes": 0,
                        "executor_cpu_ns": 0, "completed": False})
            .withColumn("healthy", F.col("completed") & F.col("failure_reason").isNull()
                        & (F.col("failed_task_attempts") == 0)
                        & (F.col("task_attempts") == F.col("scheduled_tasks"))
                        & (F.col("distinct_tasks") == F.col("scheduled_tasks")))
            .withColumn("shuffle_reader", F.col("shuffle_read_bytes") > 0))


def reader_stages(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS) -> DataFrame:
    """E5: per execution: stages, shuffle-reader stages and reader tasks; all must be healthy."""
    s = stage_rollup(log, groups)
    return s.groupBy("application", "job_group", "execution_id").agg(
        F.count(F.lit(1)).alias("stages"), F.count_if("shuffle_reader").alias("reader_stages"),
        F.sum(F.when(F.col("shuffle_reader"), F.col("task_attempts"))).alias("reader_tasks"),
        F.min(F.col("healthy").cast("int")).cast("boolean").alias("all_healthy"))


def task_durations(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS) -> DataFrame:
    """Task-duration distribution per execution (count, total, min, median, p95, max)."""
    stages = _stage_groups(log).filter(F.col("job_group").isin(*groups))
    tasks = (ev.task_end(log).join(stages.select(*STAGE_KEY, "job_group", "execution_id"), STAGE_KEY)
             .withColumn("duration_ms", F.col("finish_time") - F.col("launch_time")))
    return size_distribution(tasks, ["application", "job_group", "execution_id"], "duration_ms")


def coalescing(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS) -> DataFrame:
    """Coalesced reader present or not, reader task count, task-duration distribution."""
    keys = ["application", "job_group", "execution_id"]
    return (shuffle_exchanges(log, groups).join(reader_stages(log, groups), keys)
            .join(task_durations(log, groups), keys))


def cache_lifecycle(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS) -> DataFrame:
    """Persisted RDDs used by the stages of ``groups``: storage level, partitions, which
    groups used them, and whether (and after their last use) they were released."""
    stages = _stage_groups(log).filter(F.col("job_group").isin(*groups))
    used = (stages.select("application", "job_group", "seq", F.explode("persisted_rdds").alias("r"))
            .select("application", "job_group", "seq", F.col("r.`RDD ID`").alias("rdd_id"),
                    F.col("r.`Number of Partitions`").alias("partitions"),
                    F.concat_ws(",", F.when(F.col("r.`Storage Level`.`Use Memory`"), "memory"),
                                F.when(F.col("r.`Storage Level`.`Use Disk`"), "disk"),
                                F.when(F.col("r.`Storage Level`.Deserialized"), "deserialized"))
                    .alias("storage_level"),
                    F.col("r.`Storage Level`.Replication").alias("replication")))
    per_rdd = used.groupBy("application", "rdd_id").agg(
        F.array_sort(F.collect_set("job_group")).alias("groups"), F.max("partitions").alias("partitions"),
        F.max("storage_level").alias("storage_level"), F.max("replication").alias("replication"),
        F.max("seq").alias("last_use"))
    released = ev.unpersisted(log).groupBy("application", "rdd_id").agg(F.max("seq").alias("released_at"))
    return (per_rdd.join(released, ["application", "rdd_id"], "left")
            .withColumn("released", F.col("released_at").isNotNull())
            .withColumn("released_after_last_use", F.coalesce(F.col("released_at") > F.col("last_use"), F.lit(False)))
            .drop("released_at", "last_use"))


def _sql_updates(log: DataFrame) -> DataFrame:
    """Numeric SQL accumulator updates of tasks, summed per (execution, accumulator)."""
    stages = _stage_groups(log).select(*STAGE_KEY, "execution_id")
    acc = (ev.task_end(log).select(*STAGE_KEY, F.explode("accumulables").alias("a"))
           .filter((F.col("a.Metadata") == "sql") & F.col("a.Update").rlike(r"^\d+$"))
           .select(*STAGE_KEY, F.col("a.ID").alias("accumulator_id"), F.col("a.Update").cast("long").alias("v")))
    return acc.join(stages, STAGE_KEY).groupBy("application", "execution_id", "accumulator_id") \
        .agg(F.sum("v").alias("value"))


def node_metric_totals(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS,
                       metric: str = "number of output rows") -> DataFrame:
    """Task totals of one SQL metric per plan-node category and execution.

    Categories: cache (InMemoryTableScan), join (*Join*), source (Scan parquet/csv),
    python (Python/Pandas evaluation nodes)."""
    nodes = nodes_of(log, groups)
    category = (F.when(F.col("node_name") == "InMemoryTableScan", "cache")
                .when(F.col("node_name").contains("Join"), "join")
                .when(F.col("node_name").startswith("Scan "), "source")
                .when(F.col("node_name").rlike("Python|Pandas"), "python"))
    ids = (nodes.withColumn("category", category).filter(F.col("category").isNotNull())
           .select("application", "execution_id", "category", F.explode("metrics").alias("m"))
           .filter(F.col("m.name") == metric)
           .select("application", "execution_id", "category", F.col("m.accumulatorId").alias("accumulator_id"))
           .distinct())
    totals = ids.join(_sql_updates(log), ["application", "execution_id", "accumulator_id"], "left")
    return (totals.groupBy("application", "execution_id", "category")
            .agg(F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("value"))
            .join(execution_groups(log, groups), ["application", "execution_id"]))


def cache_reuse(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS) -> DataFrame:
    """Output rows of cache scans, joins and source scans per execution (pivoted)."""
    t = node_metric_totals(log, groups)
    return t.groupBy("application", "job_group", "execution_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("category") == c, F.col("value"))), F.lit(0)).alias(f"{c}_rows")
          for c in ("cache", "join", "source")])


def python_eval(log: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Python evaluation operators and their executed metrics per execution."""
    nodes = nodes_of(log, groups).filter(F.col("node_name").rlike("Python|Pandas"))
    ids = (nodes.select("application", "execution_id", "node_name", F.explode("metrics").alias("m"))
           .select("application", "execution_id", "node_name", F.col("m.name").alias("metric"),
                   F.col("m.accumulatorId").alias("accumulator_id")))
    vals = ids.join(_sql_updates(log), ["application", "execution_id", "accumulator_id"], "left")
    return (vals.groupBy("application", "execution_id", "node_name", "metric")
            .agg(F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("total"))
            .join(execution_groups(log, groups), ["application", "execution_id"]))


def scan_metrics(log: DataFrame, groups: tuple[str, ...] | None = None) -> DataFrame:
    """Files and bytes selected by each executed file scan (driver-side SQL metrics)."""
    nodes = nodes_of(log, groups).filter(F.col("node_name").startswith("Scan "))
    ids = (nodes.select("application", "execution_id", "node_path", "node_name", F.explode("metrics").alias("m"))
           .filter(F.col("m.name").isin("number of files read", "size of files read"))
           .select("application", "execution_id", "node_path", "node_name", F.col("m.name").alias("metric"),
                   F.col("m.accumulatorId").alias("accumulator_id")))
    upd = ev.driver_accum_updates(log).groupBy("application", "execution_id", "accumulator_id") \
        .agg(F.sum("value").alias("value"))
    v = ids.join(upd, ["application", "execution_id", "accumulator_id"], "left")
    return (v.groupBy("application", "execution_id", "node_path", "node_name").agg(
        F.sum(F.when(F.col("metric") == "number of files read", F.col("value"))).alias("files_read"),
        F.sum(F.when(F.col("metric") == "size of files read", F.col("value"))).alias("bytes_read"))
        .join(execution_groups(log, groups), ["application", "execution_id"]))


def with_health(log: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence per execution with how the execution ended and whether all its stages were healthy."""
    keys = ["application", "execution_id"]
    ended = latest_plans(log).select(*keys, F.col("succeeded").alias("sql_succeeded"))
    stages = stage_rollup(log).filter(F.col("execution_id").isNotNull()).groupBy(*keys).agg(
        F.min(F.col("healthy").cast("int")).cast("boolean").alias("stages_healthy"))
    return evidence.join(ended, keys, "left").join(stages, keys, "left")


# --- raising checks ----------------------------------------------------------------------------
# A check is a table of what each evidence column must be, applied to one row per job group.

class EvidenceError(ValueError):
    """Recorded evidence is missing, ambiguous, or not what was expected."""


AT_LEAST_ONE = ("at least 1", lambda v: v is not None and v >= 1)
SOUND = {"sql_succeeded": True, "stages_healthy": True}


def require_events(log: DataFrame) -> None:
    if log.isEmpty():
        raise EvidenceError("the log holds no events")


def hold(evidence: DataFrame, expected: dict[str, dict], by: str = "job_group") -> dict:
    """Match evidence rows (few: one per group) with what is expected of each group's columns:
    a value, or a (description, test) pair. Returns the rows by group; raises EvidenceError
    with everything that is wrong."""
    rows: dict = {}
    wrong = []
    for row in evidence.collect():
        if row[by] in rows:
            wrong.append(f"{row[by]}: more than one execution")
        rows[row[by]] = row.asDict(recursive=True)
    wrong += [f"{group}: no evidence" for group in expected if group not in rows]
    wrong += [f"{group}: evidence of a group that should have none" for group in rows if group not in expected]
    for group in rows.keys() & expected.keys():
        for column, want in expected[group].items():
            value = rows[group][column]
            told, test = want if isinstance(want, tuple) else (repr(want), lambda v, want=want: v == want)
            if not test(value):
                wrong.append(f"{group}: {column} is {value!r}, expected {told}")
    if wrong:
        raise EvidenceError("; ".join(sorted(wrong)))
    return rows


def check_join_strategies(log: DataFrame, operators: dict[str, str], groups: tuple[str, ...] = GOLD_GROUPS) -> dict:
    """Each report's joins are left joins on these keys with these operators."""
    want = {"operators": operators, "joins": len(operators), "join_types": ["LeftOuter"], **SOUND}
    return hold(with_health(log, join_strategies(log, groups)), dict.fromkeys(groups, want))


def check_shuffle_partitions(log: DataFrame, partitions: int, groups: tuple[str, ...] = GOLD_GROUPS) -> dict:
    """Every hash exchange of each report starts with so many partitions."""
    only = (f"only {partitions}", lambda v: bool(v) and set(v) == {partitions})
    return hold(with_health(log, shuffle_exchanges(log, groups)), dict.fromkeys(groups, {"initial_partitions": only, **SOUND}))


def check_reader_stages(log: DataFrame, groups: tuple[str, ...] = GOLD_GROUPS) -> dict:
    """E5: all stages healthy, and at least one read a shuffle."""
    return hold(with_health(log, reader_stages(log, groups)), dict.fromkeys(groups, {"reader_stages": AT_LEAST_ONE, **SOUND}))


def check_coalescing(log: DataFrame, enabled: bool, groups: tuple[str, ...] = GOLD_GROUPS) -> dict:
    """A coalesced shuffle reader exactly when coalescing is on."""
    told = "a coalesced reader" if enabled else "no coalesced reader"
    return hold(with_health(log, coalescing(log, groups)),
                dict.fromkeys(groups, {"coalesced": (told, lambda v: bool(v) is enabled), **SOUND}))


def check_cache_reuse(log: DataFrame, impressions: int, cached: bool) -> dict:
    """With a cache the first report does the joins and the second reads only the cache, all
    impressions of it; without one both join and neither reads a cache."""
    joined = {"join_rows": AT_LEAST_ONE, **SOUND}
    first, second = GOLD_GROUPS
    if cached:
        want = {first: {**joined, "source_rows": AT_LEAST_ONE},
                second: {"cache_rows": impressions, "join_rows": 0, "source_rows": 0, **SOUND}}
    else:
        want = dict.fromkeys(GOLD_GROUPS, {**joined, "cache_rows": 0})
    return hold(with_health(log, cache_reuse(log)), want)


def check_python_eval(log: DataFrame, silver_rows: int, groups: tuple[str, ...] = ("silver.impressions", *GOLD_GROUPS)) -> dict:
    """One row-at-a-time Python evaluation, in Silver only, that sent and got bytes and
    gave a row for each Silver row."""
    metric = F.map_from_entries(F.collect_list(F.struct("metric", "total")))
    nodes = python_eval(log, groups).groupBy("application", "execution_id", "job_group", "node_name").agg(metric.alias("metrics"))
    named = {"sent": "data sent to Python workers", "returned": "data returned from Python workers", "rows": "number of output rows"}
    nodes = nodes.select("*", *[F.col("metrics")[m].alias(c) for c, m in named.items()])
    want = {"node_name": "BatchEvalPython", "sent": AT_LEAST_ONE, "returned": AT_LEAST_ONE, "rows": silver_rows, **SOUND}
    return hold(with_health(log, nodes), {groups[0]: want})


def check_scan_metrics(log: DataFrame, groups: tuple[str, ...]) -> dict:
    """Each group's one file scan reports the files and bytes it selected."""
    want = {"files_read": AT_LEAST_ONE, "bytes_read": AT_LEAST_ONE, **SOUND}
    return hold(with_health(log, scan_metrics(log, groups)), dict.fromkeys(groups, want))


def check_written_files(sizes: DataFrame, reported: dict[str, int]) -> dict:
    """Files found per table are those that the run's report counted."""
    return hold(sizes, {table: {"count": n} for table, n in reported.items()}, by="table_name")
