"""Spark event logs as tables.

Logs are read as Spark writes them: one file per application or a folder of rolled files,
plain or compressed with any of Spark's codecs. Every event is keyed on its application, taken from
the path, so events of one application meet whatever file they are in. ``seq`` puts an application's events in order:
the number of the rolled file, then the place in it.

Plain files are text that Spark splits. A compressed file is streamed by one task, a batch of
lines at a time; Spark rolls files at 128 MiB, which bounds what that task does.
"""
from __future__ import annotations

import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.operators.storage import list_files, open_file
from adlake.sources.codecs import OPENERS

#: Lines handed over at once, and how a compressed file's name ends.
BATCH_LINES = 5000
_ENDINGS = "|".join(e.removeprefix(".") for e in OPENERS)
_COMPRESSED = rf"\.({_ENDINGS})(\.inprogress)?$"
_ROLLED = r"/eventlog_v2_([^/]+)/events_(\d+)_[^/]*$"
_SINGLE = rf"([^/]+?)(?:\.(?:{_ENDINGS}))?(?:\.inprogress)?$"

STAGE_SUBMITTED = ("struct<`Stage Info`:struct<`Stage ID`:long,`Stage Attempt ID`:long,`Number of Tasks`:long,"
                   "`RDD Info`:array<struct<`RDD ID`:long,`Number of Partitions`:long,"
                   "`Storage Level`:struct<`Use Disk`:boolean,`Use Memory`:boolean,`Deserialized`:boolean,"
                   "`Replication`:int>>>>,Properties:map<string,string>>")
STAGE_COMPLETED = ("struct<`Stage Info`:struct<`Stage ID`:long,`Stage Attempt ID`:long,"
                   "`Failure Reason`:string>>")
TASK_END = (
    "struct<`Stage ID`:long,`Stage Attempt ID`:long,`Task End Reason`:struct<Reason:string>,"
    "`Task Info`:struct<Index:long,`Launch Time`:long,`Finish Time`:long,"
    "Accumulables:array<struct<ID:long,Metadata:string,Update:string>>>,"
    "`Task Metrics`:struct<`Executor Run Time`:long,`Executor CPU Time`:long,`Peak Execution Memory`:long,"
    "`Memory Bytes Spilled`:long,`Disk Bytes Spilled`:long,"
    "`Input Metrics`:struct<`Bytes Read`:long,`Records Read`:long>,"
    "`Shuffle Read Metrics`:struct<`Remote Bytes Read`:long,`Local Bytes Read`:long>,"
    "`Shuffle Write Metrics`:struct<`Shuffle Bytes Written`:long>>>")
SQL_PLAN = "struct<executionId:long,physicalPlanDescription:string,sparkPlanInfo:string>"
SQL_END = "struct<executionId:long,errorMessage:string>"
DRIVER_ACCUM = "struct<executionId:long,accumUpdates:array<array<long>>>"


def _compressed_lines(batches):
    import re
    for batch in batches:
        for path in batch.column("path").to_pylist():
            opener = OPENERS["." + re.search(_COMPRESSED, path)[1]]
            with open_file(path) as raw, opener(raw) as plain:
                lines, number = [], 0
                for line in io.TextIOWrapper(plain, "utf-8"):
                    lines.append(line.rstrip("\n"))
                    if len(lines) == BATCH_LINES:
                        yield _lines(path, number, lines)
                        lines, number = [], number + len(lines)
                if lines:
                    yield _lines(path, number, lines)


def _lines(path: str, first: int, lines: list[str]) -> pa.RecordBatch:
    place = pa.array(range(first, first + len(lines)), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), place, pa.array(lines)], names=["path", "place", "value"])


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Every event of the logs under ``path``: application, seq, event type and JSON."""
    files = list_files(spark, path)
    plain = (spark.read.option("recursiveFileLookup", True).text(path)
             .filter(~F.col("_metadata.file_name").startswith("appstatus") & ~F.col("_metadata.file_name").rlike(_COMPRESSED))
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("place"), "value"))
    packed = files.filter(F.col("path").rlike(_COMPRESSED) & ~F.col("path").contains("/appstatus")).select("path").mapInArrow(
        _compressed_lines, "path string, place long, value string").withColumn("start", F.lit(0).cast("long"))
    rolled = F.regexp_extract("path", _ROLLED, 1)
    return plain.unionByName(packed).select(
        F.when(rolled != "", rolled).otherwise(F.regexp_extract("path", _SINGLE, 1)).alias("application"),
        F.struct(F.coalesce(F.nullif(F.regexp_extract("path", _ROLLED, 2), F.lit("")).cast("int"), F.lit(0)).alias("file"),
                 "start", "place").alias("seq"),
        F.get_json_object("value", "$.Event").alias("event"), F.col("value").alias("json"))


def _of(log: DataFrame, kind: str, schema: str) -> DataFrame:
    return (log.filter(F.col("event") == kind)
            .select("application", "seq", F.from_json("json", schema).alias("e")))


def stage_submitted(log: DataFrame) -> DataFrame:
    s = _of(log, "SparkListenerStageSubmitted", STAGE_SUBMITTED)
    return s.select(
        "application", "seq", F.col("e.`Stage Info`.`Stage ID`").alias("stage_id"),
        F.col("e.`Stage Info`.`Stage Attempt ID`").alias("attempt_id"),
        F.col("e.`Stage Info`.`Number of Tasks`").alias("scheduled_tasks"),
        F.transform(F.col("e.`Stage Info`.`RDD Info`"), lambda r: r["RDD ID"]).alias("rdd_ids"),
        F.filter(F.col("e.`Stage Info`.`RDD Info`"),
                 lambda r: r["Storage Level"]["Use Memory"] | r["Storage Level"]["Use Disk"]).alias("persisted_rdds"),
        F.coalesce(F.col("e.Properties")["spark.jobGroup.id"], F.lit("internal")).alias("job_group"),
        F.col("e.Properties")["spark.sql.execution.id"].cast("long").alias("execution_id"))


def stage_completed(log: DataFrame) -> DataFrame:
    s = _of(log, "SparkListenerStageCompleted", STAGE_COMPLETED)
    return s.select("application", F.col("e.`Stage Info`.`Stage ID`").alias("stage_id"),
                    F.col("e.`Stage Info`.`Stage Attempt ID`").alias("attempt_id"),
                    F.col("e.`Stage Info`.`Failure Reason`").alias("failure_reason"))


def task_end(log: DataFrame) -> DataFrame:
    t = _of(log, "SparkListenerTaskEnd", TASK_END)
    m = "e.`Task Metrics`"
    return t.select(
        "application", F.col("e.`Stage ID`").alias("stage_id"), F.col("e.`Stage Attempt ID`").alias("attempt_id"),
        F.col("e.`Task Info`.Index").alias("task_index"),
        (F.col("e.`Task End Reason`.Reason") != "Success").cast("int").alias("failed"),
        F.col("e.`Task Info`.`Launch Time`").alias("launch_time"),
        F.col("e.`Task Info`.`Finish Time`").alias("finish_time"),
        F.coalesce(F.col(f"{m}.`Executor Run Time`"), F.lit(0)).alias("executor_run_ms"),
        F.coalesce(F.col(f"{m}.`Executor CPU Time`"), F.lit(0)).alias("executor_cpu_ns"),
        F.coalesce(F.col(f"{m}.`Input Metrics`.`Bytes Read`"), F.lit(0)).alias("input_bytes"),
        F.coalesce(F.col(f"{m}.`Input Metrics`.`Records Read`"), F.lit(0)).alias("input_records"),
        (F.coalesce(F.col(f"{m}.`Shuffle Read Metrics`.`Remote Bytes Read`"), F.lit(0))
         + F.coalesce(F.col(f"{m}.`Shuffle Read Metrics`.`Local Bytes Read`"), F.lit(0))).alias("shuffle_read_bytes"),
        F.coalesce(F.col(f"{m}.`Shuffle Write Metrics`.`Shuffle Bytes Written`"), F.lit(0))
        .alias("shuffle_write_bytes"),
        F.coalesce(F.col(f"{m}.`Memory Bytes Spilled`"), F.lit(0)).alias("memory_spill_bytes"),
        F.coalesce(F.col(f"{m}.`Disk Bytes Spilled`"), F.lit(0)).alias("disk_spill_bytes"),
        F.coalesce(F.col(f"{m}.`Peak Execution Memory`"), F.lit(0)).alias("peak_execution_memory_bytes"),
        F.col("e.`Task Info`.Accumulables").alias("accumulables"))


def sql_plans(log: DataFrame) -> DataFrame:
    """Plan events (execution start and every adaptive update) with their file order."""
    kinds = ["org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart",
             "org.apache.spark.sql.execution.ui.SparkListenerSQLAdaptiveExecutionUpdate"]
    p = (log.filter(F.col("event").isin(*kinds))
         .select("application", "seq", F.from_json("json", SQL_PLAN).alias("e")))
    return p.select("application", "seq", F.col("e.executionId").alias("execution_id"),
                    F.col("e.sparkPlanInfo").alias("plan"),
                    F.col("e.physicalPlanDescription").alias("plan_description"))


def sql_end(log: DataFrame) -> DataFrame:
    e = (log.filter(F.col("event") == "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd")
         .select("application", F.from_json("json", SQL_END).alias("e")))
    return e.select("application", F.col("e.executionId").alias("execution_id"),
                    F.col("e.errorMessage").alias("error_message"))


def driver_accum_updates(log: DataFrame) -> DataFrame:
    """Driver-side SQL metric updates (e.g. files/bytes selected by a scan): (execution, id, value)."""
    d = (log.filter(F.col("event") == "org.apache.spark.sql.execution.ui.SparkListenerDriverAccumUpdates")
         .select("application", F.from_json("json", DRIVER_ACCUM).alias("e")))
    return (d.select("application", F.col("e.executionId").alias("execution_id"),
                     F.explode("e.accumUpdates").alias("u"))
            .select("application", "execution_id", F.col("u")[0].alias("accumulator_id"),
                    F.col("u")[1].alias("value")))


def applications(log: DataFrame) -> DataFrame:
    """(application -> its name, id) from the application-start event."""
    a = (log.filter(F.col("event") == "SparkListenerApplicationStart")
         .select("application", F.from_json("json", "struct<`App Name`:string,`App ID`:string>").alias("e")))
    return a.select("application", F.col("e.`App Name`").alias("app_name"), F.col("e.`App ID`").alias("app_id"))


def unpersisted(log: DataFrame) -> DataFrame:
    """RDDs released (unpersist events) with their file order."""
    u = _of(log, "SparkListenerUnpersistRDD", "struct<`RDD ID`:long>")
    return u.select("application", "seq", F.col("e.`RDD ID`").alias("rdd_id"))
