"""Full rebuild: sources -> Bronze -> Silver -> checks -> Gold -> checks -> report (3.1).

Every phase runs under a Spark job group named after it (so an event log can attribute
tasks to phases), and the run's SQL settings are scoped to the run. Row counts, content
sums and the fact's totals are observed while the tables are written, so validation only
reads the key columns again. The report is a dict, published anew after every phase, so a run
that was killed shows how far it came (:mod:`adlake.plans.reports`); it ends as ``succeeded``
or, with the error's text, as ``failed``. A root that holds a report is never written to.
"""
from __future__ import annotations

import contextlib
import sys
import time
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from adlake.model import DIMENSIONS, GOLD_KEYS, RECORDED_SETTINGS, SOURCES, Options
from adlake.operators import quality as qc
from adlake.operators import transforms as tx
from adlake.operators.joins import shuffle_partitions_for, shuffles_the_fact
from adlake.operators.storage import list_files, storage_totals
from adlake.plans.reports import ReportFolder, load_report, save_report
from adlake.session import conf_scope, settings
from adlake.sources.tables import read_table, table_path, write_table

#: Columns both reports need from the enrichment (what a cache must keep).
REPORT_COLUMNS = sorted({"clicked", "missing_profile"}.union(*GOLD_KEYS.values()))


@contextlib.contextmanager
def job_group(spark: SparkSession, name: str):
    """Jobs started inside carry ``name`` as their group."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        yield
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def environment(spark: SparkSession) -> dict:
    """What two comparable runs must share, and the settings they may declare to differ in."""
    conf = spark.sparkContext.getConf()
    return {"spark": spark.version, "python": sys.version.split()[0],
            "java": spark.sql("SELECT java_method('java.lang.System', 'getProperty', 'java.version')").first()[0],
            "master": spark.sparkContext.master, "driver_memory": conf.get("spark.driver.memory", "1g"),
            "spark_sql_settings": settings(spark, RECORDED_SETTINGS)}


class _Run:
    """One rebuild: its root, options and report."""

    def __init__(self, spark: SparkSession, root: str, opts: Options, run_id: str):
        self.spark, self.root, self.opts = spark, root.rstrip("/"), opts
        self.folder = ReportFolder(spark, f"{self.root}/_report")
        self.report: dict = {"run_id": run_id, "status": "running", "started_at": _now(),
                             "options": {k: list(v) if isinstance(v, tuple) else v for k, v in opts.__dict__.items()},
                             "seconds": {}, "tables": {}, "checks": {}, "sources": {}}

    def claim(self) -> None:
        """Take the root, or refuse one that a run has already reported in; touches nothing then."""
        try:
            self.folder.claim(self.report)
        except FileExistsError as error:
            raise FileExistsError(f"{self.root} holds the report of another run") from error

    @contextlib.contextmanager
    def phase(self, name: str):
        begin = time.perf_counter()
        try:
            with job_group(self.spark, name):
                yield
        finally:
            self.report["seconds"][name] = round(time.perf_counter() - begin, 3)
        self.folder.save(self.report)

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.root, layer, name, self.opts.fmt)

    def write(self, df: DataFrame, layer: str, name: str, metrics=(), **how) -> dict:
        """Write a table under its phase; return the metrics observed on the way."""
        seen = Observation()
        with self.phase(f"{layer}.{name}"):
            write_table(df, self.root, layer, name, self.opts, observe=(seen, list(metrics)) if metrics else None, **how)
            found = dict(seen.get) if metrics else {}
            self.report["tables"][f"{layer}/{name}"] = {"rows": found.get("rows", found.get("impressions"))}
        return found

    def finish(self, started: float) -> None:
        seconds = self.report["seconds"]
        for label, prefixes in (("pipeline_writes", ("bronze.", "silver.", "gold.")), ("validation", ("validate.",))):
            seconds[label] = round(sum(v for k, v in seconds.items() if k.startswith(prefixes)), 3)
        seconds["total"] = round(time.perf_counter() - started, 3)
        self.report["finished_at"] = _now()
        self.folder.save(self.report)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def run_pipeline(spark: SparkSession, bronze_sources: dict[str, DataFrame], root: str,
                 opts: Options | None = None, *, run_id: str = "run", source_path: str | None = None) -> dict:
    """Rebuild every table under ``root`` from the given Bronze-form sources.

    ``source_path`` is where the sources' files lie, for their bytes in the report."""
    opts = opts or Options()
    run, started = _Run(spark, root, opts, run_id), time.perf_counter()
    run.claim()
    report = run.report
    try:
        with conf_scope(spark, opts.session_conf()):
            report["environment"] = environment(spark)
            _layers(run, bronze_sources)
            _storage(run, source_path)
        report["status"] = "succeeded"
    except BaseException as error:
        report.update(status="failed", error=f"{type(error).__name__}: {error}")
        raise
    finally:
        run.finish(started)
    return report


def _layers(run: _Run, bronze_sources: dict[str, DataFrame]) -> None:
    rows = {}
    for name, (file_name, _) in SOURCES.items():
        content = (qc.observed_content(bronze_sources[name]) if run.opts.fingerprint_sources
                   else [F.count(F.lit(1)).alias("rows")])
        seen = run.write(bronze_sources[name], "bronze", name, content)
        rows[name] = seen["rows"]
        if run.opts.fingerprint_sources:
            run.report["sources"][file_name] = {"rows": seen["rows"], "row_hash_sum": seen["hash_sum"]}
    facts = {}
    for name in SOURCES:
        silver = tx.silver_table(name, run.read("bronze", name), run.opts)
        if name == "impressions":
            facts = run.write(silver, "silver", name, qc.observed_facts(), partition_by=run.opts.partition_by,
                              cluster_by=run.opts.cluster_by)
        else:
            run.write(silver, "silver", name, [F.count(F.lit(1)).alias("rows")])
    silver = {name: run.read("silver", name) for name in SOURCES}
    with run.phase("validate.silver"):
        for name, n in rows.items():
            kept = run.report["tables"][f"silver/{name}"]["rows"]
            qc.refuse(name, {"rows lost or added": n - kept, "empty table": int(not n)})
        run.report["checks"].update(qc.validate_dimensions(silver["ads"], silver["user_profiles"]))
        totals = qc.validate_impressions(*silver.values(), seen=facts)
        run.report["checks"]["silver_totals"] = totals
    with conf_scope(run.spark, _gold_conf(run, silver)):
        _gold(run, silver, totals)


def _gold_conf(run: _Run, silver: dict[str, DataFrame]) -> dict[str, str]:
    """Initial partitions sized to the fact when a join shuffles it; else only partial sums
    are shuffled, and the session's number serves."""
    opts = run.opts
    if opts.shuffle_partitions != "auto" or not any(
            shuffles_the_fact(silver[d.table].select(d.key, *d.attributes), getattr(opts, d.strategy), opts.broadcast_limit)
            for d in DIMENSIONS):
        return {}
    n = shuffle_partitions_for(silver["impressions"])
    run.report["gold_shuffle_partitions"] = n
    return {"spark.sql.shuffle.partitions": str(n)} if n else {}


def _gold(run: _Run, silver: dict[str, DataFrame], totals: dict) -> None:
    """Both reports. What they share, if the options ask for that, is kept while both are made
    and released afterwards; a failing release never hides the error before it."""
    opts, shared = run.opts, None
    enriched = tx.enrich(silver, opts)
    if opts.cache:
        shared = enriched.select(*REPORT_COLUMNS)
        build = lambda keys: tx.daily_report(shared, keys)
    elif opts.shared_rollup:
        shared = tx.gold_rollup(enriched)
        build = lambda keys: tx.report_from_rollup(shared, keys)
    else:
        build = lambda keys: tx.daily_report(enriched, keys)
    if shared is not None:
        shared.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        for name, keys in GOLD_KEYS.items():
            run.write(build(keys), "gold", name, [F.count(F.lit(1)).alias("rows")])
            with run.phase(f"validate.{name}"):
                run.report["checks"][name] = qc.validate_gold(run.read("gold", name), totals, name)
    except BaseException:
        if shared is not None:
            try:
                release(run, shared)
            except Exception as error:  # noqa: BLE001 - reported beside the first error
                run.report["cache_cleanup_error"] = str(error)
        raise
    if shared is not None:
        release(run, shared)


def release(run: _Run, shared: DataFrame) -> None:
    with run.phase("gold.cache_release"):
        shared.unpersist(blocking=True)


def _storage(run: _Run, source_path: str | None) -> None:
    tables, storage = run.report["tables"], {}
    with run.phase("storage"):
        for row in storage_totals(run.spark, run.root).collect():
            table = tables.get(f"{row['layer']}/{row['table_name']}")
            if table is not None:
                table.update({k: row[k] for k in ("total_bytes", "parquet_bytes", "parquet_files")})
        storage["table_bytes"] = sum(t.get("total_bytes", 0) for t in tables.values())
        conf = run.spark.sparkContext.getConf()
        logs = conf.get("spark.eventLog.dir") if conf.get("spark.eventLog.enabled", "false") == "true" else None
        application = f"*{run.spark.sparkContext.applicationId}*"
        for label, path, glob in (("source_bytes", source_path, None), ("event_log_bytes", logs, application)):
            if path:
                storage[label] = list_files(run.spark, path, glob).agg(F.sum("length")).first()[0]
    run.report["storage"] = storage


def gold_table(spark: SparkSession, root: str, name: str, opts: Options | None = None) -> DataFrame:
    return read_table(spark, root, "gold", name, (opts or Options()).fmt)


__all__ = ["run_pipeline", "save_report", "load_report", "gold_table", "job_group", "table_path", "REPORT_COLUMNS"]
