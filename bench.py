"""Bench: the reference's measured workloads at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Impressions are the bench-scale fact (one per lineitem, joined to its order's
customer); ads and profiles come from part and customer. Timed, like the
reference's experiments:

* the full rebuild from raw CSV files (strict CSV -> Bronze -> Silver -> checks -> Gold) per phase;
* Gold (both reports) from the written Silver under each strategy preset;
* Silver impressions with the built-in date vs Python UDFs;
* read workloads on typed CSV vs Parquet, and on Silver unpartitioned vs by date;
* one exact table comparison.

Each timed query is executed completely (``noop`` sink or a real write), median
of ``$BENCH_REPEATS`` runs. Prints one JSON line.
"""
from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

from pyspark import StorageLevel

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlake.model import GOLD_KEYS  # noqa: E402
from adlake.operators import transforms as tx  # noqa: E402
from adlake.operators.equality import table_diff  # noqa: E402
from adlake.operators.reads import day_start_epoch, format_query, silver_query, typed_impressions  # noqa: E402
from adlake.plans.pipeline import REPORT_COLUMNS, run_pipeline  # noqa: E402
from adlake.plans.variants import PRESETS  # noqa: E402
from adlake.session import build_session, conf_scope, scratch_path  # noqa: E402
from adlake.sources.adapter import bench_views  # noqa: E402
from adlake.sources.csv import (read_impressions_csv, read_source_csv, write_source_csv,  # noqa: E402
                                write_typed_csv)
from adlake.sources.tables import csv_to_parquet, read_table, write_table  # noqa: E402

BENCH_DAY = dt.date(1998, 6, 1)  # inside the lineitem ship-date range


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int) -> float:
    samples = []
    for _ in range(repeats):
        start = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - start)
    return round(statistics.median(samples), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", "adlake-bench", shuffle_partitions=2 * cpus)
    queries: dict[str, float] = {}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]

    # warm-up (JIT, metadata), not timed
    noop(tx.campaign_daily(tx.enrich(tx.silver_views(bench_views(spark, sf_dir)))))

    # 1. raw CSV sources (prepared once, like the reference's input files), then the full
    #    rebuild from them: strict CSV -> Bronze -> Silver -> checks -> Gold
    raw_dir = scratch_path(spark, "bench-raw")
    start = time.perf_counter()
    for name, df in bench_views(spark, sf_dir).items():
        write_source_csv(df, raw_dir, name)
    queries["prepare.raw_csv_sources"] = round(time.perf_counter() - start, 3)
    sources = {name: read_source_csv(spark, raw_dir, name) for name in ("impressions", "ads", "user_profiles")}
    root = scratch_path(spark, "bench-pipeline")
    report = run_pipeline(spark, sources, root, PRESETS["zstd"][0])
    for key in ("bronze.impressions", "silver.impressions", "gold.campaign_daily", "gold.audience_daily",
                "pipeline_writes", "validation", "total"):
        queries[f"pipeline.{key}"] = report["seconds"][key]

    silver = {n: read_table(spark, root, "silver", n) for n in ("impressions", "ads", "user_profiles")}
    bronze_imp = read_table(spark, root, "bronze", "impressions")

    # 2. Gold (both reports, written as tables) per strategy preset
    def gold(preset: str):
        opts = PRESETS[preset][0]

        def run():
            target = scratch_path(spark, f"bench-gold-{preset}")
            with conf_scope(spark, opts.session_conf()):
                enriched, shared = tx.enrich(silver, opts), None
                if opts.cache:
                    shared = enriched.select(*REPORT_COLUMNS)
                elif opts.shared_rollup:
                    shared = tx.gold_rollup(enriched)
                if shared is not None:
                    shared.persist(StorageLevel.MEMORY_AND_DISK_DESER)
                for name, keys in GOLD_KEYS.items():
                    rows = tx.report_from_rollup(shared, keys) if opts.shared_rollup else tx.daily_report(shared or enriched, keys)
                    write_table(rows, target, "gold", name, opts)
                if shared is not None:
                    shared.unpersist(blocking=True)
        return run

    for preset in ("control", "ads_merge", "profiles_merge", "ads_broadcast", "shuffle_32", "cached",
                   "no_coalesce", "shared_rollup"):
        queries[f"gold.{preset}"] = timed(gold(preset), repeats)

    # 3. Silver impressions: built-in date vs Python UDFs
    for preset in ("control", "python_udf", "arrow_udf"):
        opts = PRESETS[preset][0]
        queries[f"silver_impressions.{preset}"] = timed(
            lambda opts=opts: noop(tx.silver_table("impressions", bronze_imp, opts)), repeats)

    # 4. read workloads: typed CSV vs Parquet; Silver plain vs date-partitioned
    csv_path = write_typed_csv(typed_impressions(bronze_imp), scratch_path(spark, "bench-typed-csv"))
    conversion = csv_to_parquet(spark, csv_path, scratch_path(spark, "bench-typed-parquet"))
    queries["prepare.csv_to_parquet"] = round(conversion["conversion_seconds"], 3)
    # relations (schema, file listing) are prepared once per side, outside the timing
    frames = {"csv": read_impressions_csv(spark, csv_path), "parquet": spark.read.parquet(conversion["path"])}
    day_start = day_start_epoch(BENCH_DAY)
    for fmt, frame in frames.items():
        for workload in ("narrow", "wide", "one_day"):
            queries[f"read.{fmt}.{workload}"] = timed(
                lambda f=frame, w=workload: format_query(f, w, day_start).collect(), repeats)
    part_root = scratch_path(spark, "bench-partitioned")
    start = time.perf_counter()
    write_table(silver["impressions"], part_root, "silver", "impressions", PRESETS["zstd"][0],
                partition_by=("reporting_date",))
    queries["write.silver_by_date"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    write_table(silver["impressions"], scratch_path(spark, "bench-plain"), "silver", "impressions", PRESETS["zstd"][0])
    queries["write.silver_plain"] = round(time.perf_counter() - start, 3)
    clustered_root = scratch_path(spark, "bench-clustered")
    start = time.perf_counter()
    write_table(silver["impressions"], clustered_root, "silver", "impressions", PRESETS["zstd"][0],
                cluster_by=PRESETS["date_clustered"][0].cluster_by)
    queries["write.silver_clustered"] = round(time.perf_counter() - start, 3)
    layouts = {"plain": spark.read.parquet(f"{root}/silver/impressions"),
               "by_date": spark.read.parquet(f"{part_root}/silver/impressions"),
               "clustered": spark.read.parquet(f"{clustered_root}/silver/impressions")}
    for layout, frame in layouts.items():
        for workload in ("one_day", "three_days", "full_period"):
            queries[f"read.silver_{layout}.{workload}"] = timed(
                lambda f=frame, w=workload: silver_query(f, w, BENCH_DAY).collect(), repeats)

    # 5. exact comparison of a Gold table with a recomputation under another strategy
    gold_written = read_table(spark, root, "gold", "campaign_daily")
    variant = tx.campaign_daily(tx.enrich(silver,
                                          PRESETS["ads_merge"][0]))

    def compare():
        if not table_diff(gold_written, variant).isEmpty():
            raise AssertionError("variant differs from control")
    queries["exact_comparison.campaign_daily"] = timed(compare, repeats)

    def compare_except_all():  # the two-pass EXCEPT ALL method, for contrast
        cols = sorted(gold_written.columns)
        left, right = gold_written.select(*cols), variant.select(*cols)
        if not (left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()):
            raise AssertionError("variant differs from control")
    queries["exact_comparison.campaign_daily_except_all"] = timed(compare_except_all, repeats)

    # headline: the full rebuild plus every measured workload; one-off preparation
    # (raw files, format conversion) is reported, not summed
    total = round(sum(v for k, v in queries.items()
                      if not k.startswith(("pipeline.", "prepare.")) or k == "pipeline.total"), 3)
    # storage shapes (bytes of data files), for the L1-L3 comparison with the baseline
    from pyspark.sql import functions as F
    from adlake.operators.storage import list_files
    storage = {}
    for label, path, glob in (("typed_csv", csv_path, "*.csv"), ("typed_parquet", conversion["path"], "*.parquet"),
                              ("silver_impressions_zstd", f"{root}/silver/impressions", "*.parquet"),
                              ("silver_impressions_zstd_by_date", f"{part_root}/silver/impressions", "*.parquet"),
                              ("silver_impressions_zstd_clustered", f"{clustered_root}/silver/impressions", "*.parquet")):
        row = list_files(spark, path, glob).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first()
        storage[label] = {"files": row["files"], "bytes": row["bytes"]}
    print(json.dumps({"metric": "total_workload_seconds", "value": total, "unit": "sec",
                      "queries": queries, "sf": sf, "cpus": cpus, "repeats": repeats, "storage": storage}))
    spark.stop()


if __name__ == "__main__":
    main()
