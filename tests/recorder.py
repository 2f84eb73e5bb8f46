"""Record event logs of pipeline runs with Spark's default log settings (rolled, zstd), for the evidence tests.

    python tests/recorder.py <sf_dir> <out_dir>

Each run is its own application named ``record-<run>``. A session can't turn event logging on
after it started, hence the process of its own.
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from adlake.model import Options  # noqa: E402
from adlake.operators.reads import FORMAT_WORKLOADS, format_query, typed_impressions  # noqa: E402
from adlake.plans.pipeline import job_group, run_pipeline  # noqa: E402
from adlake.session import build_session  # noqa: E402
from adlake.sources.adapter import bronze_views  # noqa: E402

BASE = Options(codec="zstd", shuffle_partitions=16)
RUNS = {"control": BASE, "ads_merge": BASE.with_(ads_join="merge"), "cached": BASE.with_(cache=True),
        "python_udf": BASE.with_(date_impl="python"), "no_coalesce": BASE.with_(coalesce=False)}


def main(sf_dir: str, out: str) -> None:
    os.makedirs(f"{out}/events")
    for name, opts in RUNS.items():
        spark = build_session("local[4]", f"record-{name}", shuffle_partitions=16,
                              extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"{out}/events"})
        try:
            run_pipeline(spark, bronze_views(spark, sf_dir), f"{out}/runs/{name}", opts, run_id=name)
            if name == "control":
                typed = typed_impressions(spark.read.parquet(f"{out}/runs/{name}/bronze/impressions"))
                for workload in FORMAT_WORKLOADS:
                    with job_group(spark, f"workload.{workload}"):
                        format_query(typed, workload).collect()
        finally:
            spark.stop()
            SparkSession._instantiatedSession = None


if __name__ == "__main__":
    main(*sys.argv[1:])
