"""Comparison of runs (3.2), the data part: outputs equal, runs comparable, measurements summarised.

* :func:`output_equality` compares every table of every run with the control run's, each
  table in one grouped pass over all runs.
* :func:`report_measurements` flattens run reports into (run_id, metric, value) rows.
* :func:`summarize` gives, per metric, each side's distribution and the right-vs-left
  change of medians (A13, A15, E12).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.model import GOLD_KEYS, SOURCES
from adlake.operators.equality import schema_differences
from adlake.operators.stats import distribution, right_vs_left
from adlake.sources.tables import read_table

COMPARED_TABLES = tuple((layer, name) for layer in ("bronze", "silver") for name in SOURCES) + tuple(
    ("gold", name) for name in GOLD_KEYS)


def _compared(tables: dict[str, DataFrame], control: str, label: str) -> DataFrame:
    """Per run other than the control: rows on each side and rows without a partner, from one
    grouping of all runs' rows by value with a counter per run."""
    columns = sorted(tables[control].columns)
    for run, df in tables.items():
        if differing := schema_differences(tables[control], df):
            raise ValueError(f"{label} of {run} has other columns: {sorted(differing)}")
    stacked = reduce(DataFrame.unionByName, [df.select(*columns, F.lit(run).alias("__run")) for run, df in tables.items()])
    counted = stacked.groupBy(*columns).agg(*[F.count_if(F.col("__run") == run).alias(f"__n_{k}") for k, run in enumerate(tables)])
    at = list(tables).index(control)

    def total(c) -> F.Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    sides = []
    for k, run in enumerate(tables):
        if run != control:
            mine, theirs = F.col(f"__n_{k}"), F.col(f"__n_{at}")
            sides.append(F.struct(F.lit(run).alias("run_id"), F.lit(label).alias("table_name"), total(theirs).alias("control_rows"),
                                  total(mine).alias("run_rows"), total(F.greatest(theirs - mine, F.lit(0))).alias("control_only_rows"),
                                  total(F.greatest(mine - theirs, F.lit(0))).alias("run_only_rows")))
    return counted.agg(F.array(*sides).alias("sides")).select(F.inline("sides"))


def output_equality(spark: SparkSession, roots: dict[str, str], control: str, tables=COMPARED_TABLES) -> DataFrame:
    """Per (run, table): rows of the control and the run, rows that only one has, equality."""
    rows = [_compared({run: read_table(spark, root, layer, name) for run, root in roots.items()}, control, f"{layer}/{name}")
            for layer, name in tables]
    out = reduce(DataFrame.unionByName, rows)
    return out.withColumn("equal", (F.col("control_only_rows") == 0) & (F.col("run_only_rows") == 0))


REPORT_MEASURES = ("struct<run_id:string,seconds:map<string,double>,storage:struct<table_bytes:long>,"
                   "tables:map<string,struct<rows:long,parquet_files:long>>>")


def report_measurements(reports: DataFrame) -> DataFrame:
    """(run_id, metric, value): every timed phase, table bytes and Parquet file count."""
    r = reports.select(F.from_json("value", REPORT_MEASURES).alias("r")).select("r.*")
    files = F.aggregate(F.map_values("tables"), F.lit(0).cast("long"),
                        lambda acc, t: acc + F.coalesce(t["parquet_files"], F.lit(0).cast("long")))
    fixed = F.create_map(F.lit("storage.table_bytes"), F.col("storage.table_bytes").cast("double"),
                         F.lit("storage.parquet_files"), files.cast("double"))
    seconds = F.transform_keys("seconds", lambda k, _: F.concat(F.lit("seconds."), k))
    return r.select("run_id", F.explode(F.map_concat(seconds, fixed)).alias("metric", "value"))


def summarize(measurements: DataFrame, sides: DataFrame) -> DataFrame:
    """Per metric: left/right distributions (count, median, min, max, stdev) and the
    right-vs-left % change of medians. ``sides`` maps run_id -> side ('left'/'right')."""
    m = measurements.join(sides, "run_id")
    dist = distribution(m, ["metric", "side"], "value", with_samples=True)
    shown = ("samples", "median", "min", "max", "stdev")
    wide = dist.groupBy("metric").pivot("side", ["left", "right"]).agg(*[F.first(c).alias(c) for c in shown])
    return wide.join(right_vs_left(m, ["metric"], "side", "value").select("metric", "right_vs_left_percent"), "metric")
