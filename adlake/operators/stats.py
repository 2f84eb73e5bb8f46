"""Distributions, comparisons and settings diffs.

Sums, counts and extremes are grouped aggregations. Exact medians and nearest-rank
percentiles are picked from values counted and dealt by ranges (``ranking.values_at``), so
a group of any number of distinct values is spread over many tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlake.operators.ranking import values_at
from adlake.session import settings as effective_settings

#: Places of the two middle values (equal ones of an odd count) and of the nearest-rank 95 %.
MIDDLE = {"__low": (1, 1, 2), "__high": (1, 2, 2)}
NEAREST_95 = {"p95": (95, 99, 100)}


def _middle() -> Column:
    return ((F.col("__low").cast("double") + F.col("__high").cast("double")) / 2).alias("median")


def _beside(groups: DataFrame, by: list[str], picked: DataFrame) -> DataFrame:
    """Each group's aggregates with its picked values, null where it has none."""
    if not by:
        return groups.join(F.broadcast(picked), F.lit(True), "left")  # one row beside one row
    other = picked.select(*[F.col(c).alias(f"__p_{i}") for i, c in enumerate(by)], *[c for c in picked.columns if c not in by])
    same = [F.col(c).eqNullSafe(F.col(f"__p_{i}")) for i, c in enumerate(by)]
    return groups.join(other, same, "left")


def distribution(df: DataFrame, by: list[str], value: str, *, with_samples: bool = False) -> DataFrame:
    """Count, median, min, max and sample stdev (null for a single sample) of
    ``value`` per group; with ``with_samples`` also the samples themselves (sorted,
    comma-joined), which gathers each group's values and is meant only for groups of
    bounded size (runs of an experiment, days of a period)."""
    v = F.col(value)
    aggs = [F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_samp(v).alias("stdev")]
    out = ["n", _middle(), "min", "max", "stdev"]
    if with_samples:
        aggs.append(F.array_join(F.array_sort(F.collect_list(v)).cast("array<string>"), ",").alias("samples"))
        out.insert(0, "samples")
    return _beside(df.groupBy(*by).agg(*aggs), by, values_at(df, by, value, MIDDLE)).select(*by, *out)


def size_distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, total, min, median, nearest-rank p95 and max per group."""
    v = F.col(value)
    groups = df.groupBy(*by).agg(F.count(v).alias("count"), F.sum(v).alias("total"), F.min(v).alias("min"), F.max(v).alias("max"))
    picked = values_at(df, by, value, {**MIDDLE, **NEAREST_95})
    return _beside(groups, by, picked).select(*by, "count", "total", "min", _middle(), "p95", "max")


def right_vs_left(df: DataFrame, by: list[str], side: str, value: str) -> DataFrame:
    """Medians of the 'left' and 'right' samples and the right-vs-left % change of
    the medians (null when the left median is 0 or a side has no sample)."""
    sides = df.filter(F.col(side).isin("left", "right"))
    medians = values_at(sides, [*by, side], value, MIDDLE).select(*by, F.col(side).alias("__side"), _middle())
    one = [F.max(F.when(F.col("__side") == s, F.col("median"))).alias(f"{s}_median") for s in ("left", "right")]
    out = _beside(df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")), by, medians.groupBy(*by).agg(*one)).drop("__n")
    out = out.select(*by, "left_median", "right_median")
    return out.withColumn("right_vs_left_percent", F.when(
        F.col("left_median") != 0,
        (F.col("right_median") - F.col("left_median")) / F.col("left_median") * 100))


def settings_frame(spark: SparkSession, keys) -> DataFrame:
    """M4: one (key, value) row per setting; unset keys have a null value."""
    return spark.createDataFrame(sorted(effective_settings(spark, keys).items()), "key string, value string")


def settings_diff(reference: DataFrame, current: DataFrame, declared: tuple[str, ...] = ()) -> DataFrame:
    """Keys whose values differ (null-safe) between two (key, value) tables,
    with whether the difference was declared."""
    r = reference.select("key", F.col("value").alias("reference_value"))
    c = current.select("key", F.col("value").alias("current_value"))
    diff = r.join(c, "key", "full_outer").filter(~F.col("reference_value").eqNullSafe(F.col("current_value")))
    return diff.withColumn("declared", F.col("key").isin(*declared) if declared else F.lit(False))


def undeclared(diff: DataFrame) -> list[str]:
    """Keys that differ without being declared (collects only the differing keys)."""
    return sorted(r["key"] for r in diff.filter(~F.col("declared")).select("key").collect())


REPORT_SCHEMA = ("struct<run_id:string,status:string,sources:map<string,struct<rows:long,row_hash_sum:string>>,"
                 "tables:map<string,struct<rows:long>>,environment:struct<spark:string,python:string,java:string,"
                 "master:string,driver_memory:string,spark_sql_settings:map<string,string>>>")
#: Parts of the environment that two comparable runs share.
FIXED_ENVIRONMENT = ("spark", "python", "java", "master", "driver_memory")


def report_rows(reports: DataFrame) -> DataFrame:
    """Q9 input: run reports (one JSON text row each, column ``value``) flattened to
    (run_id, key, value): status, rows and content sum of each source, the table set, the
    fixed environment and every recorded SQL setting."""
    r = reports.select(F.from_json("value", REPORT_SCHEMA).alias("r")).select("r.*")
    r = r.withColumn("conf", F.col("environment.spark_sql_settings"))
    fixed = {"status": F.col("status"), "tables": F.array_join(F.array_sort(F.map_keys("tables")), ","),
             **{f"environment.{k}": F.col(f"environment.{k}") for k in FIXED_ENVIRONMENT}}
    single = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in fixed.items()])

    def entries(column: str, prefix: str, suffix: str, value) -> F.Column:
        found = F.transform(F.map_entries(column), lambda e: F.struct(
            F.concat(F.lit(prefix), e["key"], F.lit(suffix)).alias("key"), value(e["value"]).cast("string").alias("value")))
        return F.coalesce(found, F.array().cast("array<struct<key:string,value:string>>"))

    every = F.concat(single, entries("sources", "sources.", ".rows", lambda v: v["rows"]),
                     entries("sources", "sources.", ".hash", lambda v: v["row_hash_sum"]), entries("conf", "settings.", "", lambda v: v))
    return r.select("run_id", F.inline(every))


def comparability(reference: DataFrame, current: DataFrame, declared: tuple[str, ...] = ()) -> DataFrame:
    """Q9: differences between two runs' report rows. Only declared settings may differ;
    both runs must have succeeded. ``allowed`` marks acceptable rows."""
    diff = settings_diff(reference, current, tuple(f"settings.{k}" for k in declared))
    failed = (reference.unionByName(current).filter((F.col("key") == "status") & (F.col("value") != "succeeded"))
              .select("key", F.lit(None).cast("string").alias("reference_value"),
                      F.col("value").alias("current_value"), F.lit(False).alias("declared")))
    return diff.unionByName(failed).withColumn("allowed", F.col("declared"))


def validate_comparable(reference: DataFrame, current: DataFrame, declared: tuple[str, ...] = ()) -> dict:
    rows = comparability(reference, current, declared).collect()
    bad = sorted({r["key"] for r in rows if not r["allowed"]})
    if bad:
        raise ValueError(f"Runs are not comparable: {bad}")
    return {r["key"]: (r["reference_value"], r["current_value"]) for r in rows}
