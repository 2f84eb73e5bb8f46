"""Silver typing, enrichment and the Gold reports.

What a table holds is data in :mod:`adlake.model` (layer schemas, raw names, dimensions);
here are the builders that turn that into one projection, a chain of left joins and grouped
sums. Pure ``DataFrame -> DataFrame`` functions; no actions.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from adlake.functions.columns import event_timestamp, missing_flag, numeric
from adlake.functions.dates import reporting_date_column
from adlake.model import DIMENSIONS, GOLD_KEYS, RAW_NAMES, SILVER, Dimension, Options
from adlake.operators.joins import dimension_side

#: Silver columns that come from other Silver columns instead of a raw one.
DERIVED = {
    "event_timestamp": lambda opts: event_timestamp("timestamp_seconds"),
    "reporting_date": lambda opts: reporting_date_column("timestamp_seconds", opts.date_impl, opts.zone),
}
#: What one impression adds to each report measure.
PER_IMPRESSION = {"impressions": "1", "clicks": "clicked", "missing_profile_impressions": "missing_profile"}


def _typed(field: T.StructField, raw: str) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.col(raw).alias(field.name)
    return numeric(raw, field.dataType.simpleString(), field.name)


def silver_table(name: str, bronze: DataFrame, opts: Options | None = None) -> DataFrame:
    """A source's Silver table. Text stays as it was read, everything else is parsed
    strictly to the type that the layer schema declares."""
    if name not in SILVER:
        raise ValueError(f"no Silver table {name!r}")
    fields = {f.name: f for f in SILVER[name].fields}
    read = [_typed(f, RAW_NAMES[name].get(c, c)) for c, f in fields.items() if c not in DERIVED]
    made = {c: build(opts or Options()) for c, build in DERIVED.items() if c in fields}
    return bronze.select(*read).withColumns(made).select(*fields)


def silver_views(bronze: dict[str, DataFrame], opts: Options | None = None) -> dict[str, DataFrame]:
    return {name: silver_table(name, df, opts) for name, df in bronze.items()}


def enrich(tables: dict[str, DataFrame], opts: Options | None = None) -> DataFrame:
    """Every impression with the attributes of its ad and profile, if it has them.

    Only a dimension's key and attributes reach its join; its keys must be unique (a quality
    check), or impressions would multiply."""
    opts = opts or Options()

    def attach(fact: DataFrame, dim: Dimension) -> DataFrame:
        side = tables[dim.table].select(dim.key, *dim.attributes)
        if dim.marker:
            side = side.withColumn(dim.marker, F.lit(True))
        return fact.join(dimension_side(side, getattr(opts, dim.strategy), opts.broadcast_limit), dim.key, "left")

    return reduce(attach, DIMENSIONS, tables["impressions"]).withColumn("missing_profile", missing_flag("profile_found"))


def _report(df: DataFrame, keys, sums: dict[str, str]) -> DataFrame:
    """Sums per key and their ratio. Sums are partial before the shuffle, so a hot key costs
    one row per map task; a null key is a group like any other."""
    totals = [F.expr(f"sum({amount})").cast("long").alias(measure) for measure, amount in sums.items()]
    return df.groupBy(*keys).agg(*totals)


def _with_ctr(report: DataFrame) -> DataFrame:
    return report.withColumn("ctr", F.col("clicks") / F.col("impressions"))


def daily_report(enriched: DataFrame, keys: list[str]) -> DataFrame:
    """Measures and click-through rate per key."""
    return _with_ctr(_report(enriched, keys, PER_IMPRESSION))


def campaign_daily(enriched: DataFrame) -> DataFrame:
    return daily_report(enriched, GOLD_KEYS["campaign_daily"])


def audience_daily(enriched: DataFrame) -> DataFrame:
    return daily_report(enriched, GOLD_KEYS["audience_daily"])


def gold_rollup(enriched: DataFrame) -> DataFrame:
    """Measures per combination of all reports' keys. Sums of sums are exact, so every report
    comes from this much smaller table."""
    return _report(enriched, sorted(set().union(*GOLD_KEYS.values())), PER_IMPRESSION)


def report_from_rollup(rollup: DataFrame, keys: list[str]) -> DataFrame:
    return _with_ctr(_report(rollup, keys, {m: m for m in PER_IMPRESSION}))


def overall_ctr(report: DataFrame) -> DataFrame:
    """P10: total clicks over total impressions, never an average of ratios."""
    return _with_ctr(_report(report, [], {m: m for m in ("impressions", "clicks")}))
