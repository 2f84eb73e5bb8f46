"""Data model: sources, layer schemas and the physical options of a run.

Everything a variant changes is data in :class:`Options`; the transforms never
branch on anything else, so a variant can only change *how* Spark computes a
table, never *what* it contains.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# --- Fixed values (must equal the reference for identical results) -------------
# Raw source files and their declared headers, in file order.
SOURCES = {
    "impressions": ("raw_sample.csv", ["user", "time_stamp", "adgroup_id", "pid", "nonclk", "clk"]),
    "ads": ("ad_feature.csv", ["adgroup_id", "cate_id", "campaign_id", "customer", "brand", "price"]),
    "user_profiles": ("user_profile.csv", [
        "userid", "cms_segid", "cms_group_id", "final_gender_code", "age_level",
        "pvalue_level", "shopping_level", "occupation", "new_user_class_level"]),
}
# Reporting days are calendar days in this zone.
REPORTING_ZONE = "Asia/Shanghai"
# Tokens that the numeric cleaner turns into null (after trimming spaces).
NULL_TOKENS = ("", "NULL")
# Physical join operators recognised in executed plans.
JOIN_OPERATORS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin")
# Gold reports and their grouping keys.
GOLD_KEYS = {
    "campaign_daily": ["reporting_date", "campaign_id", "advertiser_id"],
    "audience_daily": ["reporting_date", "advertiser_id", "age_level"],
}
# Effective settings recorded with every run (unset -> null).
RECORDED_SETTINGS = (
    "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
    "spark.sql.autoBroadcastJoinThreshold", "spark.sql.files.maxPartitionBytes",
    "spark.sql.parquet.compression.codec", "spark.sql.ansi.enabled",
    "spark.sql.session.timeZone", "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.sql.execution.pythonUDF.arrow.enabled",
)
# ---------------------------------------------------------------------------------

LAYERS = ("bronze", "silver", "gold")

# Typed impressions schema of the format experiment.
TYPED_IMPRESSIONS = T.StructType([
    T.StructField("user", T.LongType()), T.StructField("time_stamp", T.LongType()),
    T.StructField("adgroup_id", T.LongType()), T.StructField("pid", T.StringType()),
    T.StructField("nonclk", T.IntegerType()), T.StructField("clk", T.IntegerType()),
])


def bronze_schema(name: str, header: list[str] | None = None) -> T.StructType:
    """All-string schema; ``header`` lets the reader match the file's literal names."""
    names = header if header is not None else SOURCES[name][1]
    return T.StructType([T.StructField(c, T.StringType(), True) for c in names])


SILVER = {
    "impressions": T.StructType([
        T.StructField("user_id", T.LongType()), T.StructField("timestamp_seconds", T.LongType()),
        T.StructField("adgroup_id", T.LongType()), T.StructField("placement_id", T.StringType()),
        T.StructField("nonclick", T.IntegerType()), T.StructField("clicked", T.IntegerType()),
        T.StructField("source_file", T.StringType()), T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("reporting_date", T.DateType()),
    ]),
    "ads": T.StructType([
        T.StructField("adgroup_id", T.LongType()), T.StructField("category_id", T.LongType()),
        T.StructField("campaign_id", T.LongType()), T.StructField("advertiser_id", T.LongType()),
        T.StructField("brand_id", T.LongType()), T.StructField("product_price", T.DoubleType()),
        T.StructField("source_file", T.StringType()),
    ]),
    "user_profiles": T.StructType(
        [T.StructField("user_id", T.LongType())]
        + [T.StructField(c, T.IntegerType()) for c in SOURCES["user_profiles"][1][1:]]
        + [T.StructField("source_file", T.StringType())]),
}

# Raw column behind a Silver column of another name.
RAW_NAMES = {
    "impressions": {"user_id": "user", "timestamp_seconds": "time_stamp", "placement_id": "pid",
                    "nonclick": "nonclk", "clicked": "clk"},
    "ads": {"category_id": "cate_id", "advertiser_id": "customer", "brand_id": "brand", "product_price": "price"},
    "user_profiles": {"user_id": "userid"},
}


@dataclass(frozen=True)
class Dimension:
    """A table that impressions are left-joined to: its key, the attributes reports use, the
    Options field that picks its join strategy, and a marker column for matched rows."""

    table: str
    key: str
    attributes: tuple[str, ...]
    strategy: str
    marker: str | None = None


DIMENSIONS = (Dimension("ads", "adgroup_id", ("campaign_id", "advertiser_id"), "ads_join"),
              Dimension("user_profiles", "user_id", ("age_level",), "profile_join", "profile_found"))

GOLD_MEASURES = ["impressions", "clicks", "missing_profile_impressions", "ctr"]

_MEASURE_FIELDS = [T.StructField("impressions", T.LongType()), T.StructField("clicks", T.LongType()),
                   T.StructField("missing_profile_impressions", T.LongType()),
                   T.StructField("ctr", T.DoubleType())]
GOLD = {
    "campaign_daily": T.StructType([T.StructField("reporting_date", T.DateType()),
                                    T.StructField("campaign_id", T.LongType()),
                                    T.StructField("advertiser_id", T.LongType()), *_MEASURE_FIELDS]),
    "audience_daily": T.StructType([T.StructField("reporting_date", T.DateType()),
                                    T.StructField("advertiser_id", T.LongType()),
                                    T.StructField("age_level", T.IntegerType()), *_MEASURE_FIELDS]),
}


def layer_schema(layer: str, name: str) -> T.StructType:
    """Declared schema of a layer table (needed to read schema-less formats such as CSV)."""
    if layer == "bronze":
        return T.StructType(bronze_schema(name).fields + [T.StructField("source_file", T.StringType())])
    return (SILVER if layer == "silver" else GOLD)[name]


JOIN_STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")
DATE_IMPLEMENTATIONS = ("builtin", "python", "arrow")


@dataclass(frozen=True)
class Options:
    """Physical knobs of a run (results must not depend on any of them).

    fmt                 table format (L1): parquet | csv | delta (only if its jar is present)
    codec               writer compression (L2): snappy | zstd | uncompressed | ...
    partition_by        partition columns of silver impressions (L3)
    cluster_by          columns whose ranges silver impressions are sorted by within files, instead of
                        a folder per value (L3)
    ads_join            join strategy for the ads dimension (L4)
    profile_join        join strategy for the profile dimension (L5)
    shuffle_partitions  initial shuffle partitions (L6): a number, None (keep the session
                        value) or "auto" (for the Gold phase: ~256 MiB of the fact per
                        partition if a join shuffles it, else the session value)
    row_group_bytes     Parquet row-group size of written tables
    cache               persist the shared enrichment for both reports (L7)
    coalesce            AQE post-shuffle coalescing (L8)
    date_impl           reporting date: builtin | python (row UDF) | arrow UDF (L9)
    shared_rollup       build both reports from one rollup of the enrichment, so that the fact is
                        scanned and joined once, instead of once per report
    fingerprint_sources record a row-multiset fingerprint of every source in the run
                        report (one extra pass over Bronze, folded into the row counts)
    broadcast_limit     a dimension is broadcast on request only when Spark's size
                        estimate of its projected side is at most this many bytes
    zone                reporting time zone
    """

    fmt: str = "parquet"
    codec: str = "snappy"
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    ads_join: str = "auto"
    profile_join: str = "auto"
    shuffle_partitions: int | str | None = "auto"
    row_group_bytes: int = 128 * 1024 * 1024
    cache: bool = False
    coalesce: bool = True
    date_impl: str = "builtin"
    shared_rollup: bool = False
    fingerprint_sources: bool = True
    broadcast_limit: int = 256 * 1024 * 1024
    zone: str = REPORTING_ZONE
    extra_conf: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.ads_join not in JOIN_STRATEGIES or self.profile_join not in JOIN_STRATEGIES:
            raise ValueError(f"join strategy must be one of {JOIN_STRATEGIES}")
        if self.date_impl not in DATE_IMPLEMENTATIONS:
            raise ValueError(f"date_impl must be one of {DATE_IMPLEMENTATIONS}")
        if not (self.shuffle_partitions is None or self.shuffle_partitions == "auto"
                or (isinstance(self.shuffle_partitions, int) and self.shuffle_partitions > 0)):
            raise ValueError("shuffle_partitions must be a positive int, 'auto' or None")

    def with_(self, **changes) -> "Options":
        return replace(self, **changes)

    def session_conf(self) -> dict[str, str]:
        """SQL settings this run needs while its queries are planned and executed."""
        conf = {"spark.sql.adaptive.coalescePartitions.enabled": str(self.coalesce).lower(),
                "spark.sql.parquet.compression.codec": self.codec}
        if isinstance(self.shuffle_partitions, int):
            conf["spark.sql.shuffle.partitions"] = str(self.shuffle_partitions)
        conf.update({k: str(v) for k, v in self.extra_conf.items()})
        return conf
