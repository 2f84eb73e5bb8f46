"""A hot key holding a third of the fact: shuffle joins split it (AQE skew join) and
results stay exactly equal to the broadcast plan."""
from __future__ import annotations

from pyspark.sql import functions as F

from adlake.model import Options
from adlake.operators import quality as qc
from adlake.operators import transforms as tx
from adlake.operators.equality import compare
from adlake.plans.inspect import plan_text
from adlake.session import conf_scope
from adlake.sources.adapter import bronze_views
from conftest import SF_ORACLE

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
}


def skewed_silver(spark):
    """Events with every third impression re-assigned to user 7 (a third of all rows)."""
    bronze = bronze_views(spark, SF_ORACLE)
    hot = F.pmod(F.xxhash64("time_stamp", "adgroup_id", "pid"), F.lit(3)) == 0  # deterministic third
    bronze["impressions"] = bronze["impressions"].withColumn(
        "user", F.when(hot, F.lit("7")).otherwise(F.col("user")))
    return tx.silver_views(bronze)


def test_hot_user_is_a_third_of_rows(spark):
    s = skewed_silver(spark)["impressions"]
    top = s.groupBy("user_id").count().orderBy(F.desc("count")).first()
    assert top.user_id == 7 and top["count"] > s.count() / 4


def test_skewed_shuffle_join_split_and_exact(spark):
    s = skewed_silver(spark)
    control = tx.audience_daily(tx.enrich(s))
    expected = {tuple(r) for r in control.collect()}
    with conf_scope(spark, SKEW_CONF):
        e = tx.enrich(s, Options(profile_join="merge"))
        report = tx.audience_daily(e)
        rows = report.collect()
        text = plan_text(report)
    assert "isFinalPlan=true" in text and "SortMergeJoin" in text
    assert "skew=true" in text  # AQE split the hot user's partition
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)


def test_hot_key_is_aggregated_before_the_checks_join(spark):
    """Every join of the checks is fed by aggregates of the fact's keys: one row per key, however
    hot, and one row per key and map task in the shuffle before."""
    s = skewed_silver(spark)
    with conf_scope(spark, SKEW_CONF):
        for frame in (qc.fact_checks(*s.values()), qc.fact_totals(s["impressions"], s["user_profiles"]), qc.key_checks(*s.values())):
            lines = plan_text(frame).split("== Initial Plan ==")[-1].splitlines()
            joins = [k for k, line in enumerate(lines) if "SortMergeJoin" in line]
            assert joins
            for k in joins:  # below the join: sort, final aggregate, exchange, partial aggregate
                below = [line.strip(" :+-|") for line in lines[k + 1:k + 8]]
                names = [line.split("(")[0].split(" ")[0] for line in below]
                assert names[:2] == ["Sort", "HashAggregate"] and "partial_count" in "".join(below) and "Exchange" in names


def test_skewed_fact_checks_and_diff(spark):
    s = skewed_silver(spark)
    with conf_scope(spark, SKEW_CONF):
        checks = qc.fact_checks(s["impressions"], s["ads"], s["user_profiles"]).first()
        same = compare(s["impressions"].drop("event_timestamp"), s["impressions"].drop("event_timestamp"))
    lacking = s["impressions"].join(s["user_profiles"].select("user_id"), "user_id", "left_anti").count()
    assert checks.invalid_rows == 0 and checks.impressions == s["impressions"].count()
    assert checks.missing_profile_impressions == lacking and checks.unmatched_ad_impressions == 0
    assert same.equal


def test_anti_join_splits_a_hot_unmatched_key(spark, tmp_path):
    """A skewed partition is divided by the map tasks that filled it. The test table is one
    split, hence one map task, so its rows are written to several files first."""
    s = skewed_silver(spark)
    s["impressions"].repartition(8).write.parquet(str(tmp_path / "fact"))
    with conf_scope(spark, SKEW_CONF):
        found = qc.unmatched(spark.read.parquet(str(tmp_path / "fact")), s["user_profiles"], "user_id")
        found.collect()
        text = plan_text(found)
    assert "skew=true" in text
