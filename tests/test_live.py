"""Evidence of what ran, taken in the session that ran it."""
from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from adlake.operators.live import (GroupTasks, PlanEvidence, check_group_tasks, check_plan, final_plan, group_tasks, plan_evidence,
                                   totals)
from adlake.plans.pipeline import job_group
from adlake.session import conf_scope


def run(spark, work):
    name = f"test-{uuid.uuid4().hex}"
    with job_group(spark, name):
        work()
    return group_tasks(spark, name)


def test_tasks_of_a_group(spark):
    conf = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with conf_scope(spark, conf):
        found = run(spark, lambda: spark.range(0, 1000, 1, 5).groupBy((F.col("id") % 7).alias("k")).count().collect())
    assert sorted(found.tasks_by_stage) == [5, 13] and found.completed_tasks == 18 and found.failed_tasks == 0
    assert check_group_tasks(found) is found


def test_a_stage_that_did_not_run_again_is_not_counted(spark):
    frame = spark.range(0, 100, 1, 3).rdd.map(lambda r: (r[0] % 2, 1)).reduceByKey(lambda a, b: a + b, 4)
    first, second = run(spark, frame.collect), run(spark, frame.collect)
    assert first.completed_tasks == 7 and second.completed_tasks == 4
    check_group_tasks(second)


def test_failures_and_silence_are_told(spark):
    @F.udf("int")
    def broken(_):
        raise RuntimeError("broken")

    def work():
        with pytest.raises(Exception, match="broken"):
            spark.range(3).select(broken("id")).collect()

    found = run(spark, work)
    assert found.failed_jobs == 1 and found.failed_tasks >= 1
    with pytest.raises(ValueError, match="soundly"):
        check_group_tasks(found)
    with pytest.raises(ValueError, match="nothing ran"):
        check_group_tasks(group_tasks(spark, "no-such-group", wait=0.1))
    with pytest.raises(ValueError, match="soundly"):
        check_group_tasks(GroupTasks("g", 1, 0, [4], 3, 0))


def frames(spark):
    fact = spark.range(0, 5000, 1, 4).select((F.col("id") % 50).alias("user_id"), F.lit(1).alias("impressions"))
    return fact, spark.range(60).select(F.col("id").alias("user_id"), (F.col("id") % 3).alias("g"))


@pytest.mark.parametrize("hint,operator", [("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")])
def test_plan_of_each_join(spark, hint, operator):
    fact, dim = frames(spark)
    with conf_scope(spark, {"spark.sql.shuffle.partitions": "21"}):
        out = totals(fact.join(dim.hint(hint), "user_id", "left").groupBy("g").agg(F.sum("impressions").alias("impressions")))
        with pytest.raises(ValueError, match="no action"):
            final_plan(out)
        assert tuple(out.collect()[0]) == (3, 5000)
    seen = plan_evidence(out)
    assert seen == PlanEvidence({"user_id": operator}, [21], True, 0, None)
    assert check_plan(seen, {"joins": {"user_id": operator}, "initial_partitions": [21], "cache_scans": 0}) is seen
    for wrong in ({"joins": {"user_id": "NestedLoop"}}, {"joins": {"other": operator}}, {"initial_partitions": [8]}, {"coalesced": False},
                  {"cache_scans": 1}, {"python_node": "BatchEvalPython"}):
        with pytest.raises(ValueError, match="shows otherwise"):
            check_plan(seen, wrong)


def test_the_plan_it_began_with_is_left_out(spark):
    """A join that adaptive execution turned into a broadcast counts as what it became."""
    fact, dim = frames(spark)
    with conf_scope(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"}):
        out = totals(fact.join(dim, "user_id", "left").groupBy("g").agg(F.sum("impressions").alias("impressions")))
        out.collect()
    assert plan_evidence(out).joins == {"user_id": "BroadcastHashJoin"}


def test_cache_and_python_nodes(spark):
    fact, dim = frames(spark)
    cached = fact.join(dim, "user_id").cache()
    try:
        out = totals(cached.groupBy("g").agg(F.sum("impressions").alias("impressions")))
        out.collect()
        assert plan_evidence(out).cache_scans == 1
    finally:
        cached.unpersist(blocking=True)
    plus = F.udf(lambda v: v + 1, "long")
    out = totals(fact.select(plus("user_id").alias("k"), "impressions").groupBy("k").agg(F.sum("impressions").alias("impressions")))
    out.collect()
    assert plan_evidence(out).python_node == "BatchEvalPython" and plan_evidence(out).cache_scans == 0


def test_presets_share_what_they_broadcast(spark, tmp_path):
    """Presets of the same settings are branches of one execution, in which each dimension reaches the driver once."""
    from adlake.operators.live import branches, evidence_of
    from adlake.plans import catalog
    fact, dim = frames(spark)
    report = lambda how, amount: totals(fact.join(dim.hint(how), "user_id", "left").groupBy("g").agg(F.sum(amount).alias("impressions")))
    out = report("broadcast", "impressions").union(report("merge", "impressions")).union(report("broadcast", F.col("impressions") + 1))
    assert [tuple(r) for r in out.collect()] == [(3, 5000), (3, 5000), (3, 10000)]
    text = final_plan(out)
    assert [evidence_of(part).joins["user_id"] for part in branches(text)] == ["BroadcastHashJoin", "SortMergeJoin", "BroadcastHashJoin"]
    assert text.count("ReusedExchange") == 1 and "ReusedExchange" in branches(text)[2]
    with pytest.raises(ValueError, match="no union"):
        branches("HashAggregate")

    n = F.col("id")
    rows = spark.range(300).coalesce(1)
    rows.select(n.alias("event_id"), F.timestamp_seconds(n).alias("ts"), (n % 40).alias("user_id"), F.lit("click").alias("event_type"),
                F.concat(F.lit('{"k": '), n % 30, F.lit("}")).alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    rows.select(n.alias("p_partkey"), F.lit(1).alias("p_size"), F.lit("Brand#1").alias("p_brand"), n.alias("p_retailprice")).write.parquet(f"{tmp_path}/part.parquet")
    rows.select(n.alias("c_custkey"), F.lit(1.0).alias("c_acctbal"), F.lit("HOUSEHOLD").alias("c_mktsegment"), F.lit(3).alias("c_nationkey")).write.parquet(
        f"{tmp_path}/customer.parquet")
    group = ("control", "ads_merge", "arrow_udf", "shared_rollup")
    assert set(group) <= set(catalog._evidence_together()[0])
    found = catalog._evidence_of_presets(spark, str(tmp_path), group)
    assert {(p, r, s.joins["adgroup_id"], row["impressions"]) for p, r, s, row in found} == {
        (p, r, "SortMergeJoin" if p == "ads_merge" else "BroadcastHashJoin", 300) for p in group for r in ("campaign_daily", "audience_daily")}
