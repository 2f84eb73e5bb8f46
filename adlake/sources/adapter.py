"""Derive the three raw advertising sources from the driver's tables.

Output is *Bronze form*: every column a string, with literal ``'NULL'``, blanks
and padded numbers, so the cleaning step is really exercised. Every mapping is a
row-wise projection (or one equi-join for the lineitem fact); no row is dropped.

Mapping (all deterministic):

impressions <- events
    user=user_id, time_stamp=epoch seconds of ts (UTC wall clock), adgroup_id=props.k,
    pid=event_type, clk=(event_type='click'), nonclk=1-clk
ads <- part
    adgroup_id=p_partkey, cate_id=campaign_id=p_size, customer=digits of p_brand,
    brand=same digits or 'NULL' when p_partkey%7=0, price=p_retailprice
user_profiles <- customer
    userid=c_custkey, or -c_custkey-1 for customers in debit: a profile that no event refers
    to, so that their impressions have none; age_level=c_nationkey%7, other codes from segment/nation/balance
bench impressions <- lineitem join orders
    user=o_custkey, time_stamp=l_shipdate, adgroup_id=l_partkey, pid=l_returnflag,
    clk=(l_linestatus='F')
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.functions.columns import epoch_seconds
from adlake.model import SOURCES


#: Column by which a source table's rows are dealt anew; a value that is too frequent for one task is split.
DEALT_BY = {"events": "event_id", "part": "p_partkey", "customer": "c_custkey"}


def table(spark: SparkSession, sf_dir: str, name: str, dealt: bool = False) -> DataFrame:
    """A source table. A task reads whole row groups, so one that came in a single row group is read, parsed and
    written by one task, and so are all tables made from it; ``dealt`` deals the rows over tasks right after the scan."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return rows.hint("rebalance", F.col(DEALT_BY[name])) if dealt else rows


def _s(col) -> F.Column:
    return col.cast("string")


def _flag(cond) -> F.Column:
    return F.when(cond, F.lit("1")).otherwise(F.lit("0"))


def _unflag(cond) -> F.Column:
    return F.when(cond, F.lit("0")).otherwise(F.lit("1"))


def impressions_from_events(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    e = table(spark, sf_dir, "events", dealt)
    click = F.col("event_type") == "click"
    return e.select(
        _s(F.col("user_id")).alias("user"),
        _s(epoch_seconds("ts")).alias("time_stamp"),
        F.get_json_object("props", "$.k").alias("adgroup_id"),
        F.col("event_type").alias("pid"),
        _unflag(click).alias("nonclk"),
        _flag(click).alias("clk"),
    ).withColumn("source_file", F.lit(SOURCES["impressions"][0]))


def ads_from_part(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    p = table(spark, sf_dir, "part", dealt)
    digits = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit(""))
    return p.select(
        _s(F.col("p_partkey")).alias("adgroup_id"),
        _s(F.col("p_size")).alias("cate_id"),
        _s(F.col("p_size")).alias("campaign_id"),
        digits.alias("customer"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("NULL")).otherwise(digits).alias("brand"),
        _s(F.col("p_retailprice")).alias("price"),
    ).withColumn("source_file", F.lit(SOURCES["ads"][0]))


def profiles_from_customer(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    c = table(spark, sf_dir, "customer", dealt)
    in_debit = F.col("c_acctbal") < 0
    seg = F.col("c_mktsegment")
    nation = F.col("c_nationkey")
    return c.select(
        _s(F.when(in_debit, -F.col("c_custkey") - 1).otherwise(F.col("c_custkey"))).alias("userid"),
        _s(nation % 5).alias("cms_segid"),
        _s(nation % 13).alias("cms_group_id"),
        F.when(seg.isin("AUTOMOBILE", "BUILDING", "MACHINERY"), F.lit("1")).otherwise(F.lit("2"))
        .alias("final_gender_code"),
        _s(nation % 7).alias("age_level"),
        F.when(F.col("c_acctbal") < 1000, F.lit("")).when(F.col("c_acctbal") < 5000, F.lit("1"))
        .otherwise(F.lit("2")).alias("pvalue_level"),
        F.when(seg == "HOUSEHOLD", F.lit(" 3 ")).otherwise(F.lit("1")).alias("shopping_level"),
        _s(F.col("c_custkey") % 2).alias("occupation"),
        F.when(seg == "FURNITURE", F.lit("NULL")).otherwise(_s(nation % 4 + 1))
        .alias("new_user_class_level"),
    ).withColumn("source_file", F.lit(SOURCES["user_profiles"][0]))


def bronze_views(spark: SparkSession, sf_dir: str, dealt: bool = False) -> dict[str, DataFrame]:
    """The three Bronze sources (strings + provenance) derived from ``sf_dir``; ``dealt``: see ``table``."""
    return {
        "impressions": impressions_from_events(spark, sf_dir, dealt),
        "ads": ads_from_part(spark, sf_dir, dealt),
        "user_profiles": profiles_from_customer(spark, sf_dir, dealt),
    }


def lineitem_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bench-scale Bronze impressions: one impression per lineitem."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    click = F.col("l_linestatus") == "F"
    return (li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
            .select(_s(F.col("o_custkey")).alias("user"),
                    _s(epoch_seconds("l_shipdate")).alias("time_stamp"),
                    _s(F.col("l_partkey")).alias("adgroup_id"),
                    F.col("l_returnflag").alias("pid"),
                    _unflag(click).alias("nonclk"),
                    _flag(click).alias("clk"))
            .withColumn("source_file", F.lit(SOURCES["impressions"][0])))


def bench_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    views = bronze_views(spark, sf_dir)
    views["impressions"] = lineitem_impressions(spark, sf_dir)
    return views


def dirty_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bronze sources with deterministic injected faults, for the quality checks.

    impressions: clk='2' when event_id%97=0, user null when event_id%101=0,
    adgroup_id+1,000,000 (no such ad) when event_id%89=0.
    ads: every ad with p_size=1 appears twice; campaign 'NULL' when p_size=2.
    user_profiles: unchanged.
    """
    e = table(spark, sf_dir, "events")
    click = F.col("event_type") == "click"
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    imp = e.select(
        F.when(eid % 101 == 0, F.lit(None).cast("string")).otherwise(_s(F.col("user_id"))).alias("user"),
        _s(epoch_seconds("ts")).alias("time_stamp"),
        F.when(eid % 89 == 0, _s(k.cast("long") + 1000000)).otherwise(k).alias("adgroup_id"),
        F.col("event_type").alias("pid"),
        _unflag(click).alias("nonclk"),
        F.when(eid % 97 == 0, F.lit("2")).otherwise(_flag(click)).alias("clk"),
    ).withColumn("source_file", F.lit(SOURCES["impressions"][0]))
    ads = ads_from_part(spark, sf_dir)
    ads = ads.withColumn("campaign_id", F.when(F.col("cate_id") == "2", F.lit("NULL"))
                         .otherwise(F.col("campaign_id")))
    ads = ads.unionByName(ads.filter(F.col("cate_id") == "1"))
    return {"impressions": imp, "ads": ads, "user_profiles": profiles_from_customer(spark, sf_dir)}
