"""DuckDB oracle SQL for every registered query.

Each statement re-derives the adapter mapping in plain SQL over the driver's
tables, so Spark and DuckDB compute the same thing independently. The reporting
day is ``ts + 8 hours`` (Asia/Shanghai has had no DST since 1991, and all test
data is later), which avoids needing DuckDB's ICU extension.
"""
from __future__ import annotations

# --- shared CTEs -------------------------------------------------------------------
IMP = """imp AS (
  SELECT user_id,
         epoch_us(ts) // 1000000 AS timestamp_seconds,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS adgroup_id,
         event_type AS placement_id,
         CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS nonclick,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicked,
         'raw_sample.csv' AS source_file,
         CAST(ts + INTERVAL 8 HOUR AS DATE) AS reporting_date
  FROM events)"""

ADS = """ads AS (
  SELECT p_partkey AS adgroup_id,
         CAST(p_size AS BIGINT) AS category_id,
         CAST(p_size AS BIGINT) AS campaign_id,
         CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS advertiser_id,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(replace(p_brand, 'Brand#', '') AS BIGINT) END AS brand_id,
         p_retailprice AS product_price,
         'ad_feature.csv' AS source_file
  FROM part)"""

USERS = """users AS (
  SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey - 1 ELSE c_custkey END AS user_id,
         CAST(c_nationkey % 5 AS INTEGER) AS cms_segid,
         CAST(c_nationkey % 13 AS INTEGER) AS cms_group_id,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN 1 ELSE 2 END AS final_gender_code,
         CAST(c_nationkey % 7 AS INTEGER) AS age_level,
         CASE WHEN c_acctbal < 1000 THEN NULL WHEN c_acctbal < 5000 THEN 1 ELSE 2 END AS pvalue_level,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 3 ELSE 1 END AS shopping_level,
         CAST(c_custkey % 2 AS INTEGER) AS occupation,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE CAST(c_nationkey % 4 + 1 AS INTEGER) END AS new_user_class_level,
         'user_profile.csv' AS source_file
  FROM customer)"""

ENRICHED = """enriched AS (
  SELECT i.*, a.campaign_id, a.advertiser_id, u.age_level,
         CASE WHEN u.user_id IS NULL THEN NULL ELSE TRUE END AS profile_found,
         CAST(CASE WHEN u.user_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS missing_profile
  FROM imp i
  LEFT JOIN ads a ON a.adgroup_id = i.adgroup_id
  LEFT JOIN users u ON u.user_id = i.user_id)"""

MEASURES = """count(*)::BIGINT AS impressions,
       sum(clicked)::BIGINT AS clicks,
       sum(missing_profile)::BIGINT AS missing_profile_impressions,
       sum(clicked)::DOUBLE / count(*) AS ctr"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CAMPAIGN_DAILY = _with(IMP, ADS, USERS, ENRICHED) + f"""
SELECT reporting_date, campaign_id, advertiser_id,
       {MEASURES}
FROM enriched GROUP BY reporting_date, campaign_id, advertiser_id"""

AUDIENCE_DAILY = _with(IMP, ADS, USERS, ENRICHED) + f"""
SELECT reporting_date, advertiser_id, age_level,
       {MEASURES}
FROM enriched GROUP BY reporting_date, advertiser_id, age_level"""

ORACLE: dict[str, str] = {
    "campaign_daily": CAMPAIGN_DAILY,
    "audience_daily": AUDIENCE_DAILY,
}

# --- P1 -----------------------------------------------------------------------------
IMP_COLS = ("user_id, timestamp_seconds, adgroup_id, placement_id, nonclick, clicked, "
            "source_file, reporting_date")

ORACLE["silver_impressions"] = _with(IMP) + "SELECT *, timestamp_seconds AS event_epoch FROM imp"
ORACLE["silver_ads"] = _with(ADS) + "SELECT * FROM ads"
ORACLE["silver_user_profiles"] = _with(USERS) + "SELECT * FROM users"
ORACLE["enriched"] = _with(IMP, ADS, USERS, ENRICHED) + "SELECT * FROM enriched"
ORACLE["overall_ctr"] = _with(IMP) + """
SELECT count(*)::BIGINT AS impressions, sum(clicked)::BIGINT AS clicks,
       sum(clicked)::DOUBLE / count(*) AS ctr
FROM imp"""
ORACLE["bronze_csv_roundtrip"] = CAMPAIGN_DAILY
ORACLE["profiles_csv_roundtrip"] = ORACLE["silver_user_profiles"]

# --- P2: fault-injected sources ------------------------------------------------------
DIRTY_IMP = """dimp AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id,
         epoch_us(ts) // 1000000 AS timestamp_seconds,
         CASE WHEN event_id % 89 = 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) + 1000000
              ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS adgroup_id,
         event_type AS placement_id,
         CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS nonclick,
         CASE WHEN event_id % 97 = 0 THEN 2 WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicked,
         'raw_sample.csv' AS source_file,
         CAST(ts + INTERVAL 8 HOUR AS DATE) AS reporting_date
  FROM events)"""

DIRTY_ADS = """dads_once AS (
  SELECT p_partkey AS adgroup_id, p_size,
         CASE WHEN p_size = 2 THEN NULL ELSE CAST(p_size AS BIGINT) END AS campaign_id,
         CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS advertiser_id
  FROM part),
dads AS (SELECT * FROM dads_once UNION ALL SELECT * FROM dads_once WHERE p_size = 1)"""

ORACLE["check_dimension_keys"] = _with(DIRTY_ADS, USERS) + """,
ak AS (SELECT adgroup_id, count(*) AS n,
              count(*) FILTER (WHERE campaign_id IS NULL OR advertiser_id IS NULL) AS missing
       FROM dads GROUP BY adgroup_id),
uk AS (SELECT user_id, count(*) AS n FROM users GROUP BY user_id)
SELECT 'ads' AS dimension, sum(n)::BIGINT AS row_count,
       coalesce(sum(CASE WHEN adgroup_id IS NULL THEN n END), 0)::BIGINT AS null_keys,
       count(*) FILTER (WHERE adgroup_id IS NOT NULL AND n > 1)::BIGINT AS duplicate_keys,
       sum(missing)::BIGINT AS missing_required
FROM ak
UNION ALL
SELECT 'user_profiles', sum(n)::BIGINT,
       coalesce(sum(CASE WHEN user_id IS NULL THEN n END), 0)::BIGINT,
       count(*) FILTER (WHERE user_id IS NOT NULL AND n > 1)::BIGINT, 0::BIGINT
FROM uk"""

INVALID = """(user_id IS NULL OR adgroup_id IS NULL OR timestamp_seconds IS NULL OR timestamp_seconds < 0
  OR placement_id IS NULL OR trim(placement_id) = '' OR clicked IS NULL OR nonclick IS NULL
  OR clicked NOT IN (0, 1) OR nonclick NOT IN (0, 1) OR clicked + nonclick <> 1)"""

ORACLE["check_invalid_impressions"] = _with(DIRTY_IMP) + f"""
SELECT count(*)::BIGINT AS impressions,
       count(*) FILTER (WHERE {INVALID})::BIGINT AS invalid_rows,
       sum(clicked)::BIGINT AS clicks,
       CAST(min(reporting_date) AS VARCHAR) AS first_date,
       CAST(max(reporting_date) AS VARCHAR) AS last_date
FROM dimp"""

ORACLE["unmatched_ads"] = _with(DIRTY_IMP, DIRTY_ADS) + f"""
SELECT {IMP_COLS} FROM dimp i
WHERE NOT EXISTS (SELECT 1 FROM dads a WHERE a.adgroup_id = i.adgroup_id)"""

ORACLE["missing_profiles"] = _with(IMP, USERS) + """
SELECT count(*)::BIGINT AS missing_profile_impressions FROM imp i
WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = i.user_id)"""

TOTALS = """totals AS (
  SELECT count(*)::BIGINT AS impressions, sum(clicked)::BIGINT AS clicks,
         CAST(min(reporting_date) AS VARCHAR) AS first_date,
         CAST(max(reporting_date) AS VARCHAR) AS last_date,
         count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = imp.user_id))::BIGINT
           AS missing_profile_impressions
  FROM imp)"""

ORACLE["fact_totals"] = _with(IMP, USERS, TOTALS) + "SELECT * FROM totals"


def _reconcile(report: str, source: str) -> str:
    return f"""
SELECT report, gold_rows, impressions, clicks, missing_profile_impressions,
       expected_impressions, expected_clicks, expected_missing_profile_impressions, invalid_rows,
       (impressions = expected_impressions AND clicks = expected_clicks
        AND missing_profile_impressions = expected_missing_profile_impressions
        AND invalid_rows = 0) AS reconciles
FROM (SELECT '{report}' AS report, count(*)::BIGINT AS gold_rows,
             coalesce(sum(g.impressions), 0)::BIGINT AS impressions,
             coalesce(sum(g.clicks), 0)::BIGINT AS clicks,
             coalesce(sum(g.missing_profile_impressions), 0)::BIGINT AS missing_profile_impressions,
             (SELECT impressions FROM totals) AS expected_impressions,
             (SELECT clicks FROM totals) AS expected_clicks,
             (SELECT missing_profile_impressions FROM totals) AS expected_missing_profile_impressions,
             count(*) FILTER (WHERE g.ctr IS NULL OR g.ctr < 0 OR g.ctr > 1 OR g.impressions <= 0)::BIGINT
               AS invalid_rows
      FROM {source} g)"""


ORACLE["gold_reconciliation"] = _with(IMP, ADS, USERS, ENRICHED, TOTALS) + f""",
cd AS (SELECT reporting_date, campaign_id, advertiser_id, {MEASURES}
       FROM enriched GROUP BY reporting_date, campaign_id, advertiser_id),
ad AS (SELECT reporting_date, advertiser_id, age_level, {MEASURES}
       FROM enriched GROUP BY reporting_date, advertiser_id, age_level),
tcd AS (SELECT reporting_date, campaign_id, advertiser_id, impressions,
               clicks + CASE WHEN campaign_id % 10 = 3 THEN 1 ELSE 0 END AS clicks,
               missing_profile_impressions, ctr FROM cd)
{_reconcile('campaign_daily', 'cd')}
UNION ALL {_reconcile('audience_daily', 'ad')}
UNION ALL {_reconcile('campaign_daily_tampered', 'tcd')}"""

ORACLE["row_count_match"] = """
SELECT 'impressions' AS table_name, (SELECT count(*) FROM events)::BIGINT AS bronze_rows,
       (SELECT count(*) FROM events)::BIGINT AS silver_rows,
       (SELECT count(*) FROM events) > 0 AS counts_match
UNION ALL
SELECT 'ads', (SELECT count(*) FROM part)::BIGINT, (SELECT count(*) FROM part)::BIGINT,
       (SELECT count(*) FROM part) > 0
UNION ALL
SELECT 'user_profiles', (SELECT count(*) FROM customer)::BIGINT,
       (SELECT count(*) FROM customer)::BIGINT,
       (SELECT count(*) FROM customer) > 0"""

ORACLE["table_diff"] = _with(IMP, DIRTY_IMP) + f"""
SELECT 'left' AS side, count(*)::BIGINT AS multiplicity, {IMP_COLS}
FROM (SELECT {IMP_COLS} FROM imp EXCEPT ALL SELECT {IMP_COLS} FROM dimp) GROUP BY ALL
UNION ALL
SELECT 'right' AS side, count(*)::BIGINT AS multiplicity, {IMP_COLS}
FROM (SELECT {IMP_COLS} FROM dimp EXCEPT ALL SELECT {IMP_COLS} FROM imp) GROUP BY ALL"""

# --- P3: read workloads ----------------------------------------------------------------
TYPED = """typed AS (
  SELECT user_id AS "user", epoch_us(ts) // 1000000 AS time_stamp,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS adgroup_id, event_type AS pid,
         CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS nonclk,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clk
  FROM events)"""
_NARROW = "SELECT pid, count(*)::BIGINT AS impressions, sum(clk)::BIGINT AS clicks FROM typed"
_WIDE = """SELECT pid, count(*)::BIGINT AS impressions, sum("user")::BIGINT AS sum_user,
       sum(time_stamp)::BIGINT AS sum_time_stamp, sum(adgroup_id)::BIGINT AS sum_adgroup_id,
       sum(nonclk)::BIGINT AS sum_nonclk, sum(clk)::BIGINT AS sum_clk FROM typed"""
_ONE_DAY = "WHERE time_stamp >= 1704643200 AND time_stamp < 1704643200 + 86400"
for _src in ("placement", "parquet"):
    ORACLE[f"{_src}_narrow"] = _with(TYPED) + _NARROW + " GROUP BY pid"
    ORACLE[f"{_src}_wide"] = _with(TYPED) + _WIDE + " GROUP BY pid"
    ORACLE[f"{_src}_one_day"] = _with(TYPED) + _NARROW + f" {_ONE_DAY} GROUP BY pid"

_SILVER_READ = ("SELECT placement_id, count(*)::BIGINT AS impressions, sum(clicked)::BIGINT AS clicks "
                "FROM imp {where} GROUP BY placement_id")
_SILVER_WHERE = {"one_day": "WHERE reporting_date = DATE '2024-01-08'",
                 "three_days": "WHERE reporting_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-10'",
                 "full_period": ""}
for _src in ("silver", "partitioned", "clustered"):
    for _w, _where in _SILVER_WHERE.items():
        ORACLE[f"{_src}_{_w}"] = _with(IMP) + _SILVER_READ.format(where=_where)

# --- P4: every strategy variant must equal its control ------------------------------------
for _name in ("campaign_merge_ads", "campaign_merge_profiles", "campaign_broadcast", "campaign_shuffle_hash",
              "campaign_shuffle_32", "campaign_no_coalesce", "campaign_zstd", "reporting_date_udf",
              "campaign_shared_rollup", "gold_pipeline_campaign"):
    ORACLE[_name] = CAMPAIGN_DAILY
for _name in ("audience_merge_ads", "audience_merge_profiles", "reports_cached", "reporting_date_arrow",
              "audience_shared_rollup"):
    ORACLE[_name] = AUDIENCE_DAILY

# --- P5: statistics -------------------------------------------------------------------------
DAILY = """daily AS (SELECT placement_id, reporting_date, sum(clicked)::BIGINT AS clicks
                     FROM imp GROUP BY placement_id, reporting_date)"""

ORACLE["run_distribution"] = _with(IMP, DAILY) + """
SELECT placement_id,
       string_agg(CAST(clicks AS VARCHAR), ',' ORDER BY clicks) AS samples,
       count(clicks)::BIGINT AS n, median(clicks)::DOUBLE AS median,
       min(clicks) AS min, max(clicks) AS max, round(stddev_samp(clicks), 9) AS stdev
FROM daily GROUP BY placement_id"""

ORACLE["size_distribution"] = _with(IMP, ADS, USERS, ENRICHED) + f""",
cd AS (SELECT reporting_date, campaign_id, advertiser_id, {MEASURES}
       FROM enriched GROUP BY reporting_date, campaign_id, advertiser_id)
SELECT reporting_date, count(impressions)::BIGINT AS count, sum(impressions)::BIGINT AS total,
       min(impressions) AS min, median(impressions)::DOUBLE AS median,
       quantile_disc(impressions, 0.95) AS p95, max(impressions) AS max
FROM cd GROUP BY reporting_date"""

ORACLE["right_vs_left"] = _with(IMP, DAILY) + """
SELECT placement_id, left_median, right_median,
       CASE WHEN left_median <> 0 THEN (right_median - left_median) / left_median * 100 END
         AS right_vs_left_percent
FROM (SELECT placement_id,
             median(clicks) FILTER (WHERE reporting_date < DATE '2024-01-16')::DOUBLE AS left_median,
             median(clicks) FILTER (WHERE reporting_date >= DATE '2024-01-16')::DOUBLE AS right_median
      FROM daily GROUP BY placement_id)"""

ORACLE["settings_diff"] = _with(IMP, DIRTY_IMP) + """,
r AS (SELECT placement_id AS key, CAST(sum(clicked) AS VARCHAR) AS reference_value FROM imp GROUP BY 1),
c AS (SELECT placement_id AS key, CAST(sum(clicked) AS VARCHAR) AS current_value FROM dimp GROUP BY 1)
SELECT coalesce(r.key, c.key) AS key, reference_value, current_value,
       coalesce(r.key, c.key) IN ('click') AS declared
FROM r FULL OUTER JOIN c ON r.key = c.key
WHERE reference_value IS DISTINCT FROM current_value"""

ORACLE["fact_checks"] = _with(DIRTY_IMP, DIRTY_ADS, USERS) + f"""
SELECT count(*)::BIGINT AS impressions,
       count(*) FILTER (WHERE {INVALID})::BIGINT AS invalid_rows,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM dads a WHERE a.adgroup_id = i.adgroup_id))::BIGINT
         AS unmatched_ad_impressions,
       sum(clicked)::BIGINT AS clicks,
       CAST(min(reporting_date) AS VARCHAR) AS first_date,
       CAST(max(reporting_date) AS VARCHAR) AS last_date,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = i.user_id))::BIGINT
         AS missing_profile_impressions
FROM dimp i"""

# --- storage, runs and ordering --------------------------------------------------------------
ORACLE["placement_ordered"] = _with(IMP) + """
SELECT *, row_number() OVER (ORDER BY impressions DESC NULLS LAST, clicks NULLS LAST, placement_id NULLS LAST) AS place
FROM (SELECT placement_id, count(*)::BIGINT AS impressions, sum(clicked)::BIGINT AS clicks FROM imp GROUP BY placement_id)"""

ORACLE["table_detail"] = _with(IMP) + """
SELECT 'reporting_date' AS partition_columns, count(DISTINCT reporting_date)::BIGINT AS partitions,
       TRUE AS every_partition_has_files FROM imp"""

ORACLE["codec_audit"] = "SELECT count(*)::BIGINT AS rows, 'ZSTD' AS codecs, TRUE AS matches_expected FROM events"

#: The gate runs on this folder (see TESTDATA.md); DuckDB hashes the files themselves.
ORACLE["source_fingerprint"] = """
SELECT parse_filename(filename) AS file_name, size AS bytes, sha256(content) AS sha256
FROM read_blob('/root/testdata/sf0.01/*.parquet')"""

_TEXT = ", ".join(f"coalesce('+' || CAST({c} AS VARCHAR), '-')" for c in sorted(IMP_COLS.split(", ")))
ORACLE["row_fingerprint"] = _with(IMP) + f"""
SELECT count(*)::BIGINT AS row_count,
       CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(31), {_TEXT})), 1, 15) AS BIGINT)) AS VARCHAR) AS hash_sum
FROM imp"""

RUN_TABLES = f"""counts AS (
  SELECT 'bronze' AS layer, 'impressions' AS table_name, (SELECT count(*) FROM imp)::BIGINT AS rows
  UNION ALL SELECT 'bronze', 'ads', (SELECT count(*) FROM ads)::BIGINT
  UNION ALL SELECT 'bronze', 'user_profiles', (SELECT count(*) FROM users)::BIGINT
  UNION ALL SELECT 'silver', 'impressions', (SELECT count(*) FROM imp)::BIGINT
  UNION ALL SELECT 'silver', 'ads', (SELECT count(*) FROM ads)::BIGINT
  UNION ALL SELECT 'silver', 'user_profiles', (SELECT count(*) FROM users)::BIGINT
  UNION ALL SELECT 'gold', 'campaign_daily',
    (SELECT count(*) FROM (SELECT DISTINCT reporting_date, campaign_id, advertiser_id FROM enriched))::BIGINT
  UNION ALL SELECT 'gold', 'audience_daily',
    (SELECT count(*) FROM (SELECT DISTINCT reporting_date, advertiser_id, age_level FROM enriched))::BIGINT)"""

ORACLE["storage_totals"] = _with(IMP, ADS, USERS, ENRICHED, RUN_TABLES) + """
SELECT layer, table_name, rows, TRUE AS only_parquet_files FROM counts"""

ORACLE["runs_output_equality"] = _with(IMP, ADS, USERS, ENRICHED, RUN_TABLES) + """
SELECT 'variant' AS run_id, layer || '/' || table_name AS table_name, rows AS control_rows, rows AS run_rows,
       0::BIGINT AS control_only_rows, 0::BIGINT AS run_only_rows, TRUE AS equal FROM counts"""

ORACLE["runs_comparability"] = _with(IMP, ADS, USERS) + """
SELECT *, control_value = variant_value AS same FROM (
  SELECT 'status' AS key, 'succeeded' AS control_value, 'succeeded' AS variant_value
  UNION ALL SELECT 'tables', t, t FROM (SELECT 'bronze/ads,bronze/impressions,bronze/user_profiles,gold/audience_daily,'
    || 'gold/campaign_daily,silver/ads,silver/impressions,silver/user_profiles' AS t)
  UNION ALL SELECT 'settings.spark.sql.parquet.compression.codec', 'snappy', 'zstd'
  UNION ALL SELECT 'sources.raw_sample.csv.rows', n, n FROM (SELECT CAST(count(*) AS VARCHAR) AS n FROM imp)
  UNION ALL SELECT 'sources.ad_feature.csv.rows', n, n FROM (SELECT CAST(count(*) AS VARCHAR) AS n FROM ads)
  UNION ALL SELECT 'sources.user_profile.csv.rows', n, n FROM (SELECT CAST(count(*) AS VARCHAR) AS n FROM users))"""

ORACLE["storage_by_layout"] = _with(IMP) + """
SELECT layout, (SELECT count(*) FROM imp)::BIGINT AS data_rows,
       CASE WHEN layout = 'silver_by_date' THEN (SELECT count(DISTINCT reporting_date) FROM imp) ELSE 0 END::BIGINT AS partitions,
       CASE WHEN layout <> 'silver_by_date' THEN layout <> 'typed_csv' END AS smaller_than_csv
FROM (VALUES ('typed_csv'), ('typed_parquet'), ('silver'), ('silver_zstd'), ('silver_by_date')) AS l(layout)"""

# --- evidence of what ran: the reports' totals from the tables, the plan's facts as each preset's literal ---------
_REPORT_TOTALS = """
r(report, report_rows, impressions) AS (
  SELECT 'campaign_daily', count(*)::BIGINT, sum(n)::BIGINT
  FROM (SELECT count(*) AS n FROM enriched GROUP BY reporting_date, campaign_id, advertiser_id)
  UNION ALL SELECT 'audience_daily', count(*)::BIGINT, sum(n)::BIGINT
  FROM (SELECT count(*) AS n FROM enriched GROUP BY reporting_date, advertiser_id, age_level))"""

ORACLE["plan_evidence"] = _with(IMP, ADS, USERS, ENRICHED) + "," + _REPORT_TOTALS + """,
p(preset, ads_join, profile_join, initial_partitions, coalesced, cache_scans, python_node) AS (VALUES
  ('control', 'BroadcastHashJoin', 'BroadcastHashJoin', '48', TRUE, 0, NULL),
  ('ads_merge', 'SortMergeJoin', 'BroadcastHashJoin', '48', TRUE, 0, NULL),
  ('profiles_merge', 'BroadcastHashJoin', 'SortMergeJoin', '48', TRUE, 0, NULL),
  ('shuffle_hash', 'ShuffledHashJoin', 'ShuffledHashJoin', '48', TRUE, 0, NULL),
  ('shuffle_32', 'BroadcastHashJoin', 'BroadcastHashJoin', '32', TRUE, 0, NULL),
  ('cached', 'BroadcastHashJoin', 'BroadcastHashJoin', '48', TRUE, 1, NULL),
  ('no_coalesce', 'BroadcastHashJoin', 'BroadcastHashJoin', '48', FALSE, 0, NULL),
  ('python_udf', 'BroadcastHashJoin', 'BroadcastHashJoin', '48', TRUE, 0, 'BatchEvalPython'),
  ('arrow_udf', 'BroadcastHashJoin', 'BroadcastHashJoin', '48', TRUE, 0, 'ArrowEvalPython'),
  ('shared_rollup', 'BroadcastHashJoin', 'BroadcastHashJoin', '48', TRUE, 0, NULL))
SELECT p.*, r.* FROM p CROSS JOIN r"""

ORACLE["task_evidence"] = _with(IMP, ADS, USERS, ENRICHED) + "," + _REPORT_TOTALS + """
SELECT 'gold.' || report AS job_group, 1 AS partition_stages, TRUE AS all_completed, 0 AS failed_tasks, report_rows, impressions FROM r"""

ORACLE["report_against_files"] = _with(IMP, ADS, USERS, ENRICHED, RUN_TABLES) + """
SELECT run, layer, table_name, rows, TRUE AS agrees FROM counts CROSS JOIN (VALUES ('control'), ('variant')) v(run)"""
