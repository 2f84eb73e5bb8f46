from __future__ import annotations

import csv
import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
SHANGHAI = timezone(timedelta(hours=8))


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", "adlake-tests", shuffle_partitions=8)
    yield session
    session.stop()


def epoch(text: str) -> int:
    """'2017-05-06 00:00:00' in +08:00 -> epoch seconds."""
    return int(datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=SHANGHAI).timestamp())


IMPRESSIONS = [
    ("1", epoch("2017-05-06 00:00:00"), "10", "p1", "0", "1"),
    ("1", epoch("2017-05-06 23:59:59"), "10", "p1", "1", "0"),
    ("2", epoch("2017-05-06 12:00:00"), "20", "p2", "0", "1"),
    ("3", epoch("2017-05-06 18:00:00"), "20", "p2", "1", "0"),
    ("2", epoch("2017-05-07 00:00:00"), "10", "p1", "1", "0"),
]
ADS = [("10", "1", "100", "1000", "NULL", "170"), ("20", "2", "200", "1000", "999", "99999999")]
PROFILE_HEADER = ["userid", "cms_segid", "cms_group_id", "final_gender_code", "age_level", "pvalue_level",
                  "shopping_level", "occupation", "new_user_class_level "]
PROFILES = [("1", "0", "1", "1", "3", "", "2", "0", "1"), ("2", "0", "1", "2", "4", "2", "2", "0", "")]


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows(rows)


def write_sources(directory, impressions=IMPRESSIONS, ads=ADS, profiles=PROFILES,
                  impressions_header=None):
    """The hand-checkable three-file source (FIXTURES.md section 1)."""
    os.makedirs(directory, exist_ok=True)
    write_csv(f"{directory}/raw_sample.csv",
              impressions_header or ["user", "time_stamp", "adgroup_id", "pid", "nonclk", "clk"], impressions)
    write_csv(f"{directory}/ad_feature.csv",
              ["adgroup_id", "cate_id", "campaign_id", "customer", "brand", "price"], ads)
    write_csv(f"{directory}/user_profile.csv", PROFILE_HEADER, profiles)
    return str(directory)
