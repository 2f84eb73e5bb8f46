"""Data-quality checks (Q1-Q7) as Spark queries that return small result rows.

What a valid row is stands in tables of rules; checks fold them into one predicate and count
what breaks it, one aggregation pass (or anti join) each. The raising wrappers at the bottom
turn such rows into :class:`QualityError`. Nothing that grows with the input is collected.
"""
from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class QualityError(ValueError):
    """A table breaks a rule; the message names the table and the counts."""


class Rule(NamedTuple):
    """A column must have a value, which must also keep the conditions given here."""

    column: str
    at_least: int | None = None
    one_of: tuple | None = None
    may_be_blank: bool = True

    def kept(self) -> Column:
        c = F.col(self.column)
        conditions = [c.isNotNull()]
        if self.at_least is not None:
            conditions.append(c >= self.at_least)
        if self.one_of is not None:
            conditions.append(c.isin(*self.one_of))
        if not self.may_be_blank:
            conditions.append(F.length(F.trim(c)) > 0)
        return reduce(and_, conditions)


#: What an impression must be; the click flags must also contradict each other.
IMPRESSION_RULES = (Rule("user_id"), Rule("adgroup_id"), Rule("timestamp_seconds", at_least=0),
                    Rule("placement_id", may_be_blank=False), Rule("clicked", one_of=(0, 1)), Rule("nonclick", one_of=(0, 1)))
IMPRESSION_BALANCE = "clicked + nonclick = 1"
#: Q2: key and attributes that every row of a dimension must have.
DIMENSION_KEYS = {"ads": ("adgroup_id", ("campaign_id", "advertiser_id")), "user_profiles": ("user_id", ())}
#: Q6: measures whose report totals must be those of the fact.
RECONCILED = ("impressions", "clicks", "missing_profile_impressions")


def breaks(rules=IMPRESSION_RULES, balance: str | None = IMPRESSION_BALANCE) -> Column:
    """True for rows that break a rule, false for the others, never null."""
    kept = [r.kept() for r in rules] + ([F.expr(balance)] if balance else [])
    return ~F.coalesce(reduce(and_, kept), F.lit(False))


def dimension_violations(df: DataFrame, key: str, required: tuple[str, ...] = (),
                         name: str | None = None) -> DataFrame:
    """Null keys, duplicated keys and rows missing required attributes.

    One shuffle on the key (after map-side partial counts), then a global fold."""
    lacking = breaks([Rule(c) for c in required], None) if required else F.lit(False)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(lacking).alias("lacking"))
    null = F.col(key).isNull()

    def total(amount: Column, label: str) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("long").alias(label)

    return per_key.agg(F.lit(name or key).alias("dimension"), total(F.col("n"), "row_count"),
                       total(F.when(null, F.col("n")), "null_keys"), F.count_if(~null & (F.col("n") > 1)).alias("duplicate_keys"),
                       total(F.col("lacking"), "missing_required"))


def _facts() -> list[Column]:
    """Additive facts of impressions: they sum (or min/max) again over any grouping."""
    return [F.count(F.lit(1)).alias("impressions"), F.count_if(breaks()).alias("invalid_rows"),
            F.sum("clicked").cast("long").alias("clicks"), F.min("reporting_date").alias("first_date"),
            F.max("reporting_date").alias("last_date")]


def _folded(*more: Column, only: tuple[str, ...] = ("impressions", "invalid_rows", "clicks", "first_date", "last_date")) -> list[Column]:
    """Facts of groups as facts of the whole, dates as text."""
    count = {c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("impressions", "invalid_rows")}
    whole = count | {"clicks": F.sum("clicks").cast("long").alias("clicks"),
                     "first_date": F.min("first_date").cast("string").alias("first_date"),
                     "last_date": F.max("last_date").cast("string").alias("last_date")}
    return [whole[c] for c in only] + list(more)


def impression_violations(df: DataFrame) -> DataFrame:
    """Q3 + A7 in one pass: invalid rows and the fact totals of the same scan."""
    return df.agg(*_facts()).agg(*_folded())


def unmatched(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts whose key has no row in the dimension (null keys never match)."""
    return fact.join(dim.select(key), key, "left_anti")


def _without(key: str, label: str) -> Column:
    """Impressions of the groups whose key the dimension lacks, as a sum over marked groups."""
    return F.coalesce(F.sum(F.when(F.col(f"_{key}").isNull(), F.col("impressions"))), F.lit(0)).cast("long").alias(label)


def _marked(groups: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return groups.join(dim.select(key).distinct().withColumn(f"_{key}", F.lit(True)), key, "left")


def fact_totals(impressions: DataFrame, users: DataFrame) -> DataFrame:
    """Impressions, clicks, date range and impressions without a profile.

    The fact is aggregated by user before the join with the distinct profile keys, so the
    join sees one row per user: a user with a third of all rows is one row per map task in
    the shuffle and one row in the join, and a duplicated key can't inflate totals."""
    groups = _marked(impressions.groupBy("user_id").agg(*_facts()), users, "user_id")
    return groups.agg(*_folded(_without("user_id", "missing_profile_impressions"),
                               only=("impressions", "clicks", "first_date", "last_date")))


def fact_checks(impressions: DataFrame, ads: DataFrame, users: DataFrame) -> DataFrame:
    """Q3+Q4+Q5: invalid rows, impressions without an ad, totals, date range and impressions
    without a profile.

    Aggregated by ad and by user before the joins, like ``fact_totals``. The two groupings
    meet as one row each, and the ad side reads one column of the fact."""
    by_ad = impressions.groupBy("adgroup_id").agg(F.count(F.lit(1)).alias("impressions"))
    by_ad = _marked(by_ad, ads, "adgroup_id")
    lacking_ads = by_ad.agg(_without("adgroup_id", "unmatched_ad_impressions"))
    by_user = _marked(impressions.groupBy("user_id").agg(*_facts()), users, "user_id")
    totals = by_user.agg(*_folded(_without("user_id", "missing_profile_impressions")))
    both = totals.unionByName(lacking_ads, allowMissingColumns=True)  # two rows, folded without a join
    return both.agg(*[F.max(c).alias(c) for c in (
        "impressions", "invalid_rows", "unmatched_ad_impressions", "clicks", "first_date", "last_date",
        "missing_profile_impressions")])


def key_checks(impressions: DataFrame, ads: DataFrame, users: DataFrame) -> DataFrame:
    """Q4 + J4 alone: impressions without an ad and without a profile, from the two key columns."""
    rows = []
    for key, dim, label in (("adgroup_id", ads, "unmatched_ad_impressions"), ("user_id", users, "missing_profile_impressions")):
        groups = _marked(impressions.groupBy(key).agg(F.count(F.lit(1)).alias("impressions")), dim, key)
        rows.append(groups.agg(_without(key, label)))
    both = rows[0].unionByName(rows[1], allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("unmatched_ad_impressions", "missing_profile_impressions")])


def observed_facts() -> list[Column]:
    """The facts of impressions that need no other table, to observe while they are written."""
    return [*_facts()[:3], F.min("reporting_date").cast("string").alias("first_date"),
            F.max("reporting_date").cast("string").alias("last_date")]


def observed_content(df: DataFrame) -> list[Column]:
    """Row count and order-independent content sum of a table, to observe while it is written."""
    return [F.count(F.lit(1)).alias("rows"),
            F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")).cast("string").alias("hash_sum")]


def impossible_report_row() -> Column:
    """A report row without impressions, or whose click-through rate isn't a share."""
    return breaks([Rule("impressions", at_least=1), Rule("ctr", at_least=0)], "ctr <= 1")


def report_totals(gold: DataFrame) -> DataFrame:
    """One row: a report's rows, its measures' totals and its impossible rows."""
    return gold.agg(F.count(F.lit(1)).alias("gold_rows"),
                    *[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in RECONCILED],
                    F.count_if(impossible_report_row()).alias("invalid_rows"))


def reconcile(gold: DataFrame, totals: DataFrame, name: str) -> DataFrame:
    """One row: a report's totals beside the fact's, and whether they agree and no
    row is impossible. Two one-row tables are stacked and folded, so there is no join."""
    wanted = totals.select(*[F.col(m).alias(f"expected_{m}") for m in RECONCILED])
    stacked = report_totals(gold).unionByName(wanted, allowMissingColumns=True)
    columns = ["gold_rows", *RECONCILED, *[f"expected_{m}" for m in RECONCILED], "invalid_rows"]
    row = stacked.agg(F.lit(name).alias("report"), *[F.max(c).alias(c) for c in columns])
    agree = reduce(and_, [F.col(m) == F.col(f"expected_{m}") for m in RECONCILED])
    return row.withColumn("reconciles", agree & (F.col("invalid_rows") == 0))


def row_hash(df: DataFrame) -> Column:
    """A row's 60-bit hash: the first hex digits of the MD5 of its columns as text, in name
    order. Any engine can compute it. Null is told from text by a prefix."""
    parts = [F.when(F.col(f"`{c}`").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(f"`{c}`").cast("string")))
             for c in sorted(df.columns)]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 15), 16, 10).cast("decimal(38,0)")


def row_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Q7/A10: Bronze and Silver row counts per table (from Parquet metadata alone); they match
    when equal and > 0."""
    sides = []
    for name, (bronze, silver) in pairs.items():
        for layer, df in (("bronze", bronze), ("silver", silver)):
            sides.append(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias(f"{layer}_rows")))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    out = stacked.groupBy("table_name").agg(*[F.max(c).alias(c) for c in ("bronze_rows", "silver_rows")])
    return out.withColumn("counts_match", (F.col("bronze_rows") == F.col("silver_rows")) & (F.col("bronze_rows") > 0))


# --- raising wrappers (Q1) ------------------------------------------------------------

def refuse(table: str, found: dict[str, int]) -> None:
    """Raise if any of the counted faults was found."""
    faults = {what: n for what, n in found.items() if n}
    if faults:
        raise QualityError(f"{table}: " + ", ".join(f"{n} {what}" for what, n in faults.items()))


def refuse_rows(df: DataFrame, table: str, what: str) -> None:
    """F8/O1: existence probe; stops at the first row found."""
    if not df.isEmpty():
        raise QualityError(f"{table}: {what}")


def validate_dimensions(ads: DataFrame, users: DataFrame) -> dict:
    tables = {"ads": ads, "user_profiles": users}
    checks = [dimension_violations(tables[n], key, required, n) for n, (key, required) in DIMENSION_KEYS.items()]
    for row in reduce(DataFrame.unionByName, checks).collect():  # one job, a row per dimension
        key = DIMENSION_KEYS[row["dimension"]][0]
        refuse(row["dimension"], {f"rows without {key}": row["null_keys"], f"repeated values of {key}": row["duplicate_keys"],
                                  "rows without required attributes": row["missing_required"]})
    return {"dimension_keys_unique_and_present": True}


def validate_impressions(impressions: DataFrame, ads: DataFrame, users: DataFrame, seen: dict | None = None) -> dict:
    """Checks of the fact; ``seen`` holds the facts that were observed while it was written,
    so that only the keys are read again."""
    if seen is None:
        row = fact_checks(impressions, ads, users).first().asDict()
    else:
        row = {**seen, **key_checks(impressions, ads, users).first().asDict()}
    refuse("impressions", {"rows break the row rules": row.pop("invalid_rows"),
                           "rows have no ad": row.pop("unmatched_ad_impressions"), "empty table": int(row["impressions"] == 0)})
    return row


def validate_gold(gold: DataFrame, expected: dict, name: str) -> dict:
    """Q6 as a raising check against the (already collected) totals of the fact."""
    row = report_totals(gold).first().asDict()
    off = {f"{m} too many or too few": row[m] - expected[m] for m in RECONCILED}
    refuse(name, {**off, "impossible rows": row.pop("invalid_rows")})
    return {"rows": row.pop("gold_rows"), **row}
