"""Operator 4: URL allow/block rules in a trie over reversed host labels and path segments.

A rule is ``host/path``. It fits its host and every subdomain, where the URL's path starts
with the rule's path. The longest fitting rule wins: more host labels first, then the
longer path; of two equal rules, block wins. URLs that no rule fits get ``default``.

The trie is built once by the driver from the caller's list of rules and broadcast, so each
worker unpickles it once, however many tasks it runs. There is no shuffle, so a hot host costs nothing. A trie takes some
500 bytes a rule. A caller whose rules are a table too large for that calls
``judge_by_join``, which joins it on host suffixes and gives the same rows.
"""
from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from adlake.llm.common import refuse_clashes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a URL without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


class RuleTrie:
    """Nodes are dicts. Host labels are walked from the right; under a host, ``"/"`` leads
    to path nodes: whole segments are edges, and ``ends`` holds a rule's last, maybe
    unfinished segment. ``example.net/en/`` is net > example > "/" > "" > "en", end ""."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for rule, verdict in rules:
            host, path = split_rule(rule)
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(("host", label), {})
            *whole, last = path.split("/")
            node = node.setdefault("/", {})
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(("ends",), {})
            if ends.get(last, ("", ""))[1] != "block":
                ends[last] = (rule, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        node, best = self.root, self._path(self.root, path)
        for label in reversed(host.split(".")):
            node = node.get(("host", label))
            if node is None:
                break
            best = self._path(node, path) or best
        return best

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        node, best = node.get("/"), None
        for segment in path.split("/"):
            if node is None:
                break
            ends = node.get(("ends",), {})
            fitting = next((k for k in range(len(segment), -1, -1) if segment[:k] in ends), None) if ends else None
            if fitting is not None:
                best = ends[segment[:fitting]]
            node = node.get(segment)
        return best


def judge(pages: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", carry: tuple[str, ...] = ("page_id",),
          default: str = "allow") -> DataFrame:
    """One row per page: ``carry`` columns, host, path, rule (null if none fits), verdict.

    Null or empty URLs have an empty host and path, which only a rule without a host can fit.
    Repeated rows are judged one by one; an empty table gives an empty result. Other columns
    of ``pages`` are not read; ``carry`` columns may not have the result's names."""
    refuse_clashes(carry, ("host", "path", "rule", "verdict", "__d"))
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def decide(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        find = trie.value.find
        found = [find(h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    host, path = host_and_path(pages[url_col])
    out = pages.select(*[pages[c] for c in carry], host.alias("host"), path.alias("path"))
    return out.withColumn("__d", decide("host", "path")).select(*carry, "host", "path", "__d.rule", "__d.verdict")


def judge_by_join(pages: DataFrame, rules: DataFrame, url_col: str = "url", carry: tuple[str, ...] = ("page_id",),
                  default: str = "allow") -> DataFrame:
    """``judge`` for any number of rules: each distinct (host, path) meets the rules of its
    host suffixes in an equi-join, and the best rule comes back to the pages by join."""
    refuse_clashes(carry, ("host", "path", "rule", "verdict", "__best"))
    host, path = host_and_path(pages[url_col])
    rows = pages.select(*[pages[c] for c in carry], host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    keys = rows.select("host", "path").distinct()
    asked = keys.withColumn("__suffix", F.explode(F.array_distinct(F.concat(suffixes, F.array(F.lit(""))))))
    r = rules.select(F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("__suffix"), "rule", "verdict",
                     F.expr("case when instr(rule, '/') > 0 then substr(rule, instr(rule, '/')) else '' end").alias("__path"))
    rank = F.struct(F.when(F.col("__suffix") == "", 0).otherwise(F.size(F.split("__suffix", r"\."))).alias("labels"),
                    F.length("__path").alias("len"), (F.col("verdict") == "block").alias("block"), "rule", "verdict")
    best = (asked.join(r, "__suffix").filter(F.startswith("path", "__path"))
            .groupBy("host", "path").agg(F.max(rank).alias("__best")))
    return rows.join(best, ["host", "path"], "left").select(
        *carry, "host", "path", F.col("__best.rule").alias("rule"),
        F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))
