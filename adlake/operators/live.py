"""Evidence of what ran, in the session that ran it.

Two public sources: the status tracker tells what became of the tasks of a job group, and
``explain`` on a frame after an action shows the plan that adaptive execution ended with. The
event logs of :mod:`adlake.operators.evidence` tell more, but only once an application has
written them; these need no log. Evidence is a few rows per report; the reports
themselves are run in full and only their totals reach the driver.
"""
from __future__ import annotations

import re
import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.plans.inspect import has_node, initial_partitions, join_operators, plan_text

#: Seconds to wait until the tracker, which is told of ends a moment later, shows a group's jobs as ended.
TRACKER_WAIT = 20
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython")


class GroupTasks(NamedTuple):
    job_group: str
    jobs: int
    failed_jobs: int
    tasks_by_stage: list[int]  # of the stages that ran
    completed_tasks: int
    failed_tasks: int


def group_tasks(spark: SparkSession, group: str, wait: float = TRACKER_WAIT) -> GroupTasks:
    """The tasks of all jobs that ran under a job group. Stages whose output was there already didn't run."""
    tracker, until = spark.sparkContext.statusTracker(), time.monotonic() + wait
    while True:
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        stages = {s: tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds}
        ran = [s for s in stages.values() if s and s.numCompletedTasks + s.numFailedTasks + s.numActiveTasks]
        ended = jobs and all(j and j.status != "RUNNING" for j in jobs) and not any(s.numActiveTasks for s in ran)
        if ended or time.monotonic() > until:
            break
        time.sleep(0.05)
    return GroupTasks(group, len(jobs), sum(j is None or j.status != "SUCCEEDED" for j in jobs), sorted(s.numTasks for s in ran),
                      sum(s.numCompletedTasks for s in ran), sum(s.numFailedTasks for s in ran))


def check_group_tasks(found: GroupTasks) -> GroupTasks:
    """Raise unless the group ran, and every task of every stage that ran completed."""
    if not found.jobs or not found.tasks_by_stage:
        raise ValueError(f"nothing ran under {found.job_group!r}")
    if found.failed_jobs or found.failed_tasks or found.completed_tasks != sum(found.tasks_by_stage):
        raise ValueError(f"{found.job_group!r} didn't run soundly: {found}")
    return found


def totals(report: DataFrame) -> DataFrame:
    """A one-row frame that needs the whole report: its rows and the sum of its impressions."""
    return report.agg(F.count(F.lit(1)).alias("rows"), F.sum("impressions").alias("impressions"))


class PlanEvidence(NamedTuple):
    joins: dict[str, str]           # E3: operator by join key
    initial_partitions: list[int]   # E4: of the shuffles by key
    coalesced: bool                 # E6: a reader put small partitions together
    cache_scans: int                # E9
    python_node: str | None         # E10


def final_plan(df: DataFrame) -> str:
    """The plan that an action on ``df`` ended with; raises if none has run or it isn't final."""
    text = plan_text(df)
    if "isFinalPlan=true" not in text:
        raise ValueError("no action has run on this frame, or adaptive execution is off")
    # the plan that adaptive execution began with is printed too, indented deeper than its title
    kept, skip = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-|"))
        if "== Initial Plan ==" in line:
            skip = depth
        elif skip is not None and (depth < skip or "== Final Plan ==" in line):
            skip = None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def branches(text: str) -> list[str]:
    """The parts of a plan under its uppermost union, in order."""
    lines = text.splitlines()
    depths = [len(line) - len(line.lstrip(" :+-|")) for line in lines]
    top = next((k for k, line in enumerate(lines) if re.match(r"(\*\(\d+\) )?Union\b", line[depths[k]:])), None)
    if top is None:
        raise ValueError(f"no union: {text}")
    found: list[list[str]] = []
    for line, depth in zip(lines[top + 1:], depths[top + 1:]):
        if depth <= depths[top]:
            break
        if depth == depths[top] + 3:
            found.append([])
        found[-1].append(line)
    return ["\n".join(part) for part in found]


def plan_evidence(df: DataFrame) -> PlanEvidence:
    """E3, E4, E6, E9 and E10 from the final plan of a frame on which an action has run."""
    return evidence_of(final_plan(df))


def evidence_of(text: str) -> PlanEvidence:
    """The same from a final plan's text, or that of a branch of it."""
    joins: dict[str, str] = {}
    for join in join_operators(text):
        if joins.setdefault(join["key"], join["operator"]) != join["operator"]:
            raise ValueError(f"several operators join by {join['key']}: {text}")
    python = [n for n in PYTHON_NODES if has_node(text, n)]
    if len(python) > 1:
        raise ValueError(f"both kinds of Python evaluation: {text}")
    return PlanEvidence(joins, sorted(set(initial_partitions(text))), "AQEShuffleRead coalesced" in text,
                        len(re.findall(r"InMemoryTableScan", text)), python[0] if python else None)


def check_plan(found: PlanEvidence, expected: dict) -> PlanEvidence:
    """Raise unless the evidence is what ``expected`` names, field by field (joins: key by key)."""
    wrong = {}
    for field, want in expected.items():
        have = getattr(found, field)
        have = {k: have.get(k) for k in want} if field == "joins" else have
        if have != want:
            wrong[field] = (have, want)
    if wrong:
        raise ValueError(f"the plan shows otherwise (found, expected): {wrong}")
    return found
