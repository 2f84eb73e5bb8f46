"""Read physical plans through the public ``explain`` text (no JVM handles).

After an action on the same DataFrame (``collect``; not a write, which wraps the plan in a
new execution), ``explain`` shows the final adaptive plan (``isFinalPlan=true``), which is what
ran. Spark prints an equi-join as ``Operator [left keys], [right keys], JoinType, ...`` and a shuffle as
``Exchange partitioning(..., n), ORIGIN, [plan_id=..]``; the patterns below read those two forms.
"""
from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

#: Groups: operator, name of the first left key, join type.
JOIN_LINE = r"(\w+Join)(?:\(skew=true\))? \[(\w+)#[^\]]*\], \[[^\]]*\], (\w+)"
#: Group: the number of partitions of a hash exchange, the last argument of its partitioning.
HASH_EXCHANGE_LINE = r"Exchange hashpartitioning\(.*?(\d+)\), [A-Z_]+, \[plan_id="


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        df.explain(mode=mode)
    return buffer.getvalue()


def join_operators(text: str) -> list[dict]:
    """(operator, first key, join type) of each physical join in plan text."""
    return [dict(zip(("operator", "key", "join_type"), m.groups())) for m in re.finditer(JOIN_LINE, text)]


def initial_partitions(text: str) -> list[int]:
    """Partition counts of every hash exchange."""
    return [int(n) for n in re.findall(HASH_EXCHANGE_LINE, text)]


def has_node(text: str, name: str) -> bool:
    return name in re.findall(r"\w+", text)
