"""Flatten ``sparkPlanInfo`` trees into one row per plan node.

A tree is JSON of any depth, which Spark SQL has no type for, so one Arrow pass walks each
tree with a stack: no limit on depth or nodes, and each tree is parsed once.
"""
from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame

METRICS = "array<struct<name:string,accumulatorId:long,metricType:string>>"
_METRICS = pa.list_(pa.struct([("name", pa.string()), ("accumulatorId", pa.int64()), ("metricType", pa.string())]))


def _nodes(tree: dict):
    """(path, depth, name, text, metrics) of a tree's nodes; a node's children are numbered."""
    stack = [("0", 0, tree)]
    while stack:
        path, depth, node = stack.pop()
        metrics = [{k: m.get(k) for k in ("name", "accumulatorId", "metricType")} for m in node.get("metrics") or ()]
        yield path, depth, node.get("nodeName"), node.get("simpleString"), metrics
        stack += [(f"{path}.{k}", depth + 1, child) for k, child in enumerate(node.get("children") or ())]


def plan_nodes(plans: DataFrame, keys: tuple[str, ...] = ("application", "execution_id"),
               plan_col: str = "plan") -> DataFrame:
    """Rows: keys, node_path ('0', '0.1', ...), depth, node_name, simple_string, metrics."""
    def run(batches):
        for batch in batches:
            for k, plan in enumerate(batch.column(plan_col).to_pylist()):
                if plan is None:
                    continue
                path, depth, name, text, metrics = zip(*_nodes(json.loads(plan)))
                same = [pa.array([batch.column(key)[k].as_py()] * len(path), batch.column(key).type) for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(path, pa.string()), pa.array(depth, pa.int32()), pa.array(name, pa.string()),
                     pa.array(text, pa.string()), pa.array(metrics, _METRICS)],
                    names=[*keys, "node_path", "depth", "node_name", "simple_string", "metrics"])

    source = plans.select(*keys, plan_col)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keys).schema)
    return source.mapInArrow(run, f"{ddl}, node_path string, depth int, node_name string, simple_string string, metrics {METRICS}")
