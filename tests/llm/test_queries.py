"""Registered queries against their DuckDB SQL on the smallest tables."""
from __future__ import annotations

import duckdb
import pytest

from adlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = db.execute(ORACLE[name])
    columns = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in columns]
    rows = sorted((tuple(r[k] for k in order) for r in want.fetchall()), key=repr)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == rows and rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_the_others_return_rows(spark, name):
    """Their results are checked beside their operators."""
    assert QUERIES[name](spark, SF).count() > 0
