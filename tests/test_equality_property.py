"""Property: the one-pass diff has exactly EXCEPT ALL (multiset) semantics, nulls included."""
from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from adlake.operators.equality import compare, table_diff

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from(["a", "b"])))
ROWS = st.lists(ROW, max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=ROWS, right=ROWS)
def test_diff_matches_multiset_difference(spark, left, right):
    ddl = "id long, v string"
    l, r = spark.createDataFrame(left, ddl), spark.createDataFrame(right, ddl)
    got = Counter()
    for row in table_diff(l, r).collect():
        got[(row.side, row.id, row.v)] += row.multiplicity
    want = Counter({("left", *k): n for k, n in (Counter(left) - Counter(right)).items()})
    want.update({("right", *k): n for k, n in (Counter(right) - Counter(left)).items()})
    assert got == want
    assert compare(l, r).equal == (Counter(left) == Counter(right))
