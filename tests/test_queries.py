"""Every registered query against its SQL, and the shape of its plan."""

import pytest

from checks.compare import compare
from checks.queries import QUERIES


@pytest.mark.parametrize("key", QUERIES)
def test_matches_sql_without_nested_loops_or_python(spark, duck, sf_dir, key):
    df = QUERIES[key].spark(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "PandasUDF"):
        assert operator not in plan
    ok, note = compare(QUERIES[key], spark, duck, sf_dir, df)
    assert ok, note


def test_entry_points():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) == set(QUERIES) | set(entry.LLM_QUERIES)
