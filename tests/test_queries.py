"""Every registered query: its check in SQL where it has one, else that it gives rows."""

import pytest

from marginalia.plans import registry
from tests.checker import compare

QUERIES, CHECKS = registry.queries(), registry.checks()

# No two of the few pages at the smallest scale share a route.
EMPTY_WHEN_SMALL = {"route_dedupe"}


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_check(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    result = compare(df, con, CHECKS[name])
    assert result["ok"], result
    assert result["rows"] > 0 or name in EMPTY_WHEN_SMALL


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_gives_rows(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
