"""Every registered query beside its SQL over the whole smallest tables."""

import pytest
from check import compare

from __spark_entry__ import entry, oracle_sql, queries
from folioframe.registry import entries

KEYS = list(entries())
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, key):
    total, _, problem = compare(spark, QUERIES, ORACLES, key, "0.001")
    assert not problem, problem
    assert total > 0


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_query_has_a_check():
    assert set(KEYS) <= set(ORACLES) and set(ORACLES) <= set(QUERIES)


PLAIN = [k for k in KEYS if not k.startswith(("write_", "stream_", "read_", "archive_", "upsert_"))]


@pytest.mark.parametrize("key", PLAIN)
def test_no_pairwise_joins(spark, key):
    plan = QUERIES[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
