"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import re

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from msglog.plans import catalog

SMALL = "/root/testdata/sf0.001"
# The operators on training text have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name in catalog.QUERIES}
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


# A window without keys may only see one row per bucket of the log.
BUCKETS_ONLY = {"assign_seq"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    frame = QUERIES[name](spark, SMALL)
    tree = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in tree and "BroadcastNestedLoopJoin" not in tree, "compares all pairs"
    assert "BatchEvalPython" not in tree, "row-at-a-time Python"
    in_one_task = re.search(r"Window [^\n]*\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition", tree)
    assert not in_one_task or name in BUCKETS_ONLY
    assert compare(frame, con, ORACLES[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and all(r.subject.startswith("events.click.") and r.k >= 50 for r in rows)
