"""Extraction with more requests than the broadcast bound: same rows as the SQL, requests gathered once."""

import pytest
from oracle import connect, difference

from __spark_entry__ import oracle_sql, queries
from stackroom.plans.extract import lookup
from workload import extraction

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize(
    "name",
    ["extract_beyond_bound", "extract_missing", "extract_rows", "extract_rows_sources", "extract_summary"],
)
def test_requests_beyond_the_bound(spark, con, monkeypatch, name):
    plans = []

    def beyond(index, requested):
        hits = lookup(index, requested, max_bytes=0)
        plans.append(hits._jdf.queryExecution().executedPlan().toString())
        return hits

    monkeypatch.setattr(extraction, "lookup", beyond)
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None
    assert [plan.count("SortMergeJoin") for plan in plans] == [1]
