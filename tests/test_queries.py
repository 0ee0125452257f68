import pytest
from oracle import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from workload import extraction, files, runs, works

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


JOBS = [name for area in (works, extraction, files, runs) for name in area.QUERIES]


def test_every_job_query_has_sql():
    assert set(JOBS) <= set(queries()) and set(JOBS) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["id", "publication_year", "abstract", "citation"]


@pytest.mark.parametrize("name", JOBS)
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None
