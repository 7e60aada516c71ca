"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as registered
import duck
from lexipost.plans.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck.connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() <= registered.queries().keys()
    assert QUERIES.keys() <= registered.oracle_sql().keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    result = registered.queries()[name](spark, SF_DIR)
    assert duck.differences(result, con, registered.oracle_sql()[name]) is None


def test_flagship(spark):
    rows = registered.entry(spark).collect()
    hits = {}
    for row in rows:
        hits[row.qid] = hits.get(row.qid, 0) + 1
    assert hits == {1: 97, 2: 98, 3: 81, 4: 111, 7: 26, 8: 59}
