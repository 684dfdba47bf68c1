"""Every registered query against its SQL twin in another engine, on whole tables."""

import pytest

from __spark_entry__ import entry
from __spark_entry__ import queries as all_queries
from tellerchecks import compare
from tellerchecks.oracle import oracle_sql
from tellerchecks.registry import queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == oracle_sql().keys()
    assert QUERIES.keys() <= all_queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare.difference(spark, SF_DIR, QUERIES[name], oracle_sql()[name], con) == ""


def test_entry(spark):
    assert entry(spark).columns == ["Balance_Range", "Churn", "Count"]
    assert entry(spark).count() > 0
