"""Every registered query runs; those with SQL give the same rows as that SQL."""

import os

import pytest

import __spark_entry__ as entries
from tests.oracle import connect, difference
from workload import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# the corpus queries have tests of their own
QUERIES, CHECKS = catalog.QUERIES, catalog.CHECKS


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(CHECKS) == set(QUERIES)
    assert set(CHECKS) <= set(entries.oracle_sql()) <= set(entries.queries())


def test_entry(spark):
    got = entries.entry(spark)
    assert set(got.columns) == {"syear", "share_willing", "share_actual"} and got.count() == 5


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_as_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF_DIR), db, CHECKS[name]) is None
