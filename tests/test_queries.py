"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, database
from workloads import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def link():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_has_an_oracle(name):
    assert name in ORACLES


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, link, name):
    assert compare(spark, link, SF_DIR, name) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
