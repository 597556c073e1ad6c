"""Every registered query against its SQL counterpart, over whole tables."""

import os

import pytest

import __spark_entry__ as entry_points
from comparison import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_points.catalogue.queries()
ORACLE = entry_points.oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) == []


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
