"""Queries over tables in which one key of each kind holds a third of all rows."""

import pytest

import __spark_entry__ as entry_points
from comparison import connect, differences
from skew import write_hot_tables

NAMES = ["dedup_transactions", "monthly_revenue", "top_products", "store_performance", "revenue_rank", "rfm_quantile",
         "rfm_ntile", "clean_transactions", "sales_mart", "client_mart", "product_mart", "quality_report",
         "referential_check", "upsert_table"]


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    return write_hot_tables("/root/testdata/sf0.001", str(tmp_path_factory.mktemp("hot")))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, hot, name):
    assert differences(entry_points.queries()[name](spark, hot), connect(hot), entry_points.oracle_sql()[name]) == []
