"""Every registered query against its SQL."""

import pytest
from compare import differences, duck, duck_rows, spark_rows, type_differences

import __spark_entry__ as contract
from tidewell.queries import all_oracles, all_queries

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
# Queries whose edge cases need more rows than the smallest tables have.
ON_LARGER = [
    "silver_quarantine",
    "merge_upsert",
    "gold_monthly_region",
    "fact_orders",
    "fact_orders_slice",
    "clean_sales",
    "sales_stats",
    "as_of_version",
]


@pytest.fixture(scope="module")
def small():
    return duck(SMALL)


@pytest.fixture(scope="module")
def larger():
    return duck(LARGER)


def test_each_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", list(all_queries()))
def test_small(spark, small, name):
    found, sql = all_queries()[name](spark, SMALL), all_oracles()[name]
    assert type_differences(found, small, sql) == {}
    assert differences(spark_rows(found), duck_rows(small, sql)) == ""


@pytest.mark.parametrize("name", ON_LARGER)
def test_larger(spark, larger, name):
    found = spark_rows(all_queries()[name](spark, LARGER))
    assert sum(found[1].values()) > 0
    assert differences(found, duck_rows(larger, all_oracles()[name])) == ""


def test_entry(spark):
    flagship = contract.entry(spark)
    assert flagship.columns == ["month", "region", "monthly_revenue"]
    assert flagship.count() > 0
