"""Every registered query against its SQL on the same files."""

import pytest
from conftest import DATA
from oracle import connect, differences

import __spark_entry__ as contract
from quern.plans.registry import REGISTRY

# Their keys lie beyond the smallest data set.
EMPTY_HERE = {
    "filter_point", "filter_expr", "filter_sargable", "hidden_aggs", "customers_from",
    "product_as_of", "union_all", "union_distinct", "having_count", "reject_ratio",
}


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    found = differences(contract.queries()[name](spark, DATA), con, contract.oracle_sql()[name])
    if name in EMPTY_HERE:
        found = [f for f in found if f != "no rows"]
    assert found == []


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(contract.queries()) & set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "o_orderkey" and df.count() > 0


@pytest.mark.parametrize("name", ["dense_id", "order_lines", "agg_view_delta", "xe_shred"])
def test_second_run_is_the_same(spark, name):
    first, second = (contract.queries()[name](spark, DATA) for _ in range(2))
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
