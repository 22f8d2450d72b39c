"""All queries on tables with a frequent key and repeated rows, and with NULLs."""

import pytest
from conftest import DATA
from oracle import connect, differences
from variants import build

import __spark_entry__ as contract
from quern.plans.registry import REGISTRY


@pytest.fixture(scope="module", params=["hot", "nulls"])
def variant(request, tmp_path_factory):
    folder = build(DATA, str(tmp_path_factory.mktemp(request.param)), request.param)
    return folder, connect(folder)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, variant, name):
    folder, con = variant
    found = differences(contract.queries()[name](spark, folder), con, contract.oracle_sql()[name])
    assert [f for f in found if f != "no rows"] == []
