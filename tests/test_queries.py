"""Every registered query against its SQL, on the small tables."""

import pytest

import __spark_entry__ as entry_module
from candlewick.plans.catalogue import REGISTRY
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(spark, con, REGISTRY[name], sf_dir) == []


def test_entry_contract(spark):
    df = entry_module.entry(spark)
    assert df.columns[:2] == ["ticker", "date"]
    assert df.count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
