"""Every registered query against its SQL text; those without one must return rows."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, sf, con, name):
    assert differences(contract.queries()[name](spark, sf), con, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_has_rows(spark, sf, name):
    assert contract.queries()[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark):
    assert contract.entry(spark).count() == 24
