"""Every named query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from flightlens.plans import catalog
from tests.conftest import SF_DIR
from tests.parity import connect, differences, rows_of, sql_rows

#: Queries without SQL are held against brute force by tests of their own.
NAMES = list(contract.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(NAMES) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    got = rows_of(contract.queries()[name](spark, SF_DIR))
    assert differences(got, sql_rows(duck, contract.oracle_sql()[name])) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
