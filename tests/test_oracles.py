"""Every sales query against its SQL twin, on the smallest tables; optional queries have tests of their own."""

import pytest

import __spark_entry__ as contract
import check
from orderweir.plans.oracles import ORACLES
from orderweir.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return check.connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, folder, name):
    good, note = check.compare(spark, duck, name, folder)
    assert good, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
