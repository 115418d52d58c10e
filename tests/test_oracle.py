import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_text_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, small, name):
    problem, _, _ = compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], small)
    assert problem is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 5
