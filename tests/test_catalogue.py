"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle import mismatch, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_matches_oracle(spark, con, name):
    assert mismatch(spark, con, SF, name) is None


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows_and_fixed_schema(spark):
    df = contract.entry(spark)
    assert df.columns[:5] == ["ProductId", "BranchId", "CountryCode", "Currency", "EffectiveDate"]
    assert df.columns[5:7] == ["p10_Day2", "p10_Day3"] and df.columns[-1] == "p90_Day10"
    assert df.count() == 30
