"""Every query on trips against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import oracle_rows, spark_rows
from checks.queries import ORACLES, QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, sf_dir, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    want = oracle_rows(sf_dir, ORACLES[name])
    assert got == want
    assert got[1]
