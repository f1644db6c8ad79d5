"""The registered queries of the subpackage against their SQL on the smallest tables."""

import pytest

from checks.compare import oracle_rows, spark_rows
from odflow.llm.queries import ORACLES, QUERIES


def test_queries_without_sql():
    """These are tested against brute-force versions, round trips and held-out accuracy instead."""
    assert set(QUERIES) - set(ORACLES) == {
        "op3_language_id", "op7_mix_sources", "op8_sentencepiece", "op9_quality_model", "op12_whitening", "op13_order_minhash",
        "pipeline"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_oracle(spark, sf_dir, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    want = oracle_rows(sf_dir, ORACLES[name])
    assert got == want
    assert got[1]
