"""Queries against their SQL on the small tables."""

import pytest
from check_oracle import compare, duck

from fieldloom.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(name, spark):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf), QUERIES[name], ORACLES[name], sf) == ""


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
