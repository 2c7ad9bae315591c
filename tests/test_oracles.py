"""Every registered query against its SQL on the small tables."""

import pytest
from check_oracle import compare

from fieldloom.catalog import ORACLES, QUERIES


#: at this size no treated field has enough controls; tools/check_oracle.py covers them at 0.01
EMPTY = {"a11_did_summary", "a17_tercile_effect", "e2_did", "e5_did_lat_lon", "e5_did_lat_lon_all_crops",
         "e6_tercile", "e7_subregion_did"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(name, spark, con, sf):
    diff = compare(spark, con, QUERIES[name], ORACLES.get(name), sf)
    assert diff == "" or diff == "EMPTY" and name in EMPTY, diff


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    assert entry(spark).columns == ["wind", "fields", "mean_delta", "mean_ctrl", "did", "did_se", "label"]
    assert set(oracle_sql()) <= set(queries())
