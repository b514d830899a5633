"""Every registered query against its DuckDB oracle SQL (the driver's gate), at sf0.01."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from tools.oracle_check import compare

NAMES = sorted(E._QUERIES)


def test_every_query_has_oracle_sql():
    assert set(E._ORACLE) == set(E._QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF01, [name])[name]
    assert res.get("ok") is True, res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["CUST_ID", "CUST_NM"]
