"""Registered text queries against their DuckDB SQL, and the registration itself."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from mapflow.llm.queries import ORACLE_SQL, QUERIES
from tools.oracle_check import compare


def test_all_are_registered():
    names = set(E.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    res = compare(spark, SF01, [name])[name]
    assert res.get("ok") is True, res
