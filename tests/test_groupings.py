"""Grouping cells, conditions on groups, derived expressions and key discovery."""

import pytest

from conftest import rows
from mapflow import ColumnSpec, ModelSpec, TableRef, TableRegistry
from mapflow.operators import build_model, discover_keys
from mapflow.spec import parse_grouping


def test_grouping_cells():
    assert parse_grouping("a, coalesce(b, 1)") == (("a", "coalesce(b, 1)"), "plain", ())
    assert parse_grouping("ROLLUP(a, b)") == (("a", "b"), "rollup", ())
    assert parse_grouping("cube ( a,b )") == (("a", "b"), "cube", ())
    assert parse_grouping("Grouping Sets ((a, f(b, c)), a, ())") == (("a", "f(b, c)"), "sets", (("a", "f(b, c)"), ("a",), ()))
    with pytest.raises(ValueError):
        ModelSpec(source=TableRef("S"), target="D.T", columns=(), group_by=("a",), grouping="sets", grouping_sets=(("b",),))
    with pytest.raises(ValueError):
        ModelSpec(source=TableRef("S"), target="D.T", columns=(), having="count(*) > 1")


def test_sets_with_nulls_and_having(spark):
    reg = TableRegistry(spark).register_source("S", spark.createDataFrame(
        [("a", "x", 1), ("a", None, 2), ("b", "x", 3), (None, "x", 4)], "A string, B string, N int"))
    spec = ModelSpec(source=TableRef("S"), target="DW.T", group_by=("A", "B"), grouping="sets", grouping_sets=(("A", "B"), ("A",), ()),
                     having="sum(main.N) > 2", columns=(ColumnSpec("A", "A"), ColumnSpec("G", "grouping_id()"), ColumnSpec("N", "sum(N)")))
    assert rows(build_model(spec, reg)) == sorted([("b", 0, 3), (None, 0, 4), ("a", 1, 3), ("b", 1, 3), (None, 1, 4), (None, 3, 10)], key=repr)


def test_derived_expressions_are_computed_once(spark):
    reg = TableRegistry(spark).register_source("S", spark.createDataFrame(
        [(1, '{"a": {"b": 7}, "c": [1, 2]}'), (2, "no json"), (3, None)], "ID int, J string"))
    spec = ModelSpec(source=TableRef("S"), target="DW.T", derived=(("p", "try_parse_json(main.J)"),), columns=(
        ColumnSpec("ID", "ID"), ColumnSpec("B", "try_variant_get(p, '$.a.b', 'int')"), ColumnSpec("C1", "try_variant_get(p, '$.c[1]', 'int')")))
    out = build_model(spec, reg)
    assert rows(out) == [(1, 7, 2), (2, None, None), (3, None, None)]
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("parse_json") + \
        out._jdf.queryExecution().optimizedPlan().toString().count("parseJson") <= 2  # one call, as Spark prints it


def test_key_discovery(spark):
    df = spark.range(2000).selectExpr("id div 4 as a", "id % 4 as b", "id % 3 as c", "if(id = 5, null, id) as d", "id * 3 as e", "'k' as f")
    assert discover_keys(df) == [["e"], ["a", "b"]]
    assert discover_keys(df, ["b", "c", "f"]) == []
    assert discover_keys(df, ["a", "c", "b"], max_size=1) == []
    three = spark.range(1000).selectExpr("id div 100 as x", "id div 10 % 10 as y", "id % 10 as z", "0 as w")
    assert discover_keys(three) == [["x", "y", "z"]]
    assert discover_keys(df.where("a < 0")) == [] and discover_keys(df.union(df)) == []
