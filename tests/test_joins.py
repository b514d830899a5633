import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from mapflow import ColumnSpec, JoinSpec, ModelSpec, RunContext, TableRef, TableRegistry
from mapflow.operators import build_model
from mapflow.operators.join import JoinError, apply_join, spark_join_type


def _reg(spark):
    reg = TableRegistry(spark)
    reg.register_source("S", spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "ID bigint, V int"))
    reg.register_source("J", spark.createDataFrame([(1, "x"), (4, "y")], "ID bigint, NM string"))
    return reg


def _spec(how, cond, cols=None):
    cols = cols or (ColumnSpec("ID", "ID", "S"), ColumnSpec("NM", "j.NM", "J"))
    return ModelSpec(source=TableRef("S"), target="DW.T", columns=cols,
                     joins=(JoinSpec(how, TableRef("J", "source"), "j", cond),))


def test_join_words():
    assert spark_join_type("left") == "left" and spark_join_type(" full  outer ") == "full_outer"
    assert spark_join_type("RIGHT") == "right" and spark_join_type("INNER") == "inner"
    with pytest.raises(JoinError):
        spark_join_type("CROSS")
    with pytest.raises(JoinError):
        spark_join_type("SIDEWAYS")


def test_bare_column_on_both_sides_means_main(spark):
    # ID exists on both sides; the bare left-hand name belongs to the main relation
    out = build_model(_spec("LEFT", "ID = j.ID"), _reg(spark), RunContext())
    assert rows(out) == [(1, "x"), (2, None), (3, None)]


def test_right_and_full(spark):
    cols = (ColumnSpec("SID", "source.ID", "S"), ColumnSpec("JID", "j.ID", "J"))
    assert rows(build_model(_spec("RIGHT", "source.ID = j.ID", cols), _reg(spark))) == [(1, 1), (None, 4)]
    assert rows(build_model(_spec("FULL", "source.ID = j.ID", cols), _reg(spark))) == sorted(
        [(1, 1), (2, None), (3, None), (None, 4)], key=repr)


def test_no_condition_refused(spark):
    with pytest.raises(JoinError):
        build_model(_spec("LEFT", None), _reg(spark))


def test_range_over_a_lookup_loops_and_beyond_is_joined_by_rank(spark, registry):
    reg = _reg(spark)
    spec = _spec("LEFT", "source.V > j.ID * 10")
    out = build_model(spec, reg)
    assert rows(out) == [(1, None), (2, "x"), (3, "x")]
    assert "BroadcastNestedLoopJoin" in plan_text(out)
    left, right = reg.source("S").alias("source"), spark.range(5000).selectExpr("id * 1000 as ID", "string(id) as NM")
    out = apply_join(left, right, spec.joins[0])
    assert "NestedLoop" not in plan_text(out) and "Cartesian" not in plan_text(out)
    assert rows(out, "V", "NM") == [(10, "0"), (20, "0"), (30, "0")]


def test_conditions_without_equality_or_range_need_a_bounded_side(spark, registry):
    orders = registry.source("orders")
    for cond in ("source.o_orderkey <> j.o_custkey", "source.o_comment like j.o_comment", "source.o_orderkey + j.o_custkey > 7"):
        with pytest.raises(JoinError):
            apply_join(orders.withColumn("o_comment", F.lit("x")).alias("source"), orders.withColumn("o_comment", F.lit("x")),
                       JoinSpec("LEFT", TableRef("orders"), "j", cond), theta_max_bytes=1000)


@pytest.mark.parametrize("how", ["INNER", "LEFT", "RIGHT", "FULL"])
@pytest.mark.parametrize("cond", ["upper(source.NM) = j.NM", "source.ID = cast(j.NM as bigint)", "trim(source.NM) = j.NM and j.ID > 3"])
def test_equality_of_expressions_is_an_equi_join(spark, how, cond):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reg = TableRegistry(spark)
        for name in ("S", "J"):
            reg.register_source(name, spark.range(20_000).selectExpr("id as ID", "cast(id as string) as NM"))
        out = build_model(_spec(how, cond, (ColumnSpec("A", "source.ID", "S"), ColumnSpec("B", "j.ID", "J"))), reg)
        text = plan_text(out)
        assert "NestedLoop" not in text and "CartesianProduct" not in text
        want = reg.source("S").alias("source").join(reg.source("J").alias("j"), F.expr(cond), spark_join_type(how))
        assert rows(out) == rows(want.select(F.col("source.ID").alias("A"), F.col("j.ID").alias("B")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_or_that_makes_a_product_is_refused(spark, registry):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cond = "source.o_custkey = j.o_custkey and j.o_custkey > 5 or source.o_orderkey > 290"
        with pytest.raises(JoinError):
            apply_join(registry.source("orders").alias("source"), registry.source("orders"),
                       JoinSpec("INNER", TableRef("orders"), "j", cond), theta_max_bytes=1000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_outer_joins_are_split_by_default(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reg = _reg(spark)
        cols = (ColumnSpec("SID", "source.ID", "S"), ColumnSpec("JID", "j.ID", "J"))
        for how, anti in (("LEFT", 1), ("RIGHT", 1), ("FULL", 2)):
            text = plan_text(build_model(_spec(how, "source.ID = j.ID", cols), reg))
            assert text.count("Join type: LeftAnti") == anti and "FullOuter" not in text and "RightOuter" not in text, how
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filter_pushed_to_scan(spark, registry):
    spec = ModelSpec(source=TableRef("orders"), target="DW.F",
                     columns=(ColumnSpec("ID", "o_orderkey", "orders"), ColumnSpec("NM", "c.c_name", "customer")),
                     joins=(JoinSpec("INNER", TableRef("customer"), "c", "source.o_custkey = c.c_custkey"),),
                     where="main.o_orderstatus = 'F'")
    txt = plan_text(build_model(spec, registry))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in txt
    # only the used columns are read
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in txt


@pytest.mark.parametrize("how", ["LEFT", "RIGHT", "FULL"])
@pytest.mark.parametrize("extra", ["", " and j.W < 50"])
def test_split_outer_join_equals_outer_join(spark, how, extra):
    from pyspark.sql import functions as F
    reg = TableRegistry(spark)
    # a third of the right rows share key 1, both sides carry NULL keys
    left = spark.range(60).select(F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 20).alias("ID"),
                                  F.col("id").alias("V"))
    right = spark.range(90).select(F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") == 5, None)
                                   .otherwise(F.col("id")).alias("ID"), F.col("id").alias("W"))
    reg.register_source("S", left).register_source("J", right)
    cols = (ColumnSpec("SID", "source.ID", "S"), ColumnSpec("V", "source.V", "S"),
            ColumnSpec("JID", "j.ID", "J"), ColumnSpec("W", "j.W", "J"))

    def spec(skew):
        return ModelSpec(source=TableRef("S"), target="DW.T", columns=cols,
                         joins=(JoinSpec(how, TableRef("J", "source"), "j", "source.ID = j.ID" + extra, skew),))
    want = rows(build_model(spec("auto"), reg))
    got = build_model(spec("split"), reg)
    assert rows(got) == want and len(want) > 60
    assert "FullOuter" not in plan_text(got) and "RightOuter" not in plan_text(got)


def test_cube_contract_ansi_and_concat_null(spark):
    from pyspark.sql import types as T
    reg = TableRegistry(spark).register_source(
        "S", spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", None, 3)], "A string, B string, N int"))
    cube = ModelSpec(source=TableRef("S"), target="DW.T", grouping="cube", group_by=("A", "B"),
                     columns=(ColumnSpec("A", "A"), ColumnSpec("B", "B"), ColumnSpec("TOT", "sum(N)"),
                              ColumnSpec("AB", "A || '-' || B")), )
    got = rows(build_model(cube, reg))  # AB is computed from grouping columns only
    assert (None, None, 6, None) in got and ("a", None, 3, None) in got and ("a", "x", 1, "a-x") in got
    assert len(got) == 9
    concat = ModelSpec(source=TableRef("S"), target="DW.T", columns=(ColumnSpec("AB", "A || '-' || B"),))
    assert sorted(rows(build_model(concat, reg)), key=repr) == sorted([("a-x",), ("a-y",), (None,)], key=repr)
    contract = T.StructType([T.StructField("A", T.IntegerType())])
    bad = ModelSpec(source=TableRef("S"), target="DW.T", columns=(ColumnSpec("A", "A"),), contract=contract)
    with pytest.raises(Exception):
        build_model(bad, reg).collect()  # ANSI cast of 'a' to int fails instead of loading NULL
