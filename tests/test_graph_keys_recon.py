import pytest

from conftest import rows
from mapflow import ColumnSpec, ModelSpec, RunContext, TableRef
from mapflow.operators import choose_merge_key, duplicate_keys, reconcile, recon_counts, recon_empty_probe
from mapflow.plans import CycleError, Job, run_models, topo_order


def _m(target, source, kind="ref", mat="view", **kw):
    return ModelSpec(source=TableRef(source, kind), target=target,
                     columns=(ColumnSpec("X", "c_custkey" if kind == "source" else "X"),), materialization=mat, **kw)


def test_topo_order_and_cycles():
    a, b, c = _m("S.A", "customer", "source"), _m("S.B", "S.A"), _m("S.C", "S.B")
    assert [s.target for s in topo_order([c, b, a])] == ["S.A", "S.B", "S.C"]
    with pytest.raises(CycleError):
        topo_order([_m("S.A", "S.B"), _m("S.B", "S.A")])


def test_run_models_loads_and_refs(spark, registry, store):
    a = _m("S.A", "customer", "source", mat="truncate_load")
    b = _m("S.B", "S.A", where="X < 10")
    out = run_models([b, a], registry, store, RunContext())
    assert store.exists("S.A") and not store.exists("S.B")
    assert rows(out["S.B"]) == [(i,) for i in range(10)]


def test_job_steps_in_order():
    seen = []
    job = Job("j").add("build", lambda: seen.append("build")).add("merge", lambda: seen.append("merge"))
    job.run()
    assert seen == ["build", "merge"] and set(job.timings) == {"build", "merge"}


def test_choose_merge_key_rule_order():
    cols = ["OPCO_ID", "OPCO_CD", "NM"]
    assert choose_merge_key(cols, declared=["NM"]) == ["NM"]
    assert choose_merge_key(cols, sheet_key="A, B") == ["A", "B"]
    assert choose_merge_key(cols, declared=[""]) == ["OPCO_CD"]
    assert choose_merge_key(["OPCO_ID", "NM", "KEY"]) == ["OPCO_ID", "KEY"]
    assert choose_merge_key(["A", "B"], primary=["B"]) == ["B"]
    assert choose_merge_key(["A", "B"]) == ["A"]


def test_duplicate_keys_and_recon(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "K int, V string")
    assert rows(duplicate_keys(t, ["K"])) == sorted([(1, 2), (None, 2)], key=repr)
    s = spark.createDataFrame([(1, "a")], "K int, V string")
    assert rows(recon_counts(t, s)) == [(5, 1)]
    assert recon_empty_probe(t).count() == 0
    rep = reconcile(t, s)
    assert rep["target_count"] == 5 and rep["source_count"] == 1 and rep["readable"]
    assert len(rep["target_only_sample"]) == 4


def test_key_profile(spark):
    from mapflow.operators.keys import key_profile
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (None, "f")], "K int, V string")
    assert key_profile(t, ["K"]) == (6, 2)
    assert key_profile(t.where("K = 2 or K is null"), ["K"]) == (4, 1)
    assert key_profile(t.where("K > 5"), ["K"]) == (0, 0)


def test_with_merge_key_for_incremental_only():
    from mapflow.operators.keys import with_merge_key
    cols = (ColumnSpec("OPCO_ID", "OPCO_ID"), ColumnSpec("OPCO_CD", "OPCO_CD"), ColumnSpec("List (Y,N)", "Y"))
    inc = ModelSpec(source=TableRef("S"), target="DW.T", columns=cols, materialization="incremental")
    assert with_merge_key(inc).unique_key == ("OPCO_CD",)
    assert with_merge_key(inc.with_(unique_key=("OPCO_ID",))).unique_key == ("OPCO_ID",)
    assert with_merge_key(inc.with_(materialization="table")).unique_key == ()


def test_names_with_spaces_and_parentheses(spark, store):
    from mapflow import TableRegistry
    from mapflow.operators import build_delta, build_model, load_merge
    reg = TableRegistry(spark).register_source("S", spark.createDataFrame([(1, 2.0), (2, 3.0)], "k bigint, amt double"))
    spec = ModelSpec(source=TableRef("S"), target="DW.T", unique_key=("ID (NUM)",),
                     columns=(ColumnSpec("ID (NUM)", "k", "S"), ColumnSpec("AMT USD", "amt", "S"),
                              ColumnSpec("DATA_SRC", "'DW.T'")))
    built = build_model(spec, reg)
    assert built.columns == ["ID (NUM)", "AMT USD", "DATA_SRC"]
    load_merge(store, "DW.T", built.where("`ID (NUM)` = 1"), ["ID (NUM)"])
    delta = build_delta(spec.with_(delta=True), reg, store.read("DW.T"))
    assert rows(delta) == [("DW.T", 2, 3.0)]
    out = load_merge(store, "DW.T", delta, ["ID (NUM)"])
    assert rows(out) == [(1, 2.0, "DW.T"), (2, 3.0, "DW.T")]
    # a logic with a space is computed (outer); it may not reach source columns
    bad = spec.with_(delta=True, columns=spec.columns[:1] + (ColumnSpec("AMT USD", "amt * 2", "S"),))
    with pytest.raises(ValueError):
        build_delta(bad, reg, store.read("DW.T"))


PART_COLUMNS = (ColumnSpec("SEG_CD", "c_mktsegment", "customer"), ColumnSpec("CUST_NO", "c_custkey", "customer"),
                ColumnSpec("BAL", "c_acctbal", "customer"))


def _keyed(**kw):
    return ModelSpec(source=TableRef("customer"), target="DW.T", columns=PART_COLUMNS, materialization="incremental", **kw)


def test_key_cell_and_primary_key_reach_the_spec():
    cfg = {"Source": {"Schema": "S", "Table Name": "T"}, "UNIQUE_KEY": " A, B ,",
           "Target": {"Schema": "DW", "Table Name": "T", "materialization": "incremental", "primary_key": ["C", " "]},
           "Columns": [{"Target Column": "A"}]}
    spec = ModelSpec.from_config(cfg)
    assert (spec.unique_key, spec.sheet_key, spec.primary_key) == ((), ("A", "B"), ("C",))
    cfg["Target"]["unique_key"] = "K,L"
    assert ModelSpec.from_config(cfg).unique_key == ("K", "L")
    assert ModelSpec.from_config({**cfg, "UNIQUE_KEY": None}).sheet_key == ()


def test_runs_choose_keys_in_order(registry, store):
    from mapflow.plans.graph import merge_key
    assert merge_key(_keyed(), store)[0].unique_key == ("SEG_CD",)
    assert merge_key(_keyed(primary_key=("CUST_NO",)), store)[0].unique_key == ("SEG_CD",)  # a name rule comes first
    plain = _keyed(primary_key=("CUST_NO",)).with_(columns=PART_COLUMNS[1:])
    assert merge_key(plain, store)[0].unique_key == ("CUST_NO",)
    run_models([_keyed(unique_key=("CUST_NO",))], registry, store, RunContext())
    assert merge_key(_keyed(sheet_key=("SEG_CD",)), store)[0].unique_key == ("CUST_NO",)  # declared before, kept
    out = run_models([_keyed(sheet_key=("SEG_CD",), where="c_custkey < 10")], registry, store, RunContext())["DW.T"]
    assert out.count() == out.select("CUST_NO").distinct().count() == registry.source("customer").count()
    assert merge_key(_keyed(unique_key=("BAL",)), store)[0].unique_key == ("BAL",)  # a new declaration wins


def test_key_told_by_name_is_checked_on_the_table(registry, store, monkeypatch):
    from mapflow.operators import DuplicateKeyError, load_append
    from mapflow.plans import graph
    spec = _keyed(where="c_custkey < 3").with_(columns=(ColumnSpec("CUST_ID", "c_custkey", "customer"), PART_COLUMNS[2]))
    checked = []
    real = graph.assert_unique_keys
    monkeypatch.setattr(graph, "assert_unique_keys", lambda *a, **kw: (checked.append(1), real(*a, **kw)))
    run_models([spec], registry, store, RunContext())
    run_models([spec], registry, store, RunContext())
    assert not checked  # only merges by this key have written the table
    rows_now = store.read("DW.T")
    load_append(store, "DW.T", rows_now.where("CUST_ID = 1"))
    with pytest.raises(DuplicateKeyError, match="DW.T, whose key was chosen by name"):
        run_models([spec], registry, store, RunContext())
    assert checked
    # a declared key is the caller's word, and rows without a key never match
    assert run_models([spec.with_(unique_key=("CUST_ID",))], registry, store, RunContext())["DW.T"].count() == 4


def test_schema_profile_and_listing(spark, registry):
    from mapflow.sources import catalog_listing, schema_profile
    registry.register_source("OTHER.NATION", spark.createDataFrame([(None, "x"), (1, None)], "a int, `odd name` string"))
    registry.register_source("DB.TESTDATA.HIDDEN", spark.range(3).toDF("id"))
    all_of = schema_profile(registry, "TestData")
    assert [r[0] for r in all_of.select("TABLE_NAME").distinct().orderBy("TABLE_NAME").collect()] == \
        ["CUSTOMER", "EVENTS", "LINEITEM", "NATION", "ORDERS", "REGION", "SUPPLIER"]
    one = schema_profile(registry, "other", "nation").drop("TABLE_SCHEMA", "TABLE_NAME")
    assert [tuple(r) for r in one.collect()] == [(1, "a", 2, 1), (2, "odd name", 2, 1)]
    with pytest.raises(LookupError):
        schema_profile(registry, "other", "none")
    spark.sql("create schema if not exists listed")
    try:
        spark.sql("create or replace view listed.b_view as select 1 as z, 'q' as `a b`")
        spark.sql("create or replace view listed.a_view as select 1.5d as v")
        got = [tuple(r) for r in catalog_listing(spark, "listed").collect()]
        assert got == [("LISTED", "A_VIEW", 1, "v", "double"), ("LISTED", "B_VIEW", 1, "z", "int"), ("LISTED", "B_VIEW", 2, "a b", "string")]
        assert [r.COLUMN_NAME for r in catalog_listing(spark, "listed", "B_View").collect()] == ["z", "a b"]
        assert catalog_listing(spark, "listed", "none").count() == 0
    finally:
        spark.sql("drop schema listed cascade")
