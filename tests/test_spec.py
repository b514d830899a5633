import pytest

from mapflow import ModelSpec
from mapflow.spec import DEFAULT_UPDATE_EXCLUDE

# A mapping of our own over the driver tables: order facts with their customer.
CONFIG = {
    "Source": {"Type": "source", "Database": "LAKE", "Schema": "testdata", "Table Name": "orders", "Name": "testdata"},
    "Target": {"Schema": "MART", "Table Name": "F_ORDERS", "materialization": "incremental", "unique_key": ["ORDER_KEY"]},
    "Columns": [
        {"Target Column": "ORDER_KEY", "Source Table": "orders", "Logic": "o_orderkey"},
        {"Target Column": "AMOUNT", "Source Table": "orders", "Logic": "o_totalprice"},
        {"Target Column": "ORIGIN", "Source Table": "orders", "Logic": "'orders feed'"},
    ],
    "DAG": {"Type": "dataset_dependency", "Schedule": "30 2 * * 1-5",
            "Dependency Schema": ["MART", "MART"], "Dependency Object": ["D_CUSTOMER", "D_PART"]},
}


def test_from_config_shape():
    s = ModelSpec.from_config(CONFIG)
    assert s.source.kind == "source" and s.source.name == "LAKE.testdata.orders"
    assert s.target == "MART.F_ORDERS" and s.materialization == "incremental"
    assert s.unique_key == ("ORDER_KEY",)
    assert [c.target for c in s.columns] == ["ORDER_KEY", "AMOUNT", "ORIGIN"]
    assert s.depends_on == ("MART.D_CUSTOMER", "MART.D_PART")
    assert s.exclusions == DEFAULT_UPDATE_EXCLUDE
    assert s.refs() == ["MART.D_CUSTOMER", "MART.D_PART"]
    as_model = ModelSpec.from_config(dict(CONFIG, Source=dict(CONFIG["Source"], Type="ref")))
    assert as_model.source.name == "testdata.orders" and as_model.refs()[0] == "testdata.orders"


def test_join_rows_keep_the_source_name():
    row = {"Join Type": "LEFT", "Table Type": "source", "Source Name": "testdata", "Table Name": "customer", "Alias": "c",
           "Join Condition": "o_custkey = c.c_custkey"}
    s = ModelSpec.from_config(dict(CONFIG, Joins=[row, dict(row, **{"Table Type": "ref", "Table Name": "MART.D_PART", "Alias": "p"})]))
    assert [j.table.name for j in s.joins] == ["testdata.customer", "MART.D_PART"]


def test_group_by_text_is_a_list():
    s = ModelSpec.from_config(dict(CONFIG, **{"Group By": "main.o_custkey, coalesce(main.o_orderstatus, 'a,b')"}))
    assert s.group_by == ("main.o_custkey", "coalesce(main.o_orderstatus, 'a,b')")


def test_blank_key_is_no_key_and_excludes_replace():
    cfg = dict(CONFIG, Target=dict(CONFIG["Target"], unique_key=[""]), MERGE_UPDATE_EXCLUDE_COLUMNS=["AMOUNT"])
    s = ModelSpec.from_config(cfg)
    assert s.unique_key == ()
    assert s.exclusions == ("AMOUNT",)


def test_invalid_specs_rejected():
    with pytest.raises(ValueError):
        ModelSpec.from_config(CONFIG, target="NOSCHEMA")
    with pytest.raises(ValueError):
        ModelSpec.from_config(CONFIG, materialization="weird")
    with pytest.raises(ValueError):
        ModelSpec.from_config(CONFIG, delta=True, group_by=("ORDER_KEY",))


def test_config_shape_runs_end_to_end(spark, registry):
    """A workbook-shaped config with joins, where and group by becomes one plan."""
    from conftest import rows
    from mapflow.operators import build_model
    cfg = {
        "Source": {"Type": "source", "Schema": "testdata", "Table Name": "orders"},
        "Target": {"Schema": "DW", "Table Name": "A_NATION_ORDERS", "materialization": "table"},
        "Columns": [
            {"Target Column": "NATION_NM", "Source Table": "nation", "Logic": "n.n_name"},
            {"Target Column": "ORDER_CNT", "Source Table": "orders", "Logic": "count(*)"},
            {"Target Column": "MAX_AMT", "Source Table": "orders", "Logic": "max(main.o_totalprice)"},
        ],
        "Joins": [
            {"Join Type": "INNER", "Table Type": "source", "Table Name": "customer", "Alias": "c",
             "Join Condition": "o_custkey = c.c_custkey"},
            {"Join Type": "LEFT", "Table Type": "source", "Table Name": "nation", "Alias": "n",
             "Join Condition": "c.c_nationkey = n.n_nationkey"},
        ],
        "Where": "main.o_orderstatus = 'F'",
        "Group By": ["n.n_name"],
    }
    got = rows(build_model(ModelSpec.from_config(cfg), registry))
    want = rows(spark.sql(
        "select n.n_name, count(*), max(o.o_totalprice) from parquet.`/root/testdata/sf0.001/orders.parquet` o "
        "join parquet.`/root/testdata/sf0.001/customer.parquet` c on o.o_custkey = c.c_custkey "
        "left join parquet.`/root/testdata/sf0.001/nation.parquet` n on c.c_nationkey = n.n_nationkey "
        "where o.o_orderstatus = 'F' group by n.n_name"))
    assert got == want and len(got) > 5


def test_dependencies_are_pairs_and_empty_is_root():
    bad = dict(CONFIG, DAG={"Dependency Schema": ["a", "b"], "Dependency Object": ["t1"]})
    with pytest.raises(ValueError):
        ModelSpec.from_config(bad)
    assert ModelSpec.from_config(dict(CONFIG, DAG={})).depends_on == ()
