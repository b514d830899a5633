"""Versions: atomic switches, lost-update protection, retention, buckets, sequences in loads."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from mapflow import ColumnSpec, ModelSpec, TableRef, TableRegistry, TableStore
from mapflow.operators import load_append, load_insert_by_name, load_merge, load_truncate, materialize
from mapflow.plans import run_models, spec_job
from mapflow.session import scratch_dir
from mapflow.sources import CommitConflict

SCHEMA = "K bigint, NM string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_a_second_writer_on_the_same_base_fails_and_loses_nothing(spark, store):
    store.overwrite("DW.T", frame(spark, (1, "a"), (2, "b")))
    base = store.snapshot("DW.T")
    load_merge(store, "DW.T", frame(spark, (1, "A")), ["K"])  # commits in between
    before = set(os.listdir(store._table_dir("DW.T").removeprefix("file:")))
    with pytest.raises(CommitConflict):
        store.overwrite("DW.T", frame(spark, (2, "B")), base=base)
    with pytest.raises(CommitConflict):
        store.append("DW.T", frame(spark, (3, "c")), base=base)
    assert rows(store.read("DW.T")) == [(1, "A"), (2, "b")]
    assert set(os.listdir(store._table_dir("DW.T").removeprefix("file:"))) == before  # nothing left behind


def test_two_creations_of_one_table_conflict(spark, store, monkeypatch):
    real = store._write

    def slow(df, *args, **options):
        if not store.exists("DW.N"):
            monkeypatch.setattr(store, "_write", real)
            store.overwrite("DW.N", frame(spark, (9, "other")))
        return real(df, *args, **options)

    monkeypatch.setattr(store, "_write", slow)
    with pytest.raises(CommitConflict):
        store.overwrite("DW.N", frame(spark, (1, "a")))
    assert rows(store.read("DW.N")) == [(9, "other")]


def test_an_append_that_fails_shows_nothing(spark, store):
    store.overwrite("DW.T", frame(spark, (1, "a")))
    bad = frame(spark, (2, "b"), (3, "c")).withColumn("NM", F.expr("if(K = 3, raise_error('stop'), NM)"))
    with pytest.raises(Exception, match="stop"):
        store.append("DW.T", bad)
    assert rows(store.read("DW.T")) == [(1, "a")] and store.version("DW.T") == 1
    store.append("DW.T", frame(spark, (2, "b")))
    assert rows(store.read("DW.T")) == [(1, "a"), (2, "b")]


def test_an_unfinished_commit_is_no_version(spark, store):
    store.overwrite("DW.T", frame(spark, (1, "a")))
    folder = store._table_dir("DW.T").removeprefix("file:")
    frame(spark, (9, "z")).write.parquet(f"{folder}/data-unfinished")
    with open(f"{folder}/_committing-x", "w") as f:
        f.write('{"version": 2')
    assert rows(store.read("DW.T")) == [(1, "a")]
    store.overwrite("DW.T", frame(spark, (3, "c")))
    assert store.version("DW.T") == 2 and rows(store.read("DW.T")) == [(3, "c")]


def test_many_merges_leave_few_versions(spark):
    store = TableStore(spark, scratch_dir(spark, "keep"), keep_versions=2)
    for i in range(6):
        load_merge(store, "DW.T", frame(spark, (i, str(i)), (0, f"r{i}")) if i else frame(spark, (0, "r0")), ["K"], buckets=4)
    folder = store._table_dir("DW.T").removeprefix("file:")
    names = os.listdir(folder)
    versions = sorted(n for n in names if n.startswith("version-"))
    assert len(versions) == 2
    listed = {p["folder"] for v in versions for p in json.load(open(f"{folder}/{v}"))["parts"]}
    assert {n for n in names if n.startswith("data-")} == listed
    assert store.read("DW.T").count() == 6
    placed = f"{store._table_dir('DW.T')}/data-"
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith("mapflow_v_")]
    here = [r.data_type for t in tables for r in spark.sql(f"describe extended {t}").collect() if r.col_name == "Location"]
    assert len([p for p in here if placed.removeprefix("file:") in p]) <= len(listed)


def test_bucketing_changes_with_the_version(spark, store):
    for keys, n in ((["K"], 8), (["K"], 4), (["NM"], 16)):
        store.overwrite("DW.T", frame(spark, (1, "a")), (keys, n))
        assert store.bucketing("DW.T") == (keys, n)


def test_a_merge_rewrites_only_the_buckets_its_batch_touches(spark, store):
    rows_in = spark.range(4000).select(F.col("id").alias("K"), F.col("id").cast("string").alias("NM"))
    load_truncate(store, "DW.T", rows_in, bucket_by=(["K"], 16))
    first = store.snapshot("DW.T").parts[0]
    out = load_merge(store, "DW.T", frame(spark, (5, "five"), (70_000, "new")), ["K"])
    snap = store.snapshot("DW.T")
    assert snap.parts[0].folder == first.folder and len(snap.parts) == 2
    touched = set(snap.parts[1].buckets)
    assert len(touched) <= 2 and set(snap.parts[0].buckets) == set(range(16)) - touched
    written = store._bucket_files(f"{store._table_dir('DW.T')}/{snap.parts[1].folder}")
    assert set(written) <= touched
    got = {r.K: r.NM for r in out.collect()}
    assert len(got) == 4001 and got[5] == "five" and got[70_000] == "new" and got[6] == "6"
    again = load_merge(store, "DW.T", frame(spark, (5, "5th")), ["K"])
    assert again.where("K = 5").collect()[0].NM == "5th" and again.count() == 4001
    wide = load_merge(store, "DW.T", rows_in.withColumn("NM", F.lit("all")), ["K"])  # touches all: one part again
    assert len(store.snapshot("DW.T").parts) == 1 and wide.where("NM = 'all'").count() == 4000 and wide.count() == 4001
    store.append("DW.T", frame(spark, (80_000, "x")))
    assert load_merge(store, "DW.T", frame(spark, (80_000, "y")), ["K"]).where("K = 80000").collect()[0].NM == "y"


def _sequence_spec(load, **more):
    cols = (ColumnSpec("SK", "DW.SEQ.NEXTVAL", "S"), ColumnSpec("K", "k", "S"), ColumnSpec("NM", "nm", "S"))
    return ModelSpec(source=TableRef("S"), target="DW.T", columns=cols, unique_key=("K",), materialization=load, **more)


def test_a_merge_numbers_inserted_rows_only(spark, store):
    store.overwrite("DW.T", spark.createDataFrame([(7, 1, "a"), (9, 2, "b")], "SK bigint, K bigint, NM string"))
    reg = TableRegistry(spark, store).register_source("S", spark.createDataFrame([(2, "B"), (4, "d"), (3, "c")], "k bigint, nm string"))
    out = run_models([_sequence_spec("incremental")], reg, store)["DW.T"]
    assert sorted(rows(out, "SK", "K", "NM")) == [(7, 1, "a"), (9, 2, "B"), (10, 3, "c"), (11, 4, "d")]
    again = run_models([_sequence_spec("incremental")], reg, store)["DW.T"]
    assert sorted(rows(again, "SK", "K", "NM")) == [(7, 1, "a"), (9, 2, "B"), (10, 3, "c"), (11, 4, "d")]


@pytest.mark.parametrize("load", ["insert", "incremental", "truncate_load"])
def test_every_load_fills_a_sequence(spark, store, load):
    if load == "insert":
        store.overwrite("DW.T", spark.createDataFrame([], "SK bigint, K bigint, NM string"))
    reg = TableRegistry(spark, store).register_source("S", spark.createDataFrame([(2, "b"), (1, "a")], "k bigint, nm string"))
    out = run_models([_sequence_spec(load)], reg, store)["DW.T"]
    assert rows(out, "SK", "K", "NM") == [(1, 1, "a"), (2, 2, "b")]


def test_sequence_over_map_columns_and_nothing_left_staged(spark, store):
    df = spark.range(5).select(F.col("id").alias("K"), F.create_map(F.lit("x"), F.col("id")).alias("M"))
    load_append(store, "DW.M", df, "SK", ["K"])
    out = load_append(store, "DW.M", df, "SK", ["K"])
    assert sorted(r.SK for r in out.collect()) == list(range(1, 11))
    root = store.root.removeprefix("file:").rsplit("/", 1)[0]
    assert not [n for n in os.listdir(root) if n.startswith(("surrogate-", "stage-")) and os.listdir(f"{root}/{n}") == []]


def test_insert_from_a_spec_with_join_filter_and_grouping(spark, registry, store):
    store.overwrite("DW.A", spark.createDataFrame([("old", 1, None)], "SEG string, N bigint, EXTRA string"))
    cfg = {
        "Source": {"Type": "source", "Schema": "testdata", "Table Name": "orders"},
        "Target": {"Schema": "DW", "Table Name": "A", "materialization": "insert"},
        "Columns": [{"Target Column": "N", "Source Table": "orders", "Logic": "count(*)"},
                    {"Target Column": "SEG", "Source Table": "customer", "Logic": "c.c_mktsegment"}],
        "Joins": [{"Join Type": "INNER", "Table Type": "source", "Source Name": "testdata", "Table Name": "customer", "Alias": "c",
                   "Join Condition": "o_custkey = c.c_custkey"}],
        "Where": "main.o_orderstatus = 'F'", "Group By": "c.c_mktsegment, c.c_mktsegment",
    }
    out = run_models([ModelSpec.from_config(cfg)], registry, store)["DW.A"]
    assert out.count() > 2 and out.where("SEG = 'old'").count() == 1 and out.where("EXTRA is not null").count() == 0


def test_job_steps_run_build_then_merge_then_insert(spark, store):
    reg = TableRegistry(spark, store).register_source("S", spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, nm string"))
    spec = ModelSpec(source=TableRef("S"), target="DW.J", unique_key=("K",), materialization="truncate_load",
                     columns=(ColumnSpec("K", "k", "S"), ColumnSpec("NM", "nm", "S")))
    job = spec_job(spec, reg, store)
    assert [n for n, _ in job.steps] == ["build", "merge", "insert"]
    job.run()
    assert rows(store.read("DW.J")) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert [n for n, _ in spec_job(spec, reg, store, steps=("insert", "build")).steps] == ["build", "insert"]


def test_a_keyless_incremental_model_gets_its_key(spark, store):
    reg = TableRegistry(spark, store).register_source("S", spark.createDataFrame([(1, "a")], "k bigint, nm string"))
    spec = ModelSpec(source=TableRef("S"), target="DW.K", materialization="incremental",
                     columns=(ColumnSpec("NM", "nm", "S"), ColumnSpec("ITEM_ID", "k", "S")))
    run_models([spec], reg, store)
    assert rows(run_models([spec], reg, store)["DW.K"], "ITEM_ID", "NM") == [(1, "a")]


def test_names_never_lose_their_schema(spark):
    reg = TableRegistry(spark).register_source("orders", spark.range(1)).register_source("LND.orders", spark.range(2))
    assert reg.source("ORDERS").count() == 1 and reg.source("lnd.orders").count() == 2
    assert reg.source("PROD.LND.ORDERS").count() == 2
    with pytest.raises(Exception):
        reg.source("OTHERDB.OTHER.ORDERS")


def test_insert_needs_its_table(spark, store):
    with pytest.raises(LookupError):
        load_insert_by_name(store, "DW.NONE", frame(spark, (1, "a")))
    with pytest.raises(ValueError):
        materialize(ModelSpec(source=TableRef("S"), target="DW.V", columns=(), materialization="view"), frame(spark), store)
