"""Partition-wise loads: touched partitions only, replays, odd partition values; streams into them."""

import os
import re

import pytest

from conftest import plan_text, rows
from mapflow.session import scratch_dir
from mapflow.operators.keys import DuplicateKeyError
from mapflow.sources.partitions import NAMED, PartitionedTable
from mapflow.streaming import stream_partitions

SCHEMA = "K bigint, V string, P string, CREATE_BY string"


def table(spark, data, by=("P",)):
    t = PartitionedTable(spark, scratch_dir(spark, "t-partitions"), by)
    t.replace(spark.createDataFrame(data, SCHEMA))
    return t


def files(t):
    root = t.path.removeprefix("file:")
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and "_mapflow" not in d}


def test_merge_touches_only_its_partitions(spark):
    t = table(spark, [(1, "a", "01", "old"), (2, "b", "02", "old"), (3, "c", None, "old"), (None, "n", "01", "old")])
    before = files(t)
    t.merge(spark.createDataFrame([(1, "A", "01", "new"), (9, "z", "03", "new"), (3, "C", None, "new")], SCHEMA), ["K", "P"])
    # A NULL in the key matches nothing: the row of the NULL partition is added, none is lost.
    assert rows(t.read()) == sorted([(1, "A", "01", "old"), (None, "n", "01", "old"), (2, "b", "02", "old"), (9, "z", "03", "new"),
                                     (3, "c", None, "old"), (3, "C", None, "new")], key=repr)
    kept = before & files(t)
    assert kept and all("P=02" in f for f in kept)
    assert dict(t.read().dtypes)["P"] == "string"  # not the number its folders look like
    plan = plan_text(t.touched(spark.createDataFrame([(1, "x", "02", "y")], SCHEMA)))
    assert re.search(r"PartitionFilters: \[.*P#\d+ = 02", plan), plan


def test_guards(spark):
    t = table(spark, [(1, "a", "x", "o")])
    with pytest.raises(ValueError, match="not in the key"):
        t.merge(spark.createDataFrame([(1, "a", "x", "o")], SCHEMA), ["K"])
    with pytest.raises(DuplicateKeyError):
        t.merge(spark.createDataFrame([(1, "a", "x", "o")] * 2, SCHEMA), ["K", "P"])
    with pytest.raises(ValueError):
        PartitionedTable(spark, "x", [])
    t.merge(spark.createDataFrame([], SCHEMA), ["K", "P"])
    t.append(spark.createDataFrame([(1, "b", "x", "o")], SCHEMA))
    assert rows(t.read()) == [(1, "a", "x", "o"), (1, "b", "x", "o")]


def test_a_batch_that_failed_while_files_moved_is_finished_from_its_staged_rows(spark, monkeypatch):
    t = table(spark, [(1, "a", "x", "o")])
    batch = spark.createDataFrame([(2, "b", "x", "n"), (None, "n", "y", "n")], SCHEMA)
    replace = PartitionedTable.replace

    def broken(self, df):
        replace(self, df)
        raise OSError("lost")

    monkeypatch.setattr(PartitionedTable, "replace", broken)
    with pytest.raises(OSError):
        t.merge(batch, ["K", "P"], tag="q-0")
    monkeypatch.setattr(PartitionedTable, "replace", replace)
    for _ in range(2):  # the second time it is known to be done
        t.merge(batch, ["K", "P"], tag="q-0")
    assert rows(t.read()) == sorted([(1, "a", "x", "o"), (2, "b", "x", "n"), (None, "n", "y", "n")], key=repr)


def test_two_columns_and_more_partitions_than_are_named(spark):
    t = PartitionedTable(spark, scratch_dir(spark, "t-partitions"), ["A", "B"])
    t.replace(spark.range(40).selectExpr("id as K", "id % 4 as A", "if(id % 3 = 0, null, id % 3) as B", "0 as N"))
    batch = spark.range(40).where("id % 4 < 2").selectExpr("id as K", "id % 4 as A", "if(id % 3 = 0, null, id % 3) as B", "1 as N")
    want = sorted([(i, i % 4, i % 3 or None, int(i % 4 < 2 and i % 3 > 0)) for i in range(40)]
                  + [(i, i % 4, None, 1) for i in range(40) if i % 4 < 2 and i % 3 == 0], key=repr)
    t.merge(batch, ["K", "A", "B"])
    assert rows(t.read()) == want
    import mapflow.sources.partitions as module
    named, module.NAMED = module.NAMED, 2
    try:
        t.merge(batch.where("B is not null"), ["K", "A", "B"])
    finally:
        module.NAMED = named
    assert rows(t.read()) == want and NAMED == named


def test_stream_into_partitions(spark):
    landing, ckpt = scratch_dir(spark, "t-land-p"), scratch_dir(spark, "t-ckpt-p")
    t = PartitionedTable(spark, scratch_dir(spark, "t-stream-p"), ["P"])
    schema = spark.createDataFrame([], SCHEMA).schema
    for data in ([(1, "a", "x", "1")], [(1, "b", "x", "2"), (2, "c", "y", "1"), (2, "d", "y", "2")]):
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        stream_partitions(spark, landing, schema, t, ["K", "P"], order_by=["CREATE_BY"], checkpoint_location=ckpt).awaitTermination()
    assert sorted(r.V for r in t.read().collect()) == ["b", "d"]
