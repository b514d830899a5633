"""Keyed upsert: hand-written cases the driver tables do not hold."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from mapflow.operators import DuplicateKeyError, load_merge, merge_frames

SCHEMA = "K bigint, NM string, BAL double, CREATE_BY string, UPDATE_BY string"


def test_matched_updated_unmatched_kept_and_inserted(spark):
    t = spark.createDataFrame([(1, "a", 1.0, "old", "old"), (2, "b", 2.0, "old", "old")], SCHEMA)
    s = spark.createDataFrame([(2, "B", None, "new", "new"), (3, "c", 3.0, "new", "new")], SCHEMA)
    out = merge_frames(t, s, ["K"])
    assert rows(out) == [(1, "a", 1.0, "old", "old"), (2, "B", None, "old", "new"), (3, "c", 3.0, "new", "new")]


def test_update_column_list_and_empty_exclusions(spark):
    t = spark.createDataFrame([(1, "a", 1.0, "old", "old")], SCHEMA)
    s = spark.createDataFrame([(1, "A", 9.0, "new", "new")], SCHEMA)
    assert rows(merge_frames(t, s, ["K"], update_columns=["bal"])) == [(1, "a", 9.0, "old", "old")]
    assert rows(merge_frames(t, s, ["K"], exclude=())) == [(1, "A", 9.0, "new", "new")]


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "tn", 1.0, "old", "old"), (1, "a", 1.0, "old", "old")], SCHEMA)
    s = spark.createDataFrame([(None, "sn", 2.0, "new", "new"), (1, "A", 2.0, "new", "new")], SCHEMA)
    out = merge_frames(t, s, ["K"])
    assert rows(out) == sorted([(None, "tn", 1.0, "old", "old"), (None, "sn", 2.0, "new", "new"),
                                (1, "A", 2.0, "old", "new")], key=repr)


def test_source_columns_by_name_any_case_missing_are_null(spark):
    t = spark.createDataFrame([(1, "a", 1.0, "old", "old")], SCHEMA)
    s = spark.createDataFrame([(5, "e")], "k bigint, nm string")
    assert rows(merge_frames(t, s, ["K"])) == [(1, "a", 1.0, "old", "old"), (5, "e", None, None, None)]


def test_unknown_source_column_rejected(spark):
    t = spark.createDataFrame([(1, "a", 1.0, "old", "old")], SCHEMA)
    with pytest.raises(ValueError):
        merge_frames(t, spark.createDataFrame([(1, 2)], "K bigint, OTHER int"), ["K"])


def test_empty_source_and_empty_target(spark):
    t = spark.createDataFrame([(1, "a", 1.0, "old", "old")], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(merge_frames(t, empty, ["K"])) == rows(t)
    assert rows(merge_frames(empty, t, ["K"])) == rows(t)


def test_load_merge_creates_missing_target_and_is_idempotent(spark, store):
    s = spark.createDataFrame([(1, "a", 1.0, "new", "new"), (2, "b", 2.0, "new", "new")], SCHEMA)
    first = rows(load_merge(store, "DW.T", s, ["K"]))
    assert first == rows(s)
    s2 = spark.createDataFrame([(2, "B", 5.0, "x", "x")], SCHEMA)
    once = rows(load_merge(store, "DW.T", s2, ["K"]))
    twice = rows(load_merge(store, "DW.T", s2, ["K"]))
    assert once == twice == [(1, "a", 1.0, "new", "new"), (2, "B", 5.0, "new", "x")]
    assert store.version("DW.T") == 3


def test_duplicate_source_keys_fail(spark, store):
    s = spark.createDataFrame([(1, "a", 1.0, "n", "n"), (1, "b", 1.0, "n", "n")], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        load_merge(store, "DW.T", s, ["K"])


def test_shuffle_merge_streams_target_through_left_join(spark):
    t = spark.range(1000).select(F.col("id").alias("K"), F.lit("x").alias("NM"))
    s = spark.range(500, 1500).select(F.col("id").alias("K"), F.lit("y").alias("NM"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        txt = plan_text(merge_frames(t, s, ["K"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftOuter" in txt and "FullOuter" not in txt


@pytest.mark.parametrize("how", ["shuffle", "broadcast"])
def test_both_strategies_agree(spark, how):
    t = spark.createDataFrame([(None, "tn", 1.0, "old", "old"), (1, "a", 1.0, "old", "old"),
                               (2, "b", 2.0, "old", "old")], SCHEMA)
    s = spark.createDataFrame([(None, "sn", 2.0, "new", "new"), (1, "A", 2.0, "new", "new"),
                               (7, "g", 7.0, "new", "new")], "K bigint, NM string, BAL double, CREATE_BY string, UPDATE_BY string")
    out = merge_frames(t, s.drop("CREATE_BY"), ["k"], strategy=how)
    assert rows(out) == sorted([(None, "tn", 1.0, "old", "old"), (None, "sn", 2.0, None, "new"),
                                (1, "A", 2.0, "old", "new"), (2, "b", 2.0, "old", "old"),
                                (7, "g", 7.0, None, "new")], key=repr)


def test_broadcast_merge_never_shuffles_target(spark):
    t = spark.range(1000).select(F.col("id").alias("K"), F.lit("x").alias("NM"))
    s = spark.range(500, 1500).select(F.col("id").alias("K"), F.lit("y").alias("NM"))
    txt = plan_text(merge_frames(t, s, ["K"], strategy="broadcast"))
    assert "SortMergeJoin" not in txt and "BroadcastHashJoin LeftOuter" in txt


def test_load_merge_picks_strategy_by_measured_size(spark, store):
    import mapflow.operators.load as L
    wide, _ = L.stage(spark.range(3000).selectExpr("id as K", "repeat(sha2(cast(id as string), 512), 40) as NM"))
    narrow, _ = L.stage(spark.range(10).selectExpr("id as K"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        assert L.merge_strategy(narrow) == "small" and L.merge_strategy(wide) == "shuffle"
        s = spark.createDataFrame([(1, "a", 1.0, "n", "n")], SCHEMA)
        load_merge(store, "DW.M", s, ["K"])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = load_merge(store, "DW.M", spark.createDataFrame([(2, "b", 1.0, "n", "n")], SCHEMA), ["K"])
        assert rows(out, "K") == [(1,), (2,)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shuffle_merge_with_hot_duplicated_target_key(spark):
    """A third of the target shares one key (appended duplicates): all of them are updated."""
    t = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("K"),
                                 F.lit("x").alias("NM"))
    s = spark.createDataFrame([(-1, "hot"), (5000, "new")], "K bigint, NM string")
    out = merge_frames(t, s, ["K"], strategy="shuffle")
    got = {r["K"]: r["NM"] for r in out.where("K in (-1, 5000)").distinct().collect()}
    assert got == {-1: "hot", 5000: "new"}
    assert out.count() == 3001


def test_aqe_splits_hot_target_partition(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        t = spark.range(200000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("K"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("NM"))
        s = spark.range(0, 200000, 7).select(F.col("id").alias("K"), F.lit("y").alias("NM"))
        out = merge_frames(t, s, ["K"], strategy="shuffle")
        # every target row kept; batch keys that are multiples of 3 are new (target row 0 became -1)
        inserts = sum(1 for i in range(0, 200000, 7) if i % 3 == 0)
        assert len(out.collect()) == 200000 + inserts
        assert "SortMergeJoin(skew=true)" in plan_text(out)
    finally:
        for k in conf:
            spark.conf.unset(k)
