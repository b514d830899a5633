from pyspark.sql import functions as F

from conftest import rows
from mapflow.session import scratch_dir
from mapflow.streaming import stream_merge


def test_three_files_three_batches_then_idle(spark, store):
    landing = scratch_dir(spark, "t-landing")
    schema = "K bigint, V string"
    for i, batch in enumerate([[(1, "a"), (2, "b")], [(2, "B"), (3, "c")], [(1, "A")]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landing)
    store.overwrite("RAW.T", spark.createDataFrame([(9, "z")], schema))
    ckpt = scratch_dir(spark, "t-ckpt")
    sch = spark.read.parquet(landing).schema
    q = stream_merge(spark, landing, sch, store, "RAW.T", ["K"], max_files_per_trigger=1, checkpoint_location=ckpt)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    assert rows(store.read("RAW.T")) == [(1, "A"), (2, "B"), (3, "c"), (9, "z")]
    v = store.version("RAW.T")
    # a second scheduled run with no new files merges nothing
    q2 = stream_merge(spark, landing, sch, store, "RAW.T", ["K"], checkpoint_location=ckpt)
    q2.awaitTermination()
    assert store.version("RAW.T") == v


def test_default_checkpoint_is_stable_per_table(spark, store):
    landing = scratch_dir(spark, "t-landing2")
    schema = "K bigint, V string"
    spark.createDataFrame([(1, "a")], schema).write.parquet(landing)
    sch = spark.read.parquet(landing).schema
    table = "RAW.T_" + landing[-12:].upper()
    stream_merge(spark, landing, sch, store, table, ["K"]).awaitTermination()
    v = store.version(table)
    stream_merge(spark, landing, sch, store, table, ["K"]).awaitTermination()  # nothing new
    assert store.version(table) == v
    spark.createDataFrame([(1, "b")], schema).write.mode("append").parquet(landing)
    stream_merge(spark, landing, sch, store, table, ["K"]).awaitTermination()
    assert rows(store.read(table)) == [(1, "b")]


def test_latest_row_of_a_key_wins_and_replays_are_skipped(spark, store):
    landing, ckpt = scratch_dir(spark, "t-landing3"), scratch_dir(spark, "t-ckpt3")
    data = [(1, "a", 1), (1, "c", 3), (1, "b", 2), (None, "n", 1), (None, "n", 1), (2, "x", 5)]
    spark.createDataFrame(data, "K bigint, V string, N int").write.parquet(landing)
    sch = spark.read.parquet(landing).schema
    stream_merge(spark, landing, sch, store, "RAW.L", ["K"], checkpoint_location=ckpt, order_by=["N"]).awaitTermination()
    want = sorted([(1, "c", 3), (2, "x", 5), (None, "n", 1), (None, "n", 1)], key=repr)
    assert rows(store.read("RAW.L")) == want
    # The batch was committed, but its stream failed before it could note that: it runs again.
    import os
    import shutil
    commits = f"{ckpt}/commits".removeprefix("file:")
    for name in os.listdir(commits):
        os.remove(f"{commits}/{name}") if os.path.isfile(f"{commits}/{name}") else shutil.rmtree(f"{commits}/{name}")
    stream_merge(spark, landing, sch, store, "RAW.L", ["K"], checkpoint_location=ckpt, order_by=["N"]).awaitTermination()
    assert rows(store.read("RAW.L")) == want


def test_a_reset_checkpoint_merges_everything_again(spark, store):
    from mapflow.sources.store import remove_path

    landing, ckpt = scratch_dir(spark, "t-landing4"), scratch_dir(spark, "t-ckpt4")
    schema = "K bigint, V string, N int"

    def run(batch):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(landing)
        stream_merge(spark, landing, spark.read.parquet(landing).schema, store, "RAW.R", ["K"], checkpoint_location=ckpt,
                     order_by=["N"]).awaitTermination()

    run([(1, "a", 1)])
    remove_path(spark, ckpt)
    run([(1, "b", 2), (2, "c", 1)])
    assert rows(store.read("RAW.R")) == [(1, "b", 2), (2, "c", 1)]
    run([(3, "d", 1)])
    assert rows(store.read("RAW.R")) == [(1, "b", 2), (2, "c", 1), (3, "d", 1)]
