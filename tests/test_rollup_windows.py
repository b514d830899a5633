"""Aggregates kept up to date, and event-time windows over streams."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from mapflow.operators import Measure, Rollup
from mapflow.session import scratch_dir
from mapflow.streaming import late_rows, stream_rollup, stream_windows, windowed

SCHEMA = "g string, h int, v double"
ALL = [Measure("n", "count"), Measure("nv", "count", "v"), Measure("s", "sum", "cast(v as decimal(12,2))"), Measure("lo", "min", "v"),
       Measure("hi", "max", "v"), Measure("m", "avg", "cast(v as decimal(12,2))")]


def _data(n, seed):
    rnd = random.Random(seed)
    # Two thirds of the rows are one group.
    return [(rnd.choice(["hot", "hot", "a", None]), rnd.choice([1, 1, None]), rnd.choice([None, float(rnd.randrange(50))])) for _ in range(n)]


def _plain(df, groups):
    return df.groupBy(*groups).agg(*[list(m.states().values())[0][0].alias(m.name) for m in ALL[:-1]],
                                   F.avg(F.expr("cast(v as decimal(12,2))")).cast("double").alias("m"))


def test_loads_add_up_to_one_aggregation(spark):
    kept = Rollup(spark, scratch_dir(spark, "t-rollup"), ["g", "h"], ALL, ["g"])
    parts = [_data(200, 1), [], _data(1, 2), _data(150, 3)]
    for i, part in enumerate(parts):
        kept.load(spark.createDataFrame(part, SCHEMA), tag=f"b{i}")
    kept.load(spark.createDataFrame(parts[0], SCHEMA), tag="b0")  # a replay adds nothing
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    assert rows(kept.read().withColumn("m", F.col("m").cast("double").cast("decimal(12,4)"))) == \
        rows(_plain(whole, ["g", "h"]).withColumn("m", F.col("m").cast("decimal(12,4)")))
    for groups in (["g"], ["h"], []):
        got = kept.roll_up(groups).withColumn("m", F.col("m").cast("double").cast("decimal(12,4)"))
        assert rows(got) == rows(_plain(whole, groups).withColumn("m", F.col("m").cast("decimal(12,4)")))


def test_sketches_merge_over_loads_and_groups(spark):
    measures = [Measure("d", "distinct", "v"), Measure("q", "quantile", "v", share=0.9)]
    kept = Rollup(spark, scratch_dir(spark, "t-sketch"), ["g"], measures, ["g"])
    for k in range(3):  # overlapping ranges: 8,000 values in all
        kept.load(spark.range(k * 2000, k * 2000 + 4000).selectExpr("if(id % 2 = 0, 'x', 'y') as g", "1 as h", "cast(id as double) as v"))
    kept.load(spark.createDataFrame([("z", 1, None)], SCHEMA))
    got = {r["g"]: r for r in kept.read().collect()}
    assert abs(got["x"]["d"] - 4000) < 200 and got["z"]["d"] == 0 and got["z"]["q"] is None
    top = kept.roll_up([]).first()
    assert abs(top["d"] - 8000) < 400 and abs(top["q"] - 6500) < 500


def test_a_load_touches_its_partitions_only(spark):
    kept = Rollup(spark, scratch_dir(spark, "t-touch"), ["g"], ALL[:1], ["g"])
    kept.load(spark.createDataFrame([("a", 1, 1.0), ("b", 1, 1.0)], SCHEMA))
    files = lambda g: {f for f in kept.table.read().inputFiles() if f"/g={g}/" in f}
    a, b = files("a"), files("b")
    kept.load(spark.createDataFrame([("b", 1, 1.0), ("c", 1, 1.0)], SCHEMA))
    assert files("a") == a and files("b").isdisjoint(b)
    assert rows(kept.read()) == [("a", 1), ("b", 2), ("c", 1)]


def test_refused_definitions(spark):
    with pytest.raises(ValueError):
        Measure("x", "median", "v")
    with pytest.raises(ValueError):
        Measure("x", "sum")
    with pytest.raises(ValueError):
        Rollup(spark, "p", ["g"], ALL, ["h"])
    with pytest.raises(ValueError):
        Rollup(spark, "p", ["g"], [Measure("G", "count")], ["g"])


def test_streamed_rollup_equals_one_aggregation(spark):
    landing = scratch_dir(spark, "t-landing")
    df = spark.createDataFrame(_data(300, 5), SCHEMA)
    df.repartition(3).write.parquet(landing)
    kept, ckpt = Rollup(spark, scratch_dir(spark, "t-srollup"), ["g", "h"], ALL[:5], ["g"]), scratch_dir(spark, "t-ckpt")
    for _ in range(2):  # the second run finds nothing new
        stream_rollup(spark, landing, df.schema, kept, checkpoint_location=ckpt, max_files_per_trigger=1).awaitTermination()
    assert rows(kept.read()) == rows(_plain(df, ["g", "h"]).drop("m"))


def _stream(spark, landing, out, ckpt, **how):
    q = stream_windows(spark, landing, spark.read.parquet(landing).schema, out, ckpt, "ts", "10 minutes", ["k"],
                       [F.count(F.lit(1)).alias("n")], max_files_per_trigger=1, **how)
    q.awaitTermination()
    return q


def _write(spark, landing, data):
    at = lambda m: None if m is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    (spark.createDataFrame([(i, k, at(m)) for i, k, m in data], "i int, k string, ts timestamp_ntz")
     .coalesce(1).write.mode("append").parquet(landing))


def _found(spark, out):
    start = dt.datetime(2024, 1, 1)
    minutes = lambda t: round((t.replace(tzinfo=None) - start).total_seconds() / 60)
    cols = spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    return sorted(((minutes(r["window_start"]), minutes(r["window_end"]), r["k"], r["n"]) for r in cols.collect()), key=repr)


def test_windows_are_written_once_when_final_and_late_rows_are_counted(spark):
    landing, out, ckpt = (scratch_dir(spark, f"t-win-{x}") for x in ("in", "out", "ckpt"))
    _write(spark, landing, [(1, "a", 1), (2, "a", 2), (3, None, 3), (4, "a", None), (5, "a", 12)])
    _stream(spark, landing, out, ckpt, duration="10 minutes")
    assert _found(spark, out) == []  # the watermark is at minute 2
    _write(spark, landing, [(6, "a", 4), (7, "a", 31)])  # minute 4 is late by less than the delay
    _stream(spark, landing, out, ckpt, duration="10 minutes")
    assert _found(spark, out) == sorted([(0, 10, "a", 3), (0, 10, None, 1), (10, 20, "a", 1)], key=repr)
    _write(spark, landing, [(8, "a", 5), (9, "a", 60)])  # minute 5 is too late
    q = _stream(spark, landing, out, ckpt, duration="10 minutes")
    assert late_rows(q) == 1
    assert _found(spark, out) == sorted([(0, 10, "a", 3), (0, 10, None, 1), (10, 20, "a", 1), (30, 40, "a", 1)], key=repr)


def test_sessions_count_repeated_deliveries_once(spark):
    landing, out, ckpt = (scratch_dir(spark, f"t-ses-{x}") for x in ("in", "out", "ckpt"))
    _write(spark, landing, [(1, "a", 0), (2, "a", 4), (2, "a", 4), (3, "b", 4)])
    _write(spark, landing, [(2, "a", 4), (4, "a", 8), (5, "a", 20)])
    _write(spark, landing, [(6, "c", 100)])
    _stream(spark, landing, out, ckpt, gap="5 minutes", unique_by=["i"])
    assert _found(spark, out) == [(0, 13, "a", 3), (20, 25, "a", 1), (4, 9, "b", 1)]


def test_either_a_duration_or_a_gap(spark):
    with pytest.raises(ValueError):
        windowed(spark.range(1), "id", "1 hour", [], [])
