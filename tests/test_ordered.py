"""Running values, as-of joins and digest reconciliation against DuckDB and plain Python; hot groups and NULLs."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from mapflow.operators import asof_join, ordered_window, recon_digest

def test_running_values_over_a_hot_group(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["hot", "hot", "hot", "b", None, f"g{i % 40}"]), rng.randrange(300), rng.choice([None, *range(50)])) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, g string, o int, v long").repartition(7)
    out = ordered_window(df, ["g"], ["o", "id"], {"n": ("row_number", None), "c": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"),
                                                  "hi": ("max", "v"), "before": ("lag", "v"), "known": ("last", "v")})
    con = duckdb.connect()
    con.register("d", pd.DataFrame(data, columns=["id", "g", "o", "v"]).astype({"v": "Int64"}))
    want = con.execute("select id, row_number() over w, count(v) over w, sum(v) over w, min(v) over w, max(v) over w, lag(v) over w, "
                       "last_value(v ignore nulls) over w from d window w as (partition by g order by o, id)").fetchall()
    got = out.select("id", "n", "c", "s", "lo", "hi", "before", "known")
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # No task sees a whole group: the window is partitioned by the range partition, too.
    assert "windowspecdefinition(__pid" in out._jdf.queryExecution().optimizedPlan().toString()


def test_running_values_of_ties_and_empty_frames(spark):
    same = spark.createDataFrame([("a", 1)] * 50, "g string, v int")
    got = [r.n for r in ordered_window(same, ["g"], ["v"], {"n": ("row_number", None)}).collect()]
    assert sorted(got) == list(range(1, 51))
    assert ordered_window(same.where("v > 1"), ["g"], ["v"], {"n": ("row_number", None)}).count() == 0
    with pytest.raises(ValueError):
        ordered_window(same, ["g"], ["v"], {"n": ("median", "v")})


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join(spark, strict):
    rng = random.Random(2)
    some = lambda x: None if rng.random() < .05 else x
    left = [(i, some(0 if i % 3 == 0 else rng.randrange(20)), some(rng.randrange(200))) for i in range(900)]
    right = [(some(0 if i % 2 else rng.randrange(20)), some(rng.randrange(200)), i, some(i)) for i in range(700)]
    a = spark.createDataFrame(left, "id long, k int, t int")
    b = spark.createDataFrame(right, "k long, t long, rid long, v long")
    got = asof_join(a, b, [("k", "k")], "t", "t", {"rid": "rid", "rv": "v"}, strict=strict, ties=["rid"])
    want = []
    for i, k, t in left:
        best = max(((r[1], r[2], r[3]) for r in right if None not in (k, t, r[0], r[1]) and r[0] == k and (r[1] < t or r[1] == t and not strict)),
                   default=(None, None, None), key=lambda x: x[:2])
        want.append((i, k, t, best[1], best[2]))
    assert rows(got) == sorted(want, key=repr)
    near = asof_join(a, b, [("k", "k")], "t", "t", {"rid": "rid"}, strict=strict, ties=["rid"], tolerance=F.lit(3))
    times = {r[2]: r[1] for r in right}
    assert rows(near) == sorted(((i, k, t, r if r is not None and t - 3 <= times[r] else None) for i, k, t, r, _ in want), key=repr)
    assert asof_join(a, b.where("v < -1"), [("k", "k")], "t", "t", {"rid": "rid"}).where("rid is null").count() == len(left)
    assert asof_join(a.where("id < 0"), b, [("k", "k")], "t", "t", {"rid": "rid"}).count() == 0


def test_digest_reconciliation(spark):
    base = spark.range(5000).selectExpr("id", "if(id % 3 = 0, null, id * 2) as v", "'name ' || id as nm", "map('a', id) as m")
    flat = base.drop("m")
    changed = (flat.withColumn("v", F.when(F.col("id") == 77, 1).otherwise(F.col("v"))).where("id <> 4000")
               .union(spark.sql("select 9999L, 5L, cast(null as string)")))
    out = recon_digest(changed, flat, ["id"])
    assert rows(out) == sorted([("target", 77, 1, "name 77"), ("target", 9999, 5, None), ("source", 77, 154, "name 77"),
                                ("source", 4000, 8000, "name 4000")], key=repr)
    assert rows(recon_digest(changed, flat, ranges=3)) == rows(out)  # keyed by whole rows, coarse ranges
    equal = recon_digest(flat.repartition(5), flat, ["id"])
    assert rows(equal) == [] and "FileScan" not in plan_text(equal) and "Join" not in plan_text(equal)
    doubled = flat.union(flat.where("id = 3"))
    assert rows(recon_digest(doubled, flat, ["id"])) == []  # copies are no difference to EXCEPT
    wider = flat.selectExpr("cast(id as int) id", "v + 0.5D as v", "nm")
    assert rows(recon_digest(wider, flat, ["id"]).where("id < 3")) == sorted(
        [("target", 1, 2.5, "name 1"), ("target", 2, 4.5, "name 2"), ("source", 1, 2.0, "name 1"), ("source", 2, 4.0, "name 2")], key=repr)
