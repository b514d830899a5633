"""Range and OR conditions of any size against DuckDB, for all join types, with NULLs and hot values."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from mapflow import JoinSpec, TableRef
from mapflow.operators.condition import analyse, conjuncts, disjuncts
from mapflow.operators.join import JoinError, Match, apply_join, outer_join
from mapflow.session import checkpoint_root

HOWS = {"INNER": "inner", "LEFT": "left", "RIGHT": "right", "FULL": "full outer"}


def sides(n=500, m=400, seed=1):
    """Points and intervals; a third of the points share a value, a fifth of the intervals their bounds, some are NULL or inverted."""
    rng = random.Random(seed)
    some = lambda x: None if rng.random() < .05 else x
    points = [(i, some(300 if i % 3 == 0 else rng.randrange(1000)), some(rng.randrange(3)), rng.randrange(50)) for i in range(n)]
    spans = []
    for i in range(m):
        lo = 300 if i % 5 == 0 else rng.randrange(1000)
        hi = lo + (rng.choice([0, 1, 5, 40, 900]) if i % 7 else -3)
        spans.append((i, some(lo), some(hi), some(rng.randrange(3)), rng.randrange(50)))
    return points + points[:20], spans + spans[:20]


def frames(spark, points, spans):
    return (spark.createDataFrame(points, "id long, x int, k int, w long").alias("source"),
            spark.createDataFrame(spans, "jd long, lo int, hi long, k int, w long"))


def got(spark, points, spans, how, cond, always=True):
    left, right = frames(spark, points, spans)
    if always:  # whatever the size
        from mapflow.operators.join import outer_join
        match = outer_join if how != "INNER" else lambda a, b, t, _: Match(a, b, t).inner()
        out = match(left, right.alias("j"), cond, {"LEFT": "left", "RIGHT": "right", "FULL": "full_outer"}.get(how))
    else:
        out = apply_join(left, right, JoinSpec(how, TableRef("J"), "j", cond))
    assert "NestedLoop" not in plan_text(out) and "Cartesian" not in plan_text(out)
    out = out.select("source.id", "source.x", "j.jd", "j.lo")  # the aliases still hold
    return sorted(map(tuple, out.collect()), key=repr)


def want(points, spans, how, cond):
    con = duckdb.connect()
    for name, rows, cols in (("a", points, ["id", "x", "k", "w"]), ("b", spans, ["jd", "lo", "hi", "k", "w"])):
        con.register(name, pd.DataFrame(rows, columns=cols).astype("Int64"))
    return sorted(con.execute(f"select source.id, source.x, j.jd, j.lo from a source {HOWS[how]} join b j on {cond}").fetchall(), key=repr)


RANGES = [
    "source.x >= j.lo and source.x < j.hi",
    "source.x > j.lo and source.x <= j.hi",
    "j.lo < source.x and j.hi > source.x",
    "source.x between j.lo and j.hi",
    "source.x >= j.lo and source.x <= j.hi and source.w > 20 and j.w < 30",
    "source.x >= j.lo and source.x <= j.hi and source.w + j.w > 50",
    "source.x <= j.hi and source.x + 10 >= j.lo",
    "source.x + 3 < j.lo",
    "j.lo >= source.x and j.lo <= source.x + source.w",
    "(source.x >= j.lo) and (source.x <= j.hi and source.w <> j.w)",
]


@pytest.mark.parametrize("cond", RANGES)
def test_ranges(spark, cond):
    # A full join is made of the inner join and the unmatched rows of either side.
    points, spans = sides()
    for how in HOWS if cond == RANGES[0] else ("FULL",):
        assert got(spark, points, spans, how, cond) == want(points, spans, how, cond), how


ORS = [
    "source.id = j.jd or source.x = j.lo",
    "(source.k = j.k and source.w = j.w) or (source.x = j.hi and j.w > 10)",
    "(source.id = j.jd or source.x = j.hi) and source.w < 40 and j.w > 3",
    "source.id = j.jd or source.x >= j.lo and source.x < j.hi and source.w > 45",
    "source.x = j.lo or source.x = j.hi or source.id = j.jd",
]


@pytest.mark.parametrize("cond", ORS)
def test_disjunctions(spark, cond):
    points, spans = sides(300, 200, 2)
    for how in ("FULL",):
        assert got(spark, points, spans, how, cond) == want(points, spans, how, cond), how


def test_equality_with_one_sided_conditions_reduces_keys_first(spark):
    points, spans = sides(200, 200, 3)
    cond = "source.k = j.k and j.w < 30 and source.w > 20 and upper(cast(source.x as string)) = cast(j.lo as string)"
    for how in ("LEFT", "FULL"):
        assert got(spark, points, spans, how, cond) == want(points, spans, how, cond.replace("as string", "as varchar")), how
    left, right = frames(spark, points, spans)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for side, other in ((0, "right"), (1, "left")):
            text = plan_text(Match(left, right.alias("j"), "source.k = j.k and j.w < 30 and source.w > 20").unmatched(side))
            assert "HashAggregate" in text and "LeftAnti" in text, other
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_sides(spark):
    points, spans = sides(30, 30)
    for a, b, cond in (([], spans, RANGES[0]), (points, [], RANGES[6]), ([], [], RANGES[0]), (points, [], ORS[0])):
        assert got(spark, a, b, "FULL", cond) == want(a, b, "FULL", cond)


def test_large_sides_meet_without_a_product(spark):
    # 150,000 points, 120,000 intervals, some over everything; the product would be 18 billion pairs.
    left = spark.range(150_000).selectExpr("id", "id * 7 % 1000003 as x").alias("source")
    right = spark.range(120_000).selectExpr("id as jd", "id * 11 % 1000003 as lo", "id * 11 % 1000003 + if(id % 40000 = 0, 400000, 5) as hi")
    out = apply_join(left, right, JoinSpec("LEFT", TableRef("J"), "j", "source.x >= j.lo and source.x < j.hi"))
    assert "NestedLoop" not in plan_text(out) and "Cartesian" not in plan_text(out)
    rows, matched, digest = out.agg(F.count("*"), F.count("j.jd"), F.sum(F.coalesce(F.col("j.jd"), F.lit(0)) + F.col("source.x"))).first()
    con = duckdb.connect()
    con.execute("create table a as select id, id * 7 % 1000003 as x from range(150000) t(id)")
    con.execute("create table b as select id as jd, id * 11 % 1000003 as lo, id * 11 % 1000003 + if(id % 40000 = 0, 400000, 5) as hi from range(120000) t(id)")
    assert (rows, matched, digest) == con.execute(
        "select count(*), count(jd), sum(coalesce(jd, 0) + x) from a left join b on x >= lo and x < hi").fetchone()


def test_other_types(spark):
    left = spark.sql("select id, timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) as t, cast(id as decimal(10, 2)) / 3 as d, "
                     "lpad(id, 3, '0') as s from range(90)").alias("source")
    right = spark.sql("select id as jd, date'2024-01-10' + cast(id * 9 as int) as a, date'2024-01-14' + cast(id * 9 as int) as b, "
                      "double(id) as lo, double(id) + 0.5 as hi, lpad(id * 5, 3, '0') as p, lpad(id * 5 + 3, 3, '0') as q from range(12)")
    for cond in ("source.t >= j.a and source.t < j.b", "source.d > j.lo and source.d <= j.hi", "source.s between j.p and j.q"):
        inner = Match(left, right.alias("j"), cond).inner()
        brute = left.crossJoin(right.alias("j")).where(cond)
        assert sorted(map(tuple, inner.select("id", "jd").collect())) == sorted(map(tuple, brute.select("id", "jd").collect())) != []


def test_parts_of_conditions(spark):
    assert conjuncts("a.x between b.lo and b.hi and (a.k = 'x and y' and (a.z > 1))") == [
        "a.x >= b.lo", "a.x <= b.hi", "a.k = 'x and y'", "a.z > 1"]
    assert conjuncts("a.x not between b.lo and b.hi and a.k = 1") == ["a.x not between b.lo AND b.hi", "a.k = 1"]
    assert disjuncts("(a.x = 1 or (b.y = 2 or b.z = 3))") == ["a.x = 1", "b.y = 2 or b.z = 3"]
    left, right = frames(spark, *sides(5, 5))
    c = analyse(left, right.alias("j"), "source.k = j.k and j.lo < source.x and source.w in (1, 2) and coalesce(j.w, 0) = 3 and source.w <> j.w")
    assert c.equal == [("source.k", "=", "j.k")] and c.ranges == [("source.x", ">", "j.lo")] and c.left_only == ["source.w in (1, 2)"]
    assert c.right_only == ["coalesce(j.w, 0) = 3"] and c.mixed == ["source.w <> j.w"]
    with pytest.raises(JoinError):
        Match(left, right.alias("j"), "source.w <> j.w or source.k = j.k")


def stored_rows(spark, since):
    """Rows in the folders that joins have written under the checkpoint folder after those of ``since``."""
    import os
    top = f"{checkpoint_root(spark).removeprefix('file:')}/mapflow"
    new = {x for x in os.listdir(top) if x.startswith("range-")} - since if os.path.isdir(top) else set()
    return new, sum(spark.read.parquet(f"{top}/{x}").count() for x in new)


def stages_of(df):
    """Rows that each exchange of an executed plan has written."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            if kind == "ShuffleExchangeExec":
                found.append(p.metrics().apply("shuffleRecordsWritten").value())
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return found


@pytest.mark.parametrize("how,cond", [
    ("FULL", "source.x <= j.hi and source.x + 50 >= j.lo"), ("LEFT", "source.x >= j.lo and source.x < j.hi")])
def test_pairs_are_neither_stored_nor_sent(spark, how, cond):
    # 4,000 rows a side, all values different, an interval holds 150 points or so: some 600,000 pairs.
    left = spark.range(4000).selectExpr("id", "id * 7 % 4003 as x").alias("source")
    right = spark.range(4000).selectExpr("id as jd", "id * 11 % 4003 as lo", "id * 11 % 4003 + 150 as hi")
    since, _ = stored_rows(spark, set())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = outer_join(left, right.alias("j"), cond, {"LEFT": "left", "FULL": "full_outer"}[how]).select("id", "jd", "x")
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    con = duckdb.connect()
    con.execute("create table a as select id, id * 7 % 4003 as x from range(4000) t(id)")
    con.execute("create table b as select id as jd, id * 11 % 4003 as lo, id * 11 % 4003 + 150 as hi from range(4000) t(id)")
    assert sorted(map(tuple, rows), key=repr) == sorted(con.execute(
        f"select id, jd, x from a source {HOWS[how]} join b j on {cond}").fetchall(), key=repr)
    assert len(rows) > 500_000
    assert stored_rows(spark, since)[1] < 120_000
    sent = stages_of(out)
    assert sent and sum(sent) < 300_000


@pytest.mark.parametrize("cond", [
    "source.x <= j.hi and source.w * 20 >= j.lo",
    "source.x < j.hi and source.w * 20 > j.lo and source.k <=> j.k and j.w > 5",
    "source.x <= j.hi and source.w * 20 > j.lo and source.k = j.k and source.w > 10"])
def test_overlaps_of_inverted_intervals(spark, cond):
    points, spans = sides(300, 250, 5)
    assert got(spark, points, spans, "FULL", cond) == want(points, spans, "FULL", cond.replace("<=>", "is not distinct from"))
