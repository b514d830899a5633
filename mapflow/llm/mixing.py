"""Mixing sources to target weights by systematic sampling.

A source's documents stand in one order (by size, then by a hash of the id, so
that any stretch of the order holds documents of one size).  Each is expected
``target / size`` times, which is the same for all documents of a source and two
at most.  The running total of these expectations, shifted by one offset drawn
for the source, passes a number of whole steps at each document: so many copies
are taken.  As neighbours in the order are alike in size, the words taken differ
from the target by little more than one document.

Targets: sources in code-point order (null last) have the weights in turn and
share ``share`` times all words; a target stops at ``limit`` times its source's
words, and what exceeds it goes to the others by weight until none is above.

The place of a document in its source comes from a range sort of (source, size,
hash): each sorted partition is numbered on its own and shifted by the counts of
the source in earlier partitions.  No source, and no group of equal sizes, has to
fit one task.  The table of sources has one row per source and is small by nature.

Null and empty texts have size zero and are taken like others (of zero words).
A null source is a source of its own, the last.  Null ``doc_id``: kept; ties go by
a hash of the text.  Rows alike in all of it are interchangeable.  Empty table:
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, row_order, stored, table

WEIGHTS = (3, 1, 2)


def place_in_group(rows: DataFrame, group: str, order: Sequence[str], purpose: str) -> DataFrame:
    """``rows`` with ``place``: its number, from 0, among the rows of ``group`` in ``order``; stored.

    ``group`` and ``order`` decide the order fully, up to rows alike in all of them.
    """
    pid = fresh(rows, "pid")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(rows.repartitionByRange(n, F.col(group), *order).withColumn(pid, F.spark_partition_id()), purpose)
    counts = ranged.groupBy(group, pid).agg(F.count("*").alias("n"))
    before = counts.withColumn(
        "before", F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)),
                             F.lit(0))).drop("n").withColumnsRenamed({group: "g_", pid: "p_"})
    within = F.row_number().over(Window.partitionBy(pid, group).orderBy(*order)) - 1
    own = ranged.withColumn("within", within)
    return (own.join(before, (own[pid] == before.p_) & own[group].eqNullSafe(before.g_))
            .withColumn("place", F.col("within") + F.col("before")).drop("within", "before", "p_", "g_", pid))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2), limit: int = 2) -> DataFrame:
    """``source``, ``source_size``, ``target`` of every source; ``sizes``: columns ``source`` and ``size``.

    ``share``: the mix as a fraction of all words.  The resharing ends where the
    targets are the smaller of ``limit * source_size`` and ``level * weight``; the
    level follows from running sums over the sources by how soon they stop.
    """
    num, den = share
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_point = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(by_point) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * limit)
    # By cap/weight; the sources before the turning point are at their cap, the others share the rest.
    soonest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    up_to = soonest.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = (per.withColumn("capped", F.coalesce(F.sum("cap").over(up_to), F.lit(0)))
           .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(up_to), F.lit(0)))
           .withColumn("budget", F.sum("source_size").over(whole) * num))
    level = (F.col("budget") - F.col("capped") * den) / (F.col("open") * den)
    per = per.withColumn("lvl", F.when(F.col("cap") >= level * F.col("weight"), level))
    # The first source that its share does not fill sets the level for itself and all after it.
    per = per.withColumn("level", F.first("lvl", ignorenulls=True).over(soonest.rowsBetween(Window.unboundedPreceding, 0)))
    return per.select("source", "source_size", "docs", F.coalesce(
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2), limit: int = 2,
        seed: int = 7, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``keep``: further columns of ``docs`` to carry along (such as a row's key).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id"))).alias("draw"),
                       F.md5(F.coalesce("text", F.lit(""))).alias("tie"), *keep)
    placed = place_in_group(stored(rows, "mixing-sizes"), "source", ["size", "draw", "tie"], "mixing-order")
    goal = targets(placed, weights, share, limit)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))), 1, 8),
                    16, 10).cast("long") / F.lit(2.0 ** 32)
    goal = goal.withColumn("offset", offset).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    goal = goal.withColumnRenamed("source", "goal_source").drop("docs")
    # One row per source: the join is left to Spark, which broadcasts it while it is small.
    out = placed.join(goal, placed.source.eqNullSafe(goal.goal_source))
    step = lambda k: F.floor((F.col("place") + k) * F.col("rate") + F.col("offset"))
    out = out.withColumn("copies", (step(1) - step(0)).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"), *keep)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with their columns unchanged.

    Rows alike in every column count as one row with the copies of all of them.
    """
    uid, times = fresh(docs, "mix_row"), fresh(docs, "mix_times")
    copies, rows, key_id, key_uid = (fresh(docs, f"mix_{x}") for x in ("copies", "rows", "key_id", "key_uid"))
    hashed = docs.withColumn(uid, row_order(docs))
    keyed = hashed.select(F.col("doc_id"), F.col("source"), F.col("text"), F.col(uid).alias("uid"))
    taken = stored(mix(keyed, keep=["uid"], **options).groupBy("doc_id", "uid").agg(
        F.sum("copies").alias(copies), F.count("*").alias(rows)).where(F.col(copies) > 0)
        .withColumnsRenamed({"doc_id": key_id, "uid": key_uid}), "mixing-taken")
    out = hashed.join(taken, (hashed[uid] == taken[key_uid]) & hashed["doc_id"].cast("long").eqNullSafe(taken[key_id]))
    once, again = out.where(F.col(rows) == 1), out.where(F.col(rows) > 1).dropDuplicates([uid])
    names = [f"`{c}`" for c in docs.columns]
    return once.union(again).select(*names, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(times)).select(*names)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = """
with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
         md5('7:' || doc_id) as draw, md5(coalesce(text, '')) as tie
  from documents),
per as (
  select source, cast(sum(size) as bigint) as source_size,
         [3, 1, 2][(row_number() over (order by source is null, source) - 1) % 3 + 1] as weight
  from rows group by source),
running as (
  select *, 2 * source_size as cap,
         coalesce(sum(2 * source_size) over w, 0) as capped,
         sum(weight) over () - coalesce(sum(weight) over w, 0) as open,
         sum(source_size) over () * 3 as budget
  from per window w as (order by 2 * source_size / weight, source is null, source rows between unbounded preceding and 1 preceding)),
leveled as (
  select *, cast(budget - capped * 2 as double) / cast(open * 2 as double) as own from running),
goal as (
  select source, source_size, weight, cap,
         least(cast(cap as double),
               first(case when cap >= own * weight then own end ignore nulls)
                 over (order by cap / weight, source is null, source rows between unbounded preceding and current row) * weight) as target,
         cast(('0x' || substr(md5('7:' || case when source is null then 'null' else '=' || source end), 1, 8)) as bigint)
           / 4294967296.0::double as shift
  from leveled),
placed as (
  select *, row_number() over (partition by source order by size, draw, tie) - 1 as place from rows),
stepped as (
  select p.doc_id, p.size, g.source_size, coalesce(g.target, cast(g.cap as double)) as target, p.place, g.shift,
         case when g.source_size > 0 then coalesce(g.target, cast(g.cap as double)) / g.source_size else 0.0::double end as rate
  from placed p join goal g on p.source is not distinct from g.source)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast((floor((place + 1) * rate + shift) - floor(place * rate + shift)) * size as bigint) as taken
from stepped
"""
