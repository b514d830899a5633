"""Running values and latest-row lookups over one range-sorted order.

A plain window puts a whole group into one task.  Here rows are range-partitioned and
sorted by (group, order), so a group of any size spreads over neighbouring partitions.  The
window runs inside each partition's share of a group; what the earlier shares amount to
(their count, sum, last value) is added from a table of border states.  That
table is joined only for groups that span partitions, and a partition's border cuts one group at most, so
it has no more rows than there are partitions and is broadcast.

``asof_join`` is built on it: both sides in one order, the last known row of the
right side carried forward to the rows of the left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import col
from ..session import scratch_dir
from .keys import hashable_columns

KINDS = ("row_number", "count", "sum", "min", "max", "lag", "last")


def sort_stored(df: DataFrame, order: Sequence[Column | str], purpose: str = "ordered") -> DataFrame:
    """``df`` sorted by ``order`` over range partitions, with partition ``__pid`` and place ``__pos`` in it; written and read back.

    Both passes over the rows then see one and the same order, also after executors are lost.
    """
    path = scratch_dir(df.sparkSession, purpose)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.select("*", F.spark_partition_id().alias("__pid"),
                  F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__pos")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    cond = F.lit(True)
    for x, y in zip(a, b):
        cond = cond & F.col(x).eqNullSafe(F.col(y))
    return cond


def running(placed: DataFrame, group: Sequence[str], columns: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Running values over ``placed`` (from ``sort_stored``, sorted by ``group`` first).

    ``columns``: new name to (kind, column).  ``row_number`` and ``lag`` as in SQL; ``count`` (of non-null values), ``sum``,
    ``min``, ``max`` from the group's first row to this one; ``last``: the latest non-null value so far.
    """
    if bad := {k for k, _ in columns.values()} - set(KINDS):
        raise ValueError(f"unknown running values {sorted(bad)}; use {KINDS}")
    group = list(group)
    so_far = Window.partitionBy("__pid", *[col(g) for g in group]).orderBy("__pos")
    frame = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own, state = {}, {}
    for i, (kind, c) in enumerate(columns.values()):
        v = col(c) if c else F.lit(1)
        if kind in ("row_number", "count"):
            own[i], state[i] = F.count(v).over(frame), F.count(v)
        elif kind in ("sum", "min", "max"):
            f = getattr(F, kind)
            own[i], state[i] = f(v).over(frame), f(v)
        elif kind == "lag":
            own[i], state[i] = F.lag(v).over(so_far), F.max_by(v, F.col("__pos"))
        else:
            own[i], state[i] = F.last(v, ignorenulls=True).over(frame), F.max_by(v, F.when(v.isNotNull(), F.col("__pos")))
    inside = placed.withColumns({f"__own{i}": c for i, c in own.items()} | {"__first": F.row_number().over(so_far) == 1})
    names = [f"__g{i}" for i in range(len(group))]
    states = placed.groupBy(F.col("__pid").alias("__bpid"), *[col(g).alias(n) for g, n in zip(group, names)]).agg(
        *[c.alias(f"__s{i}") for i, c in state.items()])
    w = Window.partitionBy(*names).orderBy("__bpid")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    carried = {}
    for i, (kind, _) in enumerate(columns.values()):
        s = F.col(f"__s{i}")
        carried[i] = (F.sum(s).over(earlier) if kind in ("row_number", "count", "sum") else F.min(s).over(earlier) if kind == "min"
                      else F.max(s).over(earlier) if kind == "max" else F.lag(s).over(w) if kind == "lag"
                      else F.last(s, ignorenulls=True).over(earlier))
    borders = (states.withColumns({f"__c{i}": c for i, c in carried.items()} | {"__nth": F.row_number().over(w)})
               .where("__nth > 1").select("__bpid", *names, *[f"__c{i}" for i in carried]))
    # One row for each border that cuts a group: no more than there are partitions.
    out = inside.join(F.broadcast(borders), (F.col("__pid") == F.col("__bpid")) & _same([f"`{g}`" for g in group], names), "left")
    values = []
    for i, (name, (kind, _)) in enumerate(columns.items()):
        o, c = F.col(f"__own{i}"), F.col(f"__c{i}")
        values.append({"row_number": o + F.coalesce(c, F.lit(0)), "count": o + F.coalesce(c, F.lit(0)),
                       "sum": F.coalesce(o + c, o, c), "min": F.least(o, c), "max": F.greatest(o, c),
                       "lag": F.when(F.col("__first"), c).otherwise(o), "last": F.coalesce(o, c)}[kind].alias(name))
    return out.select(*[col(c) for c in placed.columns if c not in ("__pid", "__pos")], *values)


def ordered_window(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column],
                   columns: dict[str, tuple[str, str | None]]) -> DataFrame:
    """``df`` with running values per group, for groups of any size; rows alike in ``order_by`` go by a hash of the row.

    ``columns`` as in ``running``, such as ``{"N": ("row_number", None), "TOTAL": ("sum", "amount")}``.
    """
    tie = F.xxhash64(*hashable_columns(df))
    order = [col(c) for c in partition_by] + [col(c) if isinstance(c, str) else c for c in order_by] + [tie]
    return running(sort_stored(df, order, "window"), partition_by, columns)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_time: str, right_time: str,
              columns: dict[str, str], strict: bool = False, tolerance: Column | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Every row of ``left`` with the latest row of ``right`` of the same keys that is not later.

    ``keys``: pairs of column names; ``columns``: new name to column of ``right``.  ``strict``: only earlier rows, not those of the same
    time.  ``tolerance``: an interval; a row older than that is none.  Of right rows of one time the last by ``ties`` is
    the latest, then the one with the largest hash.  Rows of ``left`` without a match, or with a NULL key or time, keep NULLs; a NULL never matches.
    """
    present = lambda names: F.expr(" and ".join(f"`{n}` is not null" for n in names))
    lnames, rnames = [*[k for k, _ in keys], left_time], [*[k for _, k in keys], right_time]
    ks = [f"__k{i}" for i in range(len(keys))]
    key_types = left.limit(0).select(*lnames).union(right.limit(0).select(*rnames)).schema  # the types they compare in
    both = [*ks, "__at"]

    def side(df: DataFrame, names: Sequence[str], first: int, left_row: Column, right_row: Column, tie: Column) -> DataFrame:
        return df.select(*[col(c).cast(f.dataType).alias(n) for c, f, n in zip(names, key_types, both)], F.lit(first).alias("__side"),
                         left_row.alias("__left"), right_row.alias("__row"), tie.alias("__tie"))

    left_type = F.struct(*[col(c) for c in left.columns])
    carried = F.struct(col(right_time).alias("__when"), *[col(c).alias(n) for n, c in columns.items()])
    tie = F.struct(*[col(c) for c in ties], F.xxhash64(*hashable_columns(right)).alias("__hash"))
    types = [df.select(c.alias("c")).schema["c"].dataType for df, c in ((right, carried), (left, left_type), (right, tie))]
    known = side(right.where(present(rnames)), rnames, 0, F.lit(None).cast(types[1]), carried, tie)
    asked = side(left.where(present(lnames)), lnames, -1 if strict else 1, left_type, F.lit(None).cast(types[0]), F.lit(None).cast(types[2]))
    rows = known.unionByName(asked)
    placed = sort_stored(rows, [*both, "__side", "__tie"], "asof")
    latest = running(placed, ks, {"__last": ("last", "__row")}).where("__side <> 0")
    seen = F.col("__last")
    if tolerance is not None:
        seen = F.when(F.col("__at") - tolerance <= F.col("__last.__when"), seen)
    out = latest.select("__left.*", *[seen[n].alias(n) for n in columns])
    lost = left.where(~F.coalesce(present(lnames), F.lit(False)))
    return out.unionByName(lost.select("*", *[F.lit(None).cast(out.schema[n].dataType).alias(n) for n in columns]))
