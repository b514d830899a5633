"""Join chain of a model: each join row adds one relation under its alias.

The condition goes to Catalyst, which hashes or sort-merges on any equality of
expressions of the two sides; AQE re-checks broadcasts at runtime and splits skewed
partitions.  The guard looks at the operator Spark plans, not at the text: a
Cartesian product is refused, and so is a nested loop unless the joined side
is known to be small (``THETA_MAX_BYTES``).  Joins with no condition at all are refused.

AQE splits a skewed partition on the left side of a LEFT join and on either
side of an INNER join, but never the right side of a LEFT join nor any side of
a FULL join.  RIGHT and FULL joins, and LEFT joins whose joined side is too large
to broadcast, are therefore planned (``skew="auto"`` or ``"split"``; not ``"none"``)
as the inner join (both sides splittable) plus, per preserved side, that side
anti-joined with the other (null-padded).  The anti join's other side is filtered by its own
conditions and reduced to its distinct key values first, so a key held
by a third of the rows arrives as one row per task.  The parts are unioned;
the result equals the outer join, at the cost of reading both sides twice.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from functools import reduce

from ..functions.expressions import qualify_join_lhs, rewrite_main
from ..spec import JoinSpec
from .condition import analyse
from .range_join import RangeMatch, bounds_of, without_overlap

# Join words a mapping may use, and the Spark join type of each.
JOIN_TYPES = {
    "LEFT": "left",
    "LEFT OUTER": "left",
    "INNER": "inner",
    "RIGHT": "right",
    "RIGHT OUTER": "right",
    "FULL": "full_outer",
    "FULL OUTER": "full_outer",
}

# A range condition against a joined side within these bounds (a lookup table) is looped over:
# cheaper than sorting both sides.  Beyond them ``range_join`` gives the same rows.
LOOKUP_MAX_BYTES = 64 * 1024
LOOKUP_MAX_ROWS = 1_000
# Largest joined side for a condition with neither an equality nor a range of the two sides
# (``<>``, LIKE, a function of both), in which each row has to meet each row of the lookup table.  The bytes are
# Catalyst's estimate; rows are counted (up to the bound) only where it has none, as for local data.
THETA_MAX_BYTES = 10 * 1024 * 1024
THETA_MAX_ROWS = 10_000


class JoinError(ValueError):
    pass


def spark_join_type(word: str) -> str:
    w = " ".join((word or "LEFT").upper().split())
    if w == "CROSS":
        raise JoinError("CROSS joins are not supported: a product of two tables does not scale")
    if w not in JOIN_TYPES:
        raise JoinError(f"unknown join type {word!r}; use one of {sorted(JOIN_TYPES)}")
    return JOIN_TYPES[w]


def size_estimate(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan in bytes; reads no rows."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def known_small(df: DataFrame, max_bytes: int, max_rows: int) -> bool:
    """True when ``df`` is within ``max_bytes`` by its estimate, or has no estimate and few rows."""
    size = size_estimate(df)
    if size < int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()):
        return size <= max_bytes
    return df.limit(max_rows + 1).count() <= max_rows


def planned_operators(df: DataFrame) -> list[str]:
    """Names of the join operators Spark plans, without running anything."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|BroadcastHashJoin|ShuffledHashJoin|SortMergeJoin", plan)


def _loops(left: DataFrame, right: DataFrame, joined: DataFrame) -> bool:
    """Whether Spark plans a nested loop or a product for the join itself."""
    before, after = Counter(planned_operators(left)) + Counter(planned_operators(right)), Counter(planned_operators(joined))
    return any(after[x] > before[x] for x in ("CartesianProduct", "BroadcastNestedLoopJoin"))


def apply_join(left: DataFrame, right: DataFrame, join: JoinSpec, main_alias: str = "source",
               theta_max_bytes: int = THETA_MAX_BYTES, theta_max_rows: int = THETA_MAX_ROWS) -> DataFrame:
    how = spark_join_type(join.how)
    if not join.condition or not join.condition.strip():
        raise JoinError(f"join to {join.table.name} AS {join.alias} has no condition; "
                        "a product of two tables is not supported")
    text = qualify_join_lhs(rewrite_main(join.condition, main_alias), main_alias)
    right = right.alias(join.alias)
    joined = left.join(right, F.expr(text), how)
    if _loops(left, right, joined):
        cond = analyse(left, right, text)
        if not cond.either and how in ("inner", "left"):
            limits = (LOOKUP_MAX_BYTES, LOOKUP_MAX_ROWS) if cond.ranges else (theta_max_bytes, theta_max_rows)
            if known_small(right, *limits):
                return left.join(F.broadcast(right), F.expr(text), how)
        if not cond.either and not cond.ranges:
            raise JoinError(f"join to {join.alias} would compare every row with every row: it has neither an equality nor a range "
                            f"of the two sides, and is not an INNER or LEFT join to a side known to be under {theta_max_bytes} bytes")
        return outer_join(left, right, text, how)
    if join.skew != "none" and (how in ("right", "full_outer") or how == "left" and (join.skew == "split" or _too_large(right))):
        return outer_join(left, right, text, how)
    return joined


def _too_large(right: DataFrame) -> bool:
    """True when Spark would not broadcast ``right`` by its estimate."""
    limit = right.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size_estimate(right) > int(limit)


def outer_join(left: DataFrame, right: DataFrame, text: str, how: str) -> DataFrame:
    """``left <how> JOIN right`` as the inner join plus, per preserved side, its null-padded rows without a match.

    ``right`` is under its alias.
    """
    match = Match(left, right, text)
    parts = [match.inner()]
    if how in ("left", "full_outer"):
        parts.append(match.unmatched(0).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]))
    if how in ("right", "full_outer"):
        parts.append(match.unmatched(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields], "*"))
    return reduce(DataFrame.union, parts)


class Match:
    """How the rows of two sides meet under an ON condition, in plans without a nested loop.

    * An equality of the two sides: Spark's own join.  Conditions on one side alone filter that side first.
    * A disjunction: one join per alternative, each without the rows that an earlier
      alternative joins (``NOT coalesce(earlier, false)``), so no pair comes twice and none has to be removed.
    * A range: ``range_join``.
    """

    def __init__(self, left: DataFrame, right: DataFrame, text: str):
        self.sides = (left, right)
        self.text = text
        self.cond = analyse(left, right, text)
        plain = left.join(right, F.expr(text), "inner")
        self.kind = ("equi" if not _loops(left, right, plain) else "either" if self.cond.either else "range" if self.cond.ranges else None)
        if self.kind is None:
            raise JoinError(f"a part of the condition has neither an equality nor a range of the two sides: {text}")
        if self.kind == "either":
            part, alternatives = self.cond.either[0]
            rest = [f"({p})" for p in self.cond.parts if p is not part]
            tried = [f"NOT coalesce(({a}), false)" for a in alternatives]
            self.any = [Match(left, right, " AND ".join([f"({a})", *rest])) for a in alternatives]
            self.once = [Match(left, right, " AND ".join([f"({a})", *rest, *tried[:i]])) for i, a in enumerate(alternatives)]
        elif self.kind == "range":
            self.narrow = tuple(reduce(DataFrame.where, map(F.expr, only), side)
                                for side, only in zip(self.sides, (self.cond.left_only, self.cond.right_only)))
            self.matches = [RangeMatch(*self.narrow, self.cond, b) for b in bounds_of(self.cond)]

    def inner(self) -> DataFrame:
        """Joined rows: the left side's columns, then the right side's, under their aliases."""
        if self.kind == "equi":
            return self.sides[0].join(self.sides[1], F.expr(self.text), "inner")
        if self.kind == "either":
            return reduce(DataFrame.union, [m.inner() for m in self.once])
        both = " AND ".join(f"({p})" for p in self.cond.parts if p not in (*self.cond.left_only, *self.cond.right_only))
        return reduce(DataFrame.union, [m.meet(both) for m in self.matches])

    def unmatched(self, side: int) -> DataFrame:
        """Rows of the left (0) or right (1) side that meet none of the other's."""
        own, other = self.sides[side], self.sides[1 - side]
        own_only = reduce(lambda a, b: a & b, map(F.expr, (self.cond.left_only, self.cond.right_only)[side]), F.lit(True))
        other_only = (self.cond.right_only, self.cond.left_only)[side]
        if self.kind == "either":
            for m in self.any:
                own = m._unmatched_of(own, side)
            return own
        return self._unmatched_of(own, side, own_only, other_only)

    def _unmatched_of(self, own: DataFrame, side: int, own_only=None, other_only=None) -> DataFrame:
        """``own``, some rows of a side, without those that meet a row of the other side."""
        if own_only is None:
            own_only = reduce(lambda a, b: a & b, map(F.expr, (self.cond.left_only, self.cond.right_only)[side]), F.lit(True))
            other_only = (self.cond.right_only, self.cond.left_only)[side]
        other = reduce(DataFrame.where, map(F.expr, other_only), self.sides[1 - side])
        if self.kind == "either":
            return reduce(lambda rows, m: m._unmatched_of(rows, side), self.any, own)
        if self.kind == "equi":
            if self.cond.residual or self.cond.ranges or not self.cond.equal:
                return own.join(other, F.expr(self.text), "left_anti")
            # The other side's distinct keys are enough, so a key held by a third of its rows arrives as one row per task.
            keys = other.select(*[F.expr(e[0 if side else 2]).alias(f"__j{i}") for i, e in enumerate(self.cond.equal)]).distinct()
            on = own_only
            for i, e in enumerate(self.cond.equal):
                a, b = F.expr(e[2 if side else 0]), keys[f"__j{i}"]
                on = on & (a.eqNullSafe(b) if e[1] == "<=>" else a == b)
            return own.join(keys, on, "left_anti")
        m = self.matches[0]
        own_is_point = m.bounds.flipped == bool(side)
        if len(self.matches) == 1 and not self.cond.residual and len(self.cond.ranges) == bool(m.bounds.low) + bool(m.bounds.high):
            # The sorted order says which values are matched at all; the pairs are not needed.
            met = m.points.where("__covered") if own_is_point else m.spans
            return own.join(met, (m.on_point if own_is_point else m.on_span)(met) & own_only, "left_anti")
        if len(self.matches) == 2 and not self.cond.residual and len(self.cond.ranges) == 2:
            return without_overlap(own, other, self.cond, side, own_only)
        for m in self.matches:
            pairs = m.pairs()
            own_is_point = m.bounds.flipped == bool(side)
            on_own, on_other = (m.on_point, m.on_span) if own_is_point else (m.on_span, m.on_point)
            met = pairs.join(other, on_other(pairs))
            own = own.join(met, on_own(pairs) & F.expr(self.text), "left_anti")
        return own


def split_outer_join(left: DataFrame, right: DataFrame, cond: str, how: str, right_alias: str) -> DataFrame:
    """``left <how> JOIN right`` as inner join plus null-padded anti joins."""
    return outer_join(left, right, cond, how)
