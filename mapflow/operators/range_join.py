"""Joins on range conditions: points in intervals, overlapping intervals, plain inequalities.

The distinct operand values of both sides are sorted in one order (equality keys first) over range
partitions, points between the interval ends that hold them.  A point takes as much room in it as it has rows, and every
end learns how much room lies before it: an interval is then a range of places, exactly the points
inside it, whatever the values' type or distribution.

Places are cut into blocks of ``LEAF``, blocks into groups of ``FAN``, and so on.  A
value with ``LEAF`` rows or more has a block of its own.  The rows themselves are filed: a point's row under its block of
every level that an interval uses, an interval's row under the few blocks that
make up its range: few for a short one, and coarse ones for a long one.  Each
pair meets in exactly one block, by an equality join, and is a row of the result there: no pair is stored or
sent.  Only blocks at an interval's ends hold points outside it, two ``LEAF`` of rows at most at each.  So what is shuffled and
written follows the input alone, and the work the input and the result, not the product.

Rows of either side without a partner (outer joins) come from such an order too: a point is
covered if more intervals have begun than ended before it; an interval is overlapped if, of those that begin before it
ends, the one that ends last ends after it begins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from .condition import Condition
from .ordered import running, sort_stored

LEAF, FAN_BITS = 64, 4
FAN = 1 << FAN_BITS


@dataclass(frozen=True)
class Bounds:
    """A point of one side between bounds of the other: operands as SQL text.

    ``flipped``: the point is the right side's.  A bound that is None is open to infinity.
    """

    flipped: bool
    point: str
    low: str | None
    low_closed: bool
    high: str | None
    high_closed: bool


def bounds_of(cond: Condition) -> list[Bounds] | None:
    """Disjoint containments that together are the range part of ``cond``; further inequalities stay to be checked.

    One operand between two of the other side is one containment.  Two operands on either side (overlap,
    ``a <= d and c <= b``) are two: ``a`` in ``[c, d]``, and ``c`` in ``(a, b]``.
    """
    if not cond.ranges:
        return None

    def within(point: str, flipped: bool) -> Bounds:
        at = 2 if flipped else 0
        low = high = None
        for r in cond.ranges:
            if r[at] == point:
                below = (r[1] in (">", ">=")) != flipped  # the other operand is the lower bound
                if below and low is None:
                    low = (r[0 if flipped else 2], "=" in r[1])
                elif not below and high is None:
                    high = (r[0 if flipped else 2], "=" in r[1])
        return Bounds(flipped, point, low and low[0], bool(low and low[1]), high and high[0], bool(high and high[1]))

    both = [b for at, flipped in ((0, False), (2, True)) for r in cond.ranges if (b := within(r[at], flipped)).low and b.high]
    if both:
        return both[:1]
    up = next((r for r in cond.ranges if r[1] in ("<", "<=")), None)
    down = next((r for r in cond.ranges if r[1] in (">", ">=")), None)
    if up and down:  # up: a <= d; down: b >= c
        (a, s1, d), (b, s2, c) = up, down
        return [Bounds(False, a, c, True, d, "=" in s1), Bounds(True, c, a, False, b, "=" in s2)]
    return [within(cond.ranges[0][0], False)]


def _common_type(a: DataFrame, x: str, b: DataFrame, y: str) -> T.DataType:
    """The type that Spark compares the two operands in."""
    s = a.select(F.expr(x).alias("v")).limit(0)
    t = b.select(F.expr(y).alias("v")).limit(0)
    kinds = [s.schema["v"].dataType, t.schema["v"].dataType]
    none = [F.lit(None).cast(k) for k in kinds]
    return s.sparkSession.range(0).select(F.coalesce(*none).alias("v")).schema["v"].dataType


class _Keyed:
    """The equalities of a range condition: ``k``, one column for each, in the types they compare in."""

    def __init__(self, sides: tuple[DataFrame, DataFrame], cond: Condition, at: tuple[int, int]):
        self.nullsafe = [e[1] == "<=>" for e in cond.equal]
        self.keys = [[e[i] for e in cond.equal] for i in at]
        self.k = [f"__k{i}" for i in range(len(cond.equal))]
        self.key_types = [_common_type(sides[0], a, sides[1], b) for a, b in zip(*self.keys)]

    def values(self, df: DataFrame, side: int, operands: dict[str, tuple[str, T.DataType]]) -> DataFrame:
        """Operand values of one side in their common types; rows that cannot match are left out."""
        out = df.select(*[F.expr(x).cast(t).alias(n) for x, t, n in zip(self.keys[side], self.key_types, self.k)],
                        *[F.expr(x).cast(t).alias(n) for n, (x, t) in operands.items()])
        must = [*operands, *[n for n, safe in zip(self.k, self.nullsafe) if not safe]]
        return out.dropna(subset=must) if must else out

    def on(self, side: int, table: DataFrame, operands: dict[str, tuple[str, T.DataType]]) -> Column:
        cond = F.lit(True)
        for x, t, n, safe in zip(self.keys[side], self.key_types, self.k, self.nullsafe):
            v = F.expr(x).cast(t)
            cond = cond & (v.eqNullSafe(table[n]) if safe else v == table[n])
        for n, (x, t) in operands.items():
            cond = cond & (F.expr(x).cast(t) == table[n])
        return cond


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class RangeMatch:
    """The operand values of two sides, and how their rows meet, under ``bounds`` and the equalities of ``cond``."""

    def __init__(self, left: DataFrame, right: DataFrame, cond: Condition, bounds: Bounds):
        self.bounds = bounds
        self._pairs: DataFrame | None = None
        self.rows = points, spans = (right, left) if bounds.flipped else (left, right)
        self.keyed = _Keyed(self.rows, cond, (2, 0) if bounds.flipped else (0, 2))
        self.k = self.keyed.k
        ends = [x for x in (bounds.low, bounds.high) if x]
        # With two bounds of different types, the widest of all three.
        kind = _common_type(points, bounds.point, spans, ends[0])
        if len(ends) == 2:
            kind = points.sparkSession.range(0).select(F.coalesce(*[F.lit(None).cast(t) for t in (
                kind, _common_type(points, bounds.point, spans, ends[1]))]).alias("v")).schema["v"].dataType
        self.operands = ({"__x": (bounds.point, kind)}, {n: (x, kind) for n, x in (("__lo", bounds.low), ("__hi", bounds.high)) if x})
        some_points = self.keyed.values(points, 0, self.operands[0]).groupBy(*self.k, "__x").agg(F.count("*").alias("__n"))
        some_spans = self.keyed.values(spans, 1, self.operands[1]).distinct()
        none = F.lit(None).cast(kind)
        some_spans = some_spans.withColumns({c: none for c in ("__lo", "__hi") if c not in some_spans.columns})
        if bounds.low and bounds.high:
            order = F.col("__lo") < F.col("__hi")
            some_spans = some_spans.where(order | (F.col("__lo") == F.col("__hi")) & F.lit(bounds.low_closed and bounds.high_closed))
        # A value of LEAF rows or more takes two blocks of room, so that one whole block lies in it.
        room = F.when(F.col("__n") < LEAF, F.col("__n")).otherwise(F.lit(2 * LEAF).cast("bigint"))
        no_room = F.lit(None).cast("bigint")
        # In the order: points between the ends that hold them.  __inf: -1 and 1 for the ends that are open to infinity.
        self.order = sort_stored(
            some_points.select(*self.k, F.lit(0).alias("__inf"), F.col("__x").alias("__v"), F.lit(1).alias("__tag"), F.lit(0).alias("__what"),
                               none.alias("__lo"), none.alias("__hi"), room.alias("__room"))
            .union(some_spans.select(*self.k, F.lit(0 if bounds.low else -1), "__lo", F.lit(0 if bounds.low_closed else 2), F.lit(1), "__lo", "__hi", no_room))
            .union(some_spans.select(*self.k, F.lit(0 if bounds.high else 1), "__hi", F.lit(2 if bounds.high_closed else 0), F.lit(2), "__lo", "__hi", no_room)),
            [*self.k, "__inf", "__v", "__tag"], "range-join")
        flags = self.order.select("*", *[F.when(F.col("__what") == i, 1).alias(n) for i, n in ((1, "__at1"), (2, "__at2"))])
        counted = running(flags, [], {"__taken": ("sum", "__room"), "__begun": ("count", "__at1"), "__ended": ("count", "__at2")})
        before = F.coalesce(F.col("__taken"), F.lit(0)) - F.coalesce(F.col("__room"), F.lit(0))
        counted = counted.withColumn("__before", before)
        own_block = F.expr(f"(__before + {LEAF - 1}L) div {LEAF}L * {LEAF}L")
        self.points = _stored(counted.where("__what = 0").select(
            *self.k, F.col("__v").alias("__x"), F.when(F.col("__room") < LEAF, F.col("__before")).otherwise(own_block).alias("__place"),
            (F.col("__begun") > F.col("__ended")).alias("__covered")), "range-points")
        self.spans = _stored(counted.where("__what > 0").groupBy(*self.k, "__lo", "__hi")
                             .agg(*[F.max(F.when(F.col("__what") == i, F.col("__before"))).alias(n) for i, n in ((1, "__from"), (2, "__to"))])
                             .where("__from < __to"), "range-spans")
        total = self.order.agg(F.sum("__room")).first()[0] or 0
        top = 0
        while LEAF * FAN ** top < total:
            top += 1
        # Blocks [a, z) hold the range; whole groups of them, [up_a, up_z) of the next level, are listed there.
        list_ = lambda a, z: f"if({a} < {z}, sequence({a}, {z} - 1L), cast(array() as array<bigint>))"
        up = lambda i: (f"shiftright(__from div {LEAF}L + shiftleft(1L, {FAN_BITS} * ({i})) - 1L, {FAN_BITS} * ({i}))",
                        f"shiftright((__to - 1L) div {LEAF}L + 1L, {FAN_BITS} * ({i}))")
        (a, z), (up_a, up_z) = up("i"), up("i + 1")
        own = (f"if(i < {top} and {up_a} < {up_z}, concat({list_(a, f'shiftleft({up_a}, {FAN_BITS})')}, {list_(f'shiftleft({up_z}, {FAN_BITS})', z)}), "
               f"{list_(a, z)})")
        # A block's name: its number and its level, in one.
        self._span_blocks = f"flatten(transform(sequence(0, {top}), i -> transform({own}, b -> b * {FAN}L + i)))"
        used = self.spans.select(F.explode(F.expr(f"array_distinct(transform({self._span_blocks}, b -> b % {FAN}L))")).alias("i")).distinct().collect()
        levels = ", ".join(f"{r['i']}" for r in sorted(used)) or "0"
        self._point_blocks = f"transform(array({levels}), i -> shiftright(__place div {LEAF}L, cast({FAN_BITS} * i as int)) * {FAN}L + i)"

    def on_point(self, table: DataFrame) -> Column:
        return self.keyed.on(0, table, self.operands[0])

    def on_span(self, table: DataFrame) -> Column:
        return self.keyed.on(1, table, self.operands[1])

    def meet(self, text: str) -> DataFrame:
        """Joined rows: the left side's columns, then the right side's, under their aliases; ``text`` is checked."""
        points, spans = self.points.where("__covered").drop("__covered"), self.spans
        points = self._filed_points(self.rows[0].join(points, self.on_point(points)).drop(*self.k, "__x"))
        spans = self._filed_spans(self.rows[1].join(spans, self.on_span(spans)).drop(*self.k, "__lo", "__hi"))
        met = self._met(*((spans, points) if self.bounds.flipped else (points, spans)))
        return met.where(F.expr(text)).drop("__at", "__place", "__in", "__from", "__to")

    def pairs(self) -> DataFrame:
        """Matching values: the keys, ``__x``, ``__lo``, ``__hi``; each pair once.  Written when asked for the first time."""
        if self._pairs is None:
            spans = self.spans.select(*[F.col(c).alias(f"s{c}") for c in self.k], "__lo", "__hi", "__from", "__to")
            self._pairs = _stored(self._met(self._filed_points(self.points), self._filed_spans(spans)).select(*self.k, "__x", "__lo", "__hi"), "range-pairs")
        return self._pairs.select("*")

    def _filed_points(self, rows: DataFrame) -> DataFrame:
        return rows.select("*", F.explode(F.expr(self._point_blocks)).alias("__at"))

    def _filed_spans(self, rows: DataFrame) -> DataFrame:
        return rows.select("*", F.explode(F.expr(self._span_blocks)).alias("__in"))

    @staticmethod
    def _met(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, F.expr("__at = __in and __place >= __from and __place < __to"))


def without_overlap(own: DataFrame, others: DataFrame, cond: Condition, side: int, own_only: Column) -> DataFrame:
    """``own``, rows of the left (0) or right (1) side, without those that ``others`` meet.

    ``cond``: equalities and two inequalities, ``a <= d`` and ``b >= c``, of which one has its greater operand on the left and one on the right.
    A row is met if the largest end of the others that begin before it ends is not before its own begin; inverted rows too.
    """
    up = next(r for r in cond.ranges if r[1] in ("<", "<="))
    down = next(r for r in cond.ranges if r[1] in (">", ">="))
    (first, begins), (last, ends) = ((up, up[0]), (down, down[0])) if side == 0 else ((down, down[2]), (up, up[2]))
    their_ends, their_begins = (up[2], down[2]) if side == 0 else (down[0], up[0])
    keyed = _Keyed((own, others), cond, (0, 2) if side == 0 else (2, 0))
    by, at = (_common_type(own, x, others, y) for x, y in ((begins, their_ends), (ends, their_begins)))
    operands = {"__begins": (begins, by), "__ends": (ends, at)}
    mine = keyed.values(own.where(own_only), 0, operands).distinct()
    theirs = keyed.values(others, 1, {"__at": (their_begins, at), "__far": (their_ends, by)}).groupBy(*keyed.k, "__at").agg(F.max("__far").alias("__far"))
    none = F.lit(None).cast(by)
    placed = sort_stored(mine.select(*keyed.k, F.col("__ends").alias("__at"), F.lit(1).alias("__tag"), "__begins", none.alias("__far"))
                         .union(theirs.select(*keyed.k, "__at", F.lit(0 if "=" in last[1] else 2), none, "__far")), [*keyed.k, "__at", "__tag"], "range-overlap")
    reached = running(placed, keyed.k, {"__reach": ("max", "__far")}).where("__tag = 1")
    met = reached.where(F.expr(f"__reach {'>=' if '=' in first[1] else '>'} __begins")).select(*keyed.k, "__begins", F.col("__at").alias("__ends"))
    return own.join(met, keyed.on(0, met, operands) & own_only, "left_anti")
