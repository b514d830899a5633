"""Aggregates that are kept up to date: a load merges mergeable states and never reads old rows again.

Every group has one row of states.  Counts, sums, minima and maxima are their own states; approximate distinct
counts (of the values' texts) and quantiles are Spark's HLL and KLL sketches, which merge.  A batch is
aggregated first (combined in its tasks, so a hot group is one row per task), and only its groups' states meet the stored
ones: the states sit in a ``PartitionedTable``, and a load reads and rewrites the partitions that its groups touch.

Group columns may be NULL and then form a group.  NULL values count for nothing; a group without any value has a NULL sum,
minimum, maximum and quantile and a distinct count of 0.  A batch with a tag is merged once, however often it is replayed.
A row can be added but not taken out: minima, maxima and sketches cannot forget.  Sums of doubles depend on the order of
addition in their last digits, so give decimals where sums have to be exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import col
from ..sources.partitions import PartitionedTable

KINDS = ("count", "sum", "min", "max", "avg", "distinct", "quantile")


@dataclass(frozen=True)
class Measure:
    """``kind`` of the SQL expression ``expr`` as the column ``name``; ``count`` of ``*`` counts rows.

    ``share`` is a quantile's rank, from 0 to 1; ``accuracy`` is a sketch's size: lgConfigK of the HLL, k of the KLL.
    """

    name: str
    kind: str
    expr: str = "*"
    share: float = 0.5
    accuracy: int | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown measure {self.kind!r}; one of {KINDS}")
        if self.expr == "*" and self.kind != "count":
            raise ValueError(f"{self.kind} needs an expression")

    def states(self) -> dict[str, tuple]:
        """The state columns: what starts each from rows, and what merges it."""
        s = f"__{self.name}"
        value = F.lit(1) if self.expr == "*" else F.expr(self.expr)
        if self.kind == "count":
            return {s: (F.count(value), F.sum)}
        if self.kind in ("sum", "min", "max"):
            f = {"sum": F.sum, "min": F.min, "max": F.max}[self.kind]
            return {s: (f(value), f)}
        if self.kind == "avg":
            return {f"{s}_n": (F.count(value), F.sum), f"{s}_sum": (F.sum(value), F.sum)}
        if self.kind == "distinct":
            k = self.accuracy or 12
            return {s: (F.hll_sketch_agg(value.cast("string"), k), F.hll_union_agg)}
        k = self.accuracy or 200
        return {s: (F.kll_sketch_agg_double(value.cast("double"), k), lambda c: F.kll_merge_agg_double(c, k))}

    def result(self):
        s = F.col(f"`__{self.name}`")
        if self.kind == "avg":
            return F.try_divide(F.col(f"`__{self.name}_sum`"), F.col(f"`__{self.name}_n`"))
        if self.kind == "distinct":
            return F.hll_sketch_estimate(s)
        if self.kind == "quantile":
            return F.when(F.kll_sketch_get_n_double(s) > 0, F.kll_sketch_get_quantile_double(s, F.lit(float(self.share))))
        return s


class Rollup:
    """States per ``group_by`` at ``path``, partitioned by ``partition_by`` (some of the group columns)."""

    def __init__(self, spark: SparkSession, path: str, group_by: Sequence[str], measures: Sequence[Measure], partition_by: Sequence[str]):
        if missing := {c.upper() for c in partition_by} - {c.upper() for c in group_by}:
            raise ValueError(f"partition columns {sorted(missing)} are not group columns: a group could sit in another partition")
        names = [*group_by, *(m.name for m in measures)]
        if len({n.upper() for n in names}) < len(names):
            raise ValueError(f"group columns and measures clash: {names}")
        self.group_by, self.measures = list(group_by), list(measures)
        self.table = PartitionedTable(spark, path, partition_by)

    def _states(self) -> dict[str, tuple]:
        return {n: fs for m in self.measures for n, fs in m.states().items()}

    def load(self, batch: DataFrame, tag: str | None = None) -> None:
        """Merge the states of ``batch``'s rows into the stored ones; one that was merged under ``tag`` is skipped."""
        groups, states = [col(g).alias(g) for g in self.group_by], self._states()
        new = batch.groupBy(*groups).agg(*[start.alias(n) for n, (start, _) in states.items()])

        def merged(old: DataFrame, added: DataFrame) -> DataFrame:
            both = old.unionByName(added)
            return both.groupBy(*groups).agg(*[merge(col(n)).alias(n) for n, (_, merge) in states.items()])

        self.table.combine(new, merged, tag)

    def read(self) -> DataFrame:
        """One row per group with the measures' values."""
        return self.table.read().select(*[col(g) for g in self.group_by], *[m.result().alias(m.name) for m in self.measures])

    def roll_up(self, group_by: Sequence[str]) -> DataFrame:
        """The measures of coarser groups, from the states alone."""
        if extra := {c.upper() for c in group_by} - {c.upper() for c in self.group_by}:
            raise ValueError(f"{sorted(extra)} are not group columns of this rollup")
        states = self._states()
        rows = self.table.read().groupBy(*[col(g).alias(g) for g in group_by]).agg(*[merge(col(n)).alias(n) for n, (_, merge) in states.items()])
        return rows.select(*[col(g) for g in group_by], *[m.result().alias(m.name) for m in self.measures])
