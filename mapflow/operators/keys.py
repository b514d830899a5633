"""Merge keys: choosing them, checking them, and numbering new rows.

* ``choose_merge_key`` picks the key of an incremental model from names only.
* ``duplicate_keys`` / ``assert_unique_keys`` check the data before a merge:
  one ``groupBy`` with map-side partial counting, so a hot key costs one row
  per task in the shuffle.
* ``discover_keys`` finds the minimal unique column sets of a table's data.
* ``assign_surrogate_keys`` numbers rows densely by an order, after the
  current maximum, without a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..fixed_values import KEY_CODE_SUFFIX, KEY_ID_NAMES, KEY_ID_SUFFIXES
from ..functions.expressions import col, quote
from ..session import scratch_dir
from ..spec import ModelSpec


def choose_merge_key(columns: Sequence[str], declared: Sequence[str] | None = None,
                     previous: Sequence[str] | None = None, sheet_key: Sequence[str] | str | None = None,
                     primary: Sequence[str] | None = None) -> list[str]:
    """First non-empty of: declared keys, keys kept from an earlier parse, the
    sheet's key cell (comma separated), every ``*_CD`` column, every ``*_ID`` /
    ``*_KEY`` / ``ID`` / ``KEY`` column, primary keys, the first column."""
    def clean(v):
        if v is None:
            return []
        if isinstance(v, str):
            v = v.split(",")
        return [k.strip() for k in v if k and k.strip()]

    for cand in (clean(declared), clean(previous), clean(sheet_key)):
        if cand:
            return cand
    cd = [c for c in columns if c.upper().endswith(KEY_CODE_SUFFIX)]
    if cd:
        return cd
    ids = [c for c in columns if c.upper().endswith(KEY_ID_SUFFIXES) or c.upper() in KEY_ID_NAMES]
    if ids:
        return ids
    if clean(primary):
        return clean(primary)
    return list(columns[:1])


def with_merge_key(spec: ModelSpec, kept: Sequence[str] | None = None) -> ModelSpec:
    """An incremental spec with its merge key chosen by ``choose_merge_key``
    over the target column names.  Declared keys win, then ``kept`` ones (declared for an
    earlier load of the table), then the sheet's."""
    if spec.materialization != "incremental":
        return spec
    names = [c.target for c in spec.columns if not c.is_artefact]
    return spec.with_(unique_key=tuple(choose_merge_key(names, spec.unique_key, kept, spec.sheet_key, spec.primary_key)))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "DUP_CNT",
                   names: Sequence[str] | None = None) -> DataFrame:
    """Key values that occur more than once, with their count."""
    out_names = list(names) if names else list(keys)
    return (df.groupBy(*[col(k).alias(n) for k, n in zip(keys, out_names)])
              .agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


class DuplicateKeyError(ValueError):
    pass


def key_profile(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(row count, largest count of one non-NULL key) in one aggregation job.

    Counts are combined map-side per key, so a hot key costs one row per task
    in the shuffle; the second, global aggregate sees one row per key group.
    """
    present = F.lit(True)
    for k in keys:
        present = present & col(k).isNotNull()
    per_key = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__cnt"))
    per_key = per_key.select("__cnt", present.alias("__present"))
    row = per_key.agg(F.sum("__cnt").alias("rows"),
                      F.max(F.when(F.col("__present"), F.col("__cnt"))).alias("dup")).first()
    return int(row["rows"] or 0), int(row["dup"] or 0)


def assert_unique_keys(df: DataFrame, keys: Sequence[str], sample: int = 5, what: str = "merge input") -> None:
    """Fail when a non-NULL key value occurs twice (NULL keys never match anyway)."""
    present = df.where(F.expr(" AND ".join(f"{quote(k)} IS NOT NULL" for k in keys))) if keys else df
    dups = duplicate_keys(present, keys).take(sample)
    if dups:
        raise DuplicateKeyError(f"{what} has duplicate keys {list(keys)}, e.g. {[tuple(r) for r in dups]}")


def discover_keys(df: DataFrame, columns: Sequence[str] | None = None, max_size: int = 3, rsd: float = 0.02) -> list[list[str]]:
    """Minimal sets of columns (at most ``max_size``) whose values are present and unique in every row, smallest first.

    Level by level: one job per level estimates the distinct values of all candidate sets (mergeable sketches, so
    nothing is shuffled but the sketches), and only sets whose estimate is within its error of the row count are counted exactly, by
    a grouping that stops at the first duplicate.  Supersets of a key are never tried, nor are sets
    whose columns' estimates multiply to less than the rows.  An empty table has no key.
    """
    names = list(columns or df.columns)
    stats = df.agg(F.count("*"), *[F.count(col(c)) for c in names], *[F.approx_count_distinct(F.xxhash64(*hashable_columns(df.select(col(c)))), rsd)
                                                                    for c in names]).first()
    rows, filled, distinct = stats[0], stats[1:len(names) + 1], dict(zip(names, stats[len(names) + 1:]))
    names = [c for c, n in zip(names, filled) if n == rows > 0]
    slack = 1 - 6 * rsd
    found: list[list[str]] = []
    for size in range(1, max_size + 1):
        sets = []
        for c in combinations(names, size):
            if any(set(k) <= set(c) for k in found):
                continue
            room = 1.0
            for x in c:
                room *= distinct[x] / slack
            if room >= rows:
                sets.append(list(c))
        if not sets:
            continue
        if size > 1:
            seen = df.agg(*[F.approx_count_distinct(F.xxhash64(*hashable_columns(df.select(*map(col, c)))), rsd) for c in sets]).first()
            sets = [c for c, n in zip(sets, seen) if n >= slack * rows]
        else:
            sets = [c for c in sets if distinct[c[0]] >= slack * rows]
        found += [c for c in sets if not duplicate_keys(df, c).take(1)]
    return found


def hashable_columns(df: DataFrame) -> list:
    """All columns in a form that hashes; maps, which have no order, enter as text of their sorted entries."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "map":
            out.append(F.to_json(F.sort_array(F.map_entries(col(f.name)))))
        else:
            out.append(F.to_json(col(f.name)) if "map<" in f.dataType.simpleString() else col(f.name))
    return out


def assign_surrogate_keys(df: DataFrame, order_by: Sequence[str], sk_col: str, start_after: int | None = 0,
                          num_partitions: int | None = None, path: str | None = None) -> DataFrame:
    """Add ``sk_col`` = start_after + dense position of each row by ``order_by``.

    Range-partition and sort by the order plus a hash of the whole row as tie
    breaker (so one order value held by many rows spreads over adjacent
    partitions instead of landing in one, and ties number reproducibly), then
    write the rows as Parquet to the shared checkpoint folder (``path``, for a
    caller that removes it after use) with their partition and place in it, so
    both passes below read one and the same numbering even if executors are
    lost.  Pass 1 counts rows per partition (one row per partition reaches the
    offset window); pass 2 adds the partition's offset to the place.  No row
    crosses the network after the range shuffle.  Partitions follow
    ``spark.sql.shuffle.partitions`` unless given.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, "surrogate")
    start = int(start_after or 0)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [col(c) for c in order_by] + [F.xxhash64(*hashable_columns(df)).alias("__tie")]
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ordered.select("*", F.spark_partition_id().alias("__pid"),
                   F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__pos")).write.parquet(path)
    placed = spark.read.parquet(path)
    counts = placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = counts.select("__pid", (F.sum("__cnt").over(Window.orderBy("__pid")) - F.col("__cnt")).alias("__off"))
    sk = (F.lit(start) + F.col("__off") + F.col("__pos") + F.lit(1)).cast("bigint")
    return placed.join(F.broadcast(offsets), "__pid").select(*[col(c) for c in df.columns], sk.alias(sk_col))
