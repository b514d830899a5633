"""Keyed upsert as one DataFrame plan: the new state of the target.

Per column, a matched row takes the source value when the column is updatable
and keeps the target value when it is not; an unmatched row keeps its own
side.  Keys use plain ``=``, so NULL keys never match.  The plan has two parts:

* updated target: ``target LEFT JOIN batch ON key`` gives every target row,
  updated where matched;
* inserts: ``batch LEFT ANTI (target keys)`` gives the batch rows with a new key.

With a small batch both joins broadcast the batch
and the target is never shuffled: the target key column is semi-joined with the
broadcast batch keys and de-duplicated, so the inserts' anti join sees at most
one row per batch row.  Otherwise both joins shuffle; the target is the streamed (left) side of
the left join, so AQE can split a partition made hot by a duplicated key or
many NULL keys, and the target keys are de-duplicated (map-side partial
aggregation) before the anti join's shuffle, so no key is hot there either.
A full outer join would shuffle less but AQE cannot split its skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import col
from ..spec import DEFAULT_UPDATE_EXCLUDE


def _resolve(names: Sequence[str], columns: Sequence[str], what: str) -> list[str]:
    by_upper = {c.upper(): c for c in columns}
    out = []
    for n in names:
        if n.upper() not in by_upper:
            raise ValueError(f"{what} column {n!r} not found among {list(columns)}")
        out.append(by_upper[n.upper()])
    return out


# Casts that keep every value: from a type to those after it in its row.
_WIDENING = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("tinyint", "smallint", "int", "double"),
             ("tinyint", "smallint", "float"), ("date", "timestamp"), ("date", "timestamp_ntz"))


def exact_cast(c: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    """``c`` cast to ``want``; the load fails on a value that the cast would change.

    A number, date or time must come back as it was from the target's type; a text must be one of its values.
    """
    a, b = have.simpleString(), want.simpleString()
    if a == b or a == "void" or b == "string" or any(a in row and b in row[row.index(a):] for row in _WIDENING):
        return c.cast(want)
    if not isinstance(have, T.AtomicType) or not isinstance(want, T.AtomicType):
        return c.cast(want)
    got = c.try_cast(want)
    same = got.isNotNull() if isinstance(have, T.StringType) else got.try_cast(have).eqNullSafe(c)
    message = F.concat(F.lit(f"column {name}: "), c.cast("string"), F.lit(f" ({a}) does not fit {b} without a change"))
    return F.when(c.isNull(), F.lit(None).cast(want)).when(same, got).otherwise(F.raise_error(message).cast(want))


def align_to(df: DataFrame, target_schema, fill_missing: bool = True) -> DataFrame:
    """Select ``df`` in the target's column order, by case-insensitive name,
    cast to the target's types by ``exact_cast``; absent columns become typed NULL."""
    have = {c.upper(): c for c in df.columns}
    extra = [c for c in df.columns if c.upper() not in {f.name.upper() for f in target_schema.fields}]
    if extra:
        raise ValueError(f"columns {extra} are not in the target")
    out = []
    for f in target_schema.fields:
        if f.name.upper() in have:
            own = have[f.name.upper()]
            out.append(exact_cast(col(own), df.schema[own].dataType, f.dataType, f.name).alias(f.name))
        elif fill_missing:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"source lacks target column {f.name!r}")
    return df.select(*out)


def _all_not_null(alias: str | None, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & col(k, alias).isNotNull()
    return cond


def merge_parts(target: DataFrame, source: DataFrame, keys: Sequence[str],
                update_columns: Sequence[str] | None = None,
                exclude: Sequence[str] | None = DEFAULT_UPDATE_EXCLUDE,
                strategy: str = "shuffle", partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(the target's rows after the upsert, the rows to insert), both in the target's layout.

    ``update_columns`` lists what a match may overwrite; when omitted it is
    every target column except ``exclude``.  Unmatched source rows are
    inserted whole; target columns the source lacks are NULL for them.
    ``strategy``: ``"shuffle"`` for a batch of any size; ``"small"`` plans for a
    batch that Catalyst is likely to broadcast, and leaves that to it;
    ``"broadcast"`` forces it, for a batch whose size the caller has checked.
    ``partitions=n`` hash-partitions the inserted rows into ``n`` by key, to
    match a target read as ``n`` buckets (the kept rows already are).
    """
    if not keys:
        raise ValueError("a merge needs at least one key column")
    if strategy not in ("shuffle", "small", "broadcast"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    schema = target.schema
    tkeys = _resolve(keys, target.columns, "key")
    src = align_to(source, schema)
    if update_columns is None:
        excl = {e.upper() for e in (exclude or ())}
        updatable = {c.upper() for c in target.columns if c.upper() not in excl}
    else:
        updatable = {c.upper() for c in _resolve(update_columns, target.columns, "update")}
    hinted = F.broadcast if strategy == "broadcast" else (lambda df: df)
    cond = None
    for k in tkeys:
        c = col(k, "t") == col(k, "s")
        cond = c if cond is None else cond & c
    right = hinted(src.withColumn("__matched", F.lit(True)))
    joined = target.alias("t").join(right.alias("s"), cond, "left")
    hit = F.col("s.__matched").isNotNull()
    kept = joined.select(*[
        (F.when(hit, col(f.name, "s")).otherwise(col(f.name, "t")) if f.name.upper() in updatable
         and f.name not in tkeys else col(f.name, "t")).alias(f.name)
        for f in schema.fields
    ])
    target_keys = target.select(*[col(k) for k in tkeys]).where(_all_not_null(None, tkeys))
    if strategy != "shuffle":
        # distinct matched keys: at most one per batch row, so as bounded as the batch
        # (without the distinct, a key duplicated in the target would repeat)
        target_keys = hinted(
            target_keys.join(hinted(src.select(*[col(k) for k in tkeys])), tkeys, "left_semi").distinct())
    else:
        target_keys = target_keys.distinct()
    inserts = src.join(target_keys, tkeys, "left_anti").select(*[col(f.name) for f in schema.fields])
    if partitions:
        inserts = inserts.repartition(partitions, *[col(k) for k in tkeys])
    return kept, inserts


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str], *args, **options) -> DataFrame:
    """New target state after upserting ``source`` on ``keys``; options as in ``merge_parts``."""
    kept, inserts = merge_parts(target, source, keys, *args, **options)
    return kept.unionByName(inserts)
