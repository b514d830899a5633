"""Loads: how a model's rows reach its target table.

| load            | effect                                                          |
| --------------- | --------------------------------------------------------------- |
| truncate_load   | new version holding exactly the model's rows                    |
| lnd_load        | landing projection (source-flavour audit), then as truncate     |
| incremental     | with a key: keyed merge; without: append (duplicates possible)  |
| insert          | append aligned by name; target columns the source lacks -> NULL |

Every write goes through ``TableStore``: replacing loads write a new version
and never touch the files a reader (or the merge itself) is reading.  A merge
input is first written as Parquet to a fresh folder under the shared
checkpoint root, so the duplicate-key check and the merge read the same rows,
the input (often a delta over the whole target) is computed once, and a lost
executor recomputes from files, not from the lineage.  The staged folder is
removed when the load has committed.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.audit import RunContext
from ..functions.expressions import col
from ..session import scratch_dir
from ..sources.store import ABSENT, MAX_PARTS, Snapshot, TableNotFound, TableStore, remove_path
from ..spec import DEFAULT_UPDATE_EXCLUDE, ModelSpec
from .conform import landing_projection
from .join import size_estimate
from .keys import assert_unique_keys, assign_surrogate_keys, key_profile
from .merge import align_to, merge_parts

def stage(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh folder in the shared checkpoint root; read it back."""
    path = scratch_dir(df.sparkSession, "stage")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path), path


def load_truncate(store: TableStore, table: str, df: DataFrame,
                  bucket_by: tuple[Sequence[str], int] | None = None, sequence: str | None = None,
                  order_by: Sequence[str] = (), base: Snapshot | None = None) -> DataFrame:
    """Replace the table's rows; ``sequence`` as in ``load_append``, numbered on and not from 1.

    Like TRUNCATE and INSERT, it drops whatever the table holds at the commit; with ``base``, the version that the rows were made
    from, rows loaded since then make it fail instead.
    """
    if sequence and base is None:
        base = store.snapshot(table) or ABSENT  # numbers given out meanwhile must not come twice
    with numbered(df, sequence, order_by, last_number(store, table, sequence, base)) as (rows, tags):
        store.overwrite(table, rows, bucket_by, base=base, tags=tags)
    return store.read(table)


def _mark(column: str) -> str:
    return f"sequence:{column.upper()}"


def last_number(store: TableStore, table: str, column: str | None, base: Snapshot | None = None) -> int:
    """The highest number given out so far: the mark of the newest version, or the largest stored one in a table without it.

    The mark is committed with the rows it numbers, so a number is not given out twice: not after rows were deleted or the table
    truncated, and of two loads at once one fails to commit.
    """
    snap = base or store.snapshot(table)
    if column is None or snap is None or not snap.parts:
        return 0
    if _mark(column) in snap.tags:
        return int(snap.tags[_mark(column)])
    if column.upper() not in {f.name.upper() for f in snap.schema.fields}:
        return 0
    return store.read(table, snap).agg(F.max(col(column))).first()[0] or 0


@contextmanager
def numbered(df: DataFrame, column: str | None, order_by: Sequence[str], start: int):
    """``df`` with ``column`` numbered after ``start``, and the mark to commit; what it stages is removed at the end of the block."""
    if column is None:
        yield df, {}
        return
    path = scratch_dir(df.sparkSession, "surrogate")
    layout = list(df.columns) if column.upper() in {c.upper() for c in df.columns} else [*df.columns, column]
    rest = df.select(*[col(c) for c in df.columns if c.upper() != column.upper()])
    try:
        rows = assign_surrogate_keys(rest, order_by or rest.columns, column, start, path=path).select(*[col(c) for c in layout])
        yield rows, {_mark(column): start + df.sparkSession.read.parquet(path).count()}  # from the files' metadata
    finally:
        remove_path(df.sparkSession, path)


def load_append(store: TableStore, table: str, df: DataFrame, sequence: str | None = None,
                order_by: Sequence[str] = ()) -> DataFrame:
    """Append by name; ``sequence``: a column numbered after the last number given out, in ``order_by``."""
    base = store.snapshot(table)
    with numbered(df, sequence, order_by, last_number(store, table, sequence, base)) as (rows, tags):
        store.append(table, align_to(rows, base.schema, fill_missing=False) if base else rows, base=base or ABSENT, tags=tags)
    return store.read(table)


def load_insert_by_name(store: TableStore, table: str, df: DataFrame, sequence: str | None = None,
                        order_by: Sequence[str] = ()) -> DataFrame:
    """``INSERT INTO t (cols) SELECT ...``: match by name, NULL for the rest; ``sequence`` as in ``load_append``."""
    base = store.snapshot(table)
    if base is None:
        raise TableNotFound(f"INSERT into {table}: no such table")
    with numbered(df, sequence, order_by, last_number(store, table, sequence, base)) as (rows, tags):
        store.append(table, align_to(rows, base.schema, fill_missing=True), base=base, tags=tags)
    return store.read(table)


def merge_strategy(batch: DataFrame) -> str:
    """``"small"`` when Spark would broadcast ``batch`` by its estimate (file sizes, for a staged batch)."""
    limit = int(batch.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return "small" if size_estimate(batch) <= limit else "shuffle"


def load_merge(store: TableStore, table: str, source: DataFrame, keys: Sequence[str],
               update_columns: Sequence[str] | None = None,
               exclude: Sequence[str] | None = DEFAULT_UPDATE_EXCLUDE,
               check_duplicates: bool = True, stage_input: bool = True,
               strategy: str | None = None, buckets: int | None = None, sequence: str | None = None,
               tags: dict | None = None) -> DataFrame:
    """Keyed upsert of ``source`` into ``table`` (created from ``source`` if absent).

    ``stage_input=False`` skips staging when ``source`` is already a scan of
    immutable files.  ``strategy`` forces ``"shuffle"`` or ``"broadcast"``.
    ``buckets`` creates a new target bucketed by ``keys`` (see ``TableStore``); a
    batch that touches at most half of a target's buckets rewrites only these.
    ``sequence``: a column that inserted rows get numbered in, after the last number
    given out and in key order; matched rows keep theirs.  Rows are brought to the target's
    types first, and a value that would change by that fails the load (``exact_cast``); then keys are checked.
    Two loads that both find no table conflict: the second one to commit fails.
    """
    staged, path = stage(source) if stage_input else (source, None)
    try:
        base = store.snapshot(table)
        if base is not None:
            staged = align_to(staged, base.schema)  # the guard has to see the keys as they are stored
        if check_duplicates and key_profile(staged, keys)[1] > 1:
            assert_unique_keys(staged, keys)  # raises, with examples
        if base is None:
            with numbered(staged, sequence, keys, 0) as (rows, marks):
                store.overwrite(table, rows, (list(keys), buckets) if buckets else None, base=ABSENT, tags={**(tags or {}), **marks})
            return store.read(table)
        start = last_number(store, table, sequence, base)
        exclude = [*(exclude or ()), sequence] if sequence else exclude
        how, touched = strategy or merge_strategy(staged), None
        if base.bucketing and {k.upper() for k in base.bucketing[0]} == {k.upper() for k in keys} and len(base.parts) < MAX_PARTS:
            touched = store.touched_buckets(base, staged)
            touched = touched if 2 * len(touched) <= base.bucketing[1] else None
        # A target read as n buckets comes out of the merge partitioned by
        # bucket (kept rows by the scan, inserts by key): write it as is.
        bucketed = touched is None and store.is_bucketed_read(table)
        kept, inserts = merge_parts(store.read(table, base, touched), staged, keys, update_columns, exclude, how,
                                    base.bucketing[1] if bucketed and not sequence else None)
        with numbered(inserts, sequence, keys, start) as (new, marks):
            merged = kept.unionByName(new)
            tags = {**(tags or {}), **marks}
            if touched is not None:
                store.replace_buckets(table, merged, touched, base, tags)
            else:
                store.overwrite(table, merged, distribute=not bucketed or bool(sequence), base=base, tags=tags)
    finally:
        if path:
            remove_path(source.sparkSession, path)
    return store.read(table)


def load_landing(store: TableStore, table: str, df: DataFrame, source_name: str,
                 ctx: RunContext = RunContext()) -> DataFrame:
    """Rebuild a landing table: every source column, audit ones re-stamped."""
    return load_truncate(store, table, landing_projection(df, source_name, table, ctx))


def load_with_surrogate_key(store: TableStore, table: str, df: DataFrame, sk_col: str,
                            order_by: Sequence[str]) -> DataFrame:
    """Insert rows numbered after the table's current maximum ``sk_col``."""
    return load_insert_by_name(store, table, df, sk_col, order_by)


def materialize(spec: ModelSpec, df: DataFrame, store: TableStore, ctx: RunContext = RunContext(),
                tags: dict | None = None) -> DataFrame:
    """Load a built model the way its spec says; returns the table as stored.

    A sequence column numbers the rows that are new to the table, in key order.  ``tags`` are
    committed with the version that a merge makes.
    """
    table = spec.target
    m = spec.materialization
    bucket_by = (list(spec.unique_key), spec.buckets) if spec.buckets else None
    sequence = spec.sequence_column
    if m in ("table", "truncate_load"):
        return load_truncate(store, table, df, bucket_by, sequence, spec.unique_key)
    if m == "lnd_load":
        return load_landing(store, table, df, spec.source.name, ctx)
    if m == "insert":
        return load_insert_by_name(store, table, df, sequence, spec.unique_key)
    if m == "incremental":
        if spec.unique_key:
            return load_merge(store, table, df, spec.unique_key, spec.update_columns, spec.exclusions,
                              buckets=spec.buckets, sequence=sequence, tags=tags)
        return load_append(store, table, df, sequence, spec.unique_key)
    raise ValueError(f"materialization {m!r} is not a table load")
