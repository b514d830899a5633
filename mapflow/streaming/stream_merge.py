"""Incremental keyed merges driven by Structured Streaming.

New files in a landing folder are read with ``readStream``; every micro-batch
is upserted into the target by ``foreachBatch``.  The streaming checkpoint
(in the shared folder) records which files were merged, so each file set is
merged once; with ``trigger(availableNow=True)`` a scheduled run processes
what arrived since the last run and stops.  ``foreachBatch`` is
at-least-once, so the version a batch commits carries the stream's last batch
id, and a batch replayed after a failure is skipped: rows with a NULL key, which
match nothing, are not inserted twice either.  The batch ids are those of the query that the
checkpoint holds, so after a checkpoint was reset all files are merged again.  A key that occurs more than once
in a batch keeps its latest row by ``order_by``; without that, it is an error.
Pass ``ctx_for_batch`` to make audit stamps depend on the batch id only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.audit import RunContext
from ..functions.expressions import col
from ..operators.keys import hashable_columns
from ..operators.load import load_merge
from ..operators.rollup import Rollup
from ..session import checkpoint_root
from ..sources.partitions import PartitionedTable
from ..sources.store import TableStore
from ..spec import DEFAULT_UPDATE_EXCLUDE


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order_by`` (ties: by all columns); rows with a NULL key all stay.

    The largest (order, row) of a key is an aggregate, combined before the shuffle, so a key
    that holds most of the rows costs one row per task.
    """
    present = F.lit(True)
    for k in keys:
        present = present & col(k).isNotNull()
    row = F.struct(*[col(c) for c in df.columns])
    rank = F.struct(*[col(c) for c in order_by], *[c for c in hashable_columns(df)])
    last = df.where(present).groupBy(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, rank).alias("__row"))
    return last.select("__row.*").unionByName(df.where(~present))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query in its checkpoint: the same for every restart, another one for a new or reset checkpoint."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())["id"]
    finally:
        stream.close()


def stream_merge(spark: SparkSession, input_path: str, schema: StructType, store: TableStore, table: str,
                 keys: Sequence[str], transform: Callable[[DataFrame, RunContext], DataFrame] | None = None,
                 update_columns: Sequence[str] | None = None,
                 exclude: Sequence[str] | None = DEFAULT_UPDATE_EXCLUDE,
                 checkpoint_location: str | None = None, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, available_now: bool = True,
                 processing_time: str | None = None,
                 ctx_for_batch: Callable[[int], RunContext] | None = None,
                 order_by: Sequence[str] | None = None) -> StreamingQuery:
    location = checkpoint_location or default_checkpoint(spark, table)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        tag = "stream:" + query_id(spark, location)
        current = store.snapshot(table)
        if current is not None and current.tags.get(tag, -1) >= batch_id:
            return  # committed before the failure that led to this replay
        ctx = ctx_for_batch(batch_id) if ctx_for_batch else RunContext()
        df = transform(batch, ctx) if transform else batch
        if order_by:
            df = latest_per_key(df, keys, order_by)
        load_merge(store, table, df, keys, update_columns, exclude, tags={tag: batch_id})

    return start(spark, input_path, schema, merge_batch, location, fmt, max_files_per_trigger, available_now, processing_time)


def default_checkpoint(spark: SparkSession, name: str) -> str:
    """Stable per target, so each scheduled run resumes where the previous one stopped."""
    return f"{checkpoint_root(spark)}/mapflow/streams/{name.upper()}"


def start(spark: SparkSession, input_path: str, schema: StructType, per_batch: Callable[[DataFrame, int], None], location: str,
          fmt: str = "parquet", max_files_per_trigger: int | None = None, available_now: bool = True,
          processing_time: str | None = None) -> StreamingQuery:
    """A query that hands every micro-batch of new files to ``per_batch``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    writer = reader.load(input_path).writeStream.foreachBatch(per_batch).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def stream_partitions(spark: SparkSession, input_path: str, schema: StructType, table: PartitionedTable, keys: Sequence[str],
                      transform: Callable[[DataFrame], DataFrame] | None = None, order_by: Sequence[str] | None = None,
                      checkpoint_location: str | None = None, **options) -> StreamingQuery:
    """Keyed merges of new files into a partitioned table: a micro-batch rewrites only the partitions that it touches."""
    location = checkpoint_location or default_checkpoint(spark, table.path.rsplit("/", 1)[-1])

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        df = transform(batch) if transform else batch
        if order_by:
            df = latest_per_key(df, keys, order_by)
        table.merge(df, keys, tag=f"{query_id(spark, location)}-{batch_id}")

    return start(spark, input_path, schema, merge_batch, location, **options)


def stream_rollup(spark: SparkSession, input_path: str, schema: StructType, rollup: Rollup,
                  transform: Callable[[DataFrame], DataFrame] | None = None, checkpoint_location: str | None = None,
                  **options) -> StreamingQuery:
    """New files' rows added to a rollup: a micro-batch reads its own rows and the states of the groups' partitions, nothing else."""
    location = checkpoint_location or default_checkpoint(spark, rollup.table.path.rsplit("/", 1)[-1])

    def add(batch: DataFrame, batch_id: int) -> None:
        rollup.load(transform(batch) if transform else batch, tag=f"{query_id(spark, location)}-{batch_id}")

    return start(spark, input_path, schema, add, location, **options)
