"""Event-time windows and sessions over a stream of files, with bounded state.

A watermark bounds the state: a window is final, and written once, when the largest event time seen so far is past its
end by ``delay``.  Repeated deliveries of a row are dropped by key within the same bound.  Rows that come later
than ``delay`` allows are not part of a window any more; their number is in the query's progress (``late_rows``), so a
run can be checked for them.  Finished windows go to Parquet files through Spark's own
file sink, whose log makes every window appear once, also after a restart from the checkpoint.

NULL event times belong to no window.  NULL keys form a group.  Windows that are not final yet stay in the checkpoint and
are written by a later run.  State is split by key: a hot key's rows of one window are combined in their tasks first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.expressions import col


def windowed(stream: DataFrame, event_time: str, delay: str, keys: Sequence[str], aggregates: Sequence[Column],
             duration: str | None = None, slide: str | None = None, gap: str | None = None,
             unique_by: Sequence[str] | None = None) -> DataFrame:
    """``window_start``, ``window_end``, the keys and the aggregates; windows of ``duration``, or sessions that a ``gap`` ends.

    ``unique_by``: of rows alike in these columns, delivered within ``delay`` of each other, one counts.
    """
    if (duration is None) == (gap is None):
        raise ValueError("either a window's duration or a session's gap")
    rows = stream.withColumn(event_time, col(event_time).cast("timestamp")).where(col(event_time).isNotNull())
    rows = rows.withWatermark(event_time, delay)
    if unique_by:
        rows = rows.dropDuplicatesWithinWatermark(list(unique_by))
    span = F.session_window(col(event_time), gap) if gap else F.window(col(event_time), duration, slide)
    out = rows.groupBy(span.alias("__span"), *[col(k).alias(k) for k in keys]).agg(*aggregates)
    return out.select(F.col("__span.start").alias("window_start"), F.col("__span.end").alias("window_end"),
                      *[c for c in map(col, out.columns[1:])])


def stream_windows(spark: SparkSession, input_path: str, schema: StructType, output_path: str, checkpoint_location: str,
                   event_time: str, delay: str, keys: Sequence[str], aggregates: Sequence[Column], duration: str | None = None,
                   slide: str | None = None, gap: str | None = None, unique_by: Sequence[str] | None = None, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """A query that reads new files of ``input_path`` and writes final windows to ``output_path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    out = windowed(reader.load(input_path), event_time, delay, keys, aggregates, duration, slide, gap, unique_by)
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer).start(output_path)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late for their window in the query's recent progress, after combining those alike in a task."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
