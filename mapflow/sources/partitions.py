"""Targets in Hive-style partitions, loaded through Spark's own partitioned writer.

A merge rewrites only the partitions that its batch touches: the current rows are read with a filter on the
partition columns (so other partitions' files are not even listed for the scan), the new rows are
staged in the shared folder, and a dynamic partition overwrite puts them in place.  The
partition columns have to belong to the key, else a key could sit in another partition.

Spark's committer moves finished files in at the end, partition by partition: a load that fails before leaves the table as
it was.  If it fails while they are moved, some partitions are new and some old; running the load again gives the
right state, as the staged rows of a tagged batch are kept until its marker is written and are used again.
Readers during that moment may see both states; loads into one table must not run at the same time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import col
from ..operators.keys import assert_unique_keys, key_profile
from ..operators.merge import align_to, merge_frames
from ..session import scratch_dir
from ..spec import DEFAULT_UPDATE_EXCLUDE
from .store import remove_path

#: Touched partitions that a merge names one by one in its scan filter; beyond them they are joined, and Spark prunes at run time.
NAMED = 1000


class PartitionedTable:
    """A Parquet table at ``path`` in partitions by ``partition_by``; its schema is kept beside the data."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str]):
        if not partition_by:
            raise ValueError("a partitioned table needs a partition column")
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

    # -- small files of its own, which Spark's readers skip ---------------------
    def _file(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_mapflow/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _write_file(self, name: str, text: str) -> None:
        fs, p = self._file(name)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _exists(self, name: str) -> bool:
        fs, p = self._file(name)
        return fs.exists(p)

    @property
    def schema(self) -> T.StructType | None:
        if not self._exists("schema.json"):
            return None
        fs, p = self._file("schema.json")
        stream = fs.open(p)
        try:
            return T.StructType.fromJson(json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    # -- reads and writes ------------------------------------------------------
    def read(self) -> DataFrame:
        schema = self.schema
        if schema is None:
            raise LookupError(f"no table at {self.path}")
        # The types are those of the first write, not what the folder names look like.
        return self.spark.read.schema(schema).parquet(self.path).select(*[col(f.name) for f in schema.fields])

    def replace(self, df: DataFrame) -> None:
        """Replace the partitions that occur in ``df`` by its rows; others stay as they are."""
        if self.schema is None:
            self._write_file("schema.json", json.dumps(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]).jsonValue()))
        # One task per partition or more: AQE splits a hot partition's rows over several.
        rows = align_to(df, self.schema).hint("rebalance", *self.partition_by)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.partition_by).parquet(self.path)

    def append(self, df: DataFrame) -> None:
        if self.schema is None:
            return self.replace(df)
        rows = align_to(df, self.schema).hint("rebalance", *self.partition_by)
        rows.write.mode("append").partitionBy(*self.partition_by).parquet(self.path)

    def touched(self, batch: DataFrame) -> DataFrame:
        """The table's rows in partitions that occur in ``batch`` (in the table's types)."""
        places = batch.select(*[col(c) for c in self.partition_by]).distinct()
        named = places.take(NAMED + 1)
        rows = self.read()
        if not named:
            return rows.where(F.lit(False))
        if len(named) <= NAMED:
            one = lambda r: reduce(lambda a, b: a & b, [col(c).eqNullSafe(F.lit(v)) for c, v in zip(self.partition_by, r)])
            if len(self.partition_by) == 1:
                c, values = col(self.partition_by[0]), [r[0] for r in named if r[0] is not None]
                cond = c.isin(values) if values else F.lit(False)
                return rows.where(cond | c.isNull() if len(values) < len(named) else cond)
            return rows.where(reduce(lambda a, b: a | b, map(one, named)))
        keys = [f"__p{i}" for i in range(len(self.partition_by))]
        places = places.toDF(*keys)
        return rows.join(places, reduce(lambda a, b: a & b, [col(c).eqNullSafe(F.col(k)) for c, k in zip(self.partition_by, keys)]), "left_semi")

    def merge(self, batch: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None,
              exclude: Sequence[str] | None = DEFAULT_UPDATE_EXCLUDE, tag: str | None = None) -> None:
        """Keyed upsert that reads and writes only the partitions that ``batch`` touches.

        ``tag``: a name of this batch; one that was merged before is skipped.
        """
        if missing := {c.upper() for c in self.partition_by} - {k.upper() for k in keys}:
            raise ValueError(f"partition columns {sorted(missing)} are not in the key {list(keys)}: a key could sit in another partition")
        def build(rows: DataFrame) -> DataFrame:
            if key_profile(rows, keys)[1] > 1:
                assert_unique_keys(rows, keys)
            return rows if self.schema is None else merge_frames(self.touched(rows), rows, keys, update_columns, exclude)

        self._commit(batch, build, tag)

    def combine(self, batch: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame], tag: str | None = None) -> None:
        """Replace the partitions that ``batch`` touches by ``fold`` of their rows and the batch's."""
        self._commit(batch, lambda rows: rows if self.schema is None else fold(self.touched(rows), rows), tag)

    def _commit(self, batch: DataFrame, build: Callable[[DataFrame], DataFrame], tag: str | None) -> None:
        """Stage what ``build`` makes of the batch, then put it in place; a ``tag`` that was done is skipped."""
        if tag and self._exists(f"done/{tag}"):
            return
        staged = f"{self.path}/_mapflow/staged/{tag}" if tag else scratch_dir(self.spark, "partitions")
        if not (tag and self._exists(f"staged/{tag}/_SUCCESS")):
            given, schema = scratch_dir(self.spark, "stage"), self.schema
            try:
                (align_to(batch, schema) if schema else batch).write.parquet(given)
                build(self.spark.read.parquet(given)).write.mode("overwrite").parquet(staged)
            finally:
                remove_path(self.spark, given)
        self.replace(self.spark.read.parquet(staged))
        if tag:
            self._write_file(f"done/{tag}", "")
        remove_path(self.spark, staged)
