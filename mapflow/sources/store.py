"""Target tables as immutable Parquet parts under one root folder, listed by versions.

No transactional table format is installed, and Spark refuses to overwrite a path it
is reading.  A load therefore writes its rows to a folder of their own and then commits
a version: one small JSON file, ``<root>/<TABLE>/version-N.json``, that lists the folders
(parts) the table consists of, its schema, bucketing and tags.  Readers take the newest
version, so replacing and appending loads alike switch at one file; a load that fails
before leaves nothing a reader sees.

A version names the one it was made from.  If another load has committed in between,
the commit fails with ``CommitConflict`` instead of losing that load's rows.  Commits
rename a finished file into place, which is atomic on HDFS and local disks.  Object stores copy
and delete instead and do not refuse an existing name: two loads that commit to one table within
that moment may both succeed there, and the later file stands.  Keep the root on HDFS, or loads into one table apart.

A table may be *bucketed* by its merge key (``bucket_by=(keys, n)``; later writes keep
it).  A version of one part is then read through a catalog entry that declares the
buckets, so a join or aggregation on the key reads it already partitioned.  A bucketed
scan cannot be split by AQE, so this is done only when a metadata check at commit (file
sizes per bucket) finds no bucket far above the median.  A merge whose batch touches few
buckets rewrites only these: the new version lists the old parts without the touched
buckets, whose files it never reads, and a new part that holds them.

The newest ``keep_versions`` versions stay readable; what only older ones list is
removed with its catalog entry after each commit.

The root should be a shared folder (HDFS, object store); files are listed with the
Hadoop ``FileSystem`` of the session, so any Hadoop-supported scheme works.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSION = re.compile(r"^version-(\d+)\.json$")
_BUCKET_OF_FILE = re.compile(r"_(\d{5})(?:\.c\d{3})?(?:\.\w+)*\.parquet$")
#: Parts of a version beyond which the next merge writes the table as one part again.
MAX_PARTS = 8


class TableNotFound(LookupError):
    pass


class CommitConflict(RuntimeError):
    pass


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library created (staged inputs, parts of expired versions)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Part:
    """A folder of the table; ``buckets``: the ones still valid in it, all if None."""

    folder: str
    buckets: tuple[int, ...] | None = None


@dataclass(frozen=True)
class Snapshot:
    """One committed version of a table."""

    version: int
    parts: tuple[Part, ...]
    schema: T.StructType
    bucketing: tuple[list[str], int] | None = None
    balanced: bool = False
    tags: dict[str, Any] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({
            "version": self.version, "parts": [{"folder": p.folder, "buckets": p.buckets} for p in self.parts],
            "schema": self.schema.jsonValue(), "bucketing": self.bucketing, "balanced": self.balanced, "tags": self.tags})

    @classmethod
    def from_json(cls, text: str) -> "Snapshot":
        d = json.loads(text)
        return cls(d["version"], tuple(Part(p["folder"], None if p["buckets"] is None else tuple(p["buckets"])) for p in d["parts"]),
                   T.StructType.fromJson(d["schema"]), tuple(d["bucketing"]) if d["bucketing"] else None, d["balanced"], d["tags"])


#: Base of a write that must be a table's first: a commit on it fails if the table has a version by then.
ABSENT = Snapshot(0, (), T.StructType())


class TableStore:
    def __init__(self, spark: SparkSession, root: str, compression: str = "zstd", skew_factor: float = 4.0,
                 skew_min_bytes: int = 64 * 1024 * 1024, keep_versions: int = 5):
        if keep_versions < 1:
            raise ValueError("keep_versions must be at least 1")
        self.spark = spark
        self.root = root.rstrip("/")
        self.compression = compression
        self.skew_factor = skew_factor
        self.skew_min_bytes = skew_min_bytes
        self.keep_versions = keep_versions

    # -- file system -------------------------------------------------------
    def _path(self, p: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _table_dir(self, name: str) -> str:
        return f"{self.root}/{name.upper()}"

    def _version_file(self, name: str, version: int) -> str:
        return f"{self._table_dir(name)}/version-{version:09d}.json"

    def _versions(self, name: str) -> list[int]:
        fs, path = self._path(self._table_dir(name))
        if not fs.exists(path):
            return []
        found = (_VERSION.match(st.getPath().getName()) for st in fs.listStatus(path))
        return sorted(int(m.group(1)) for m in found if m)

    def _load(self, name: str, version: int) -> Snapshot:
        fs, path = self._path(self._version_file(name, version))
        stream = fs.open(path)
        try:
            return Snapshot.from_json(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    # -- versions ----------------------------------------------------------
    def snapshot(self, name: str) -> Snapshot | None:
        """The newest committed version, if the table exists."""
        versions = self._versions(name)
        return self._load(name, versions[-1]) if versions else None

    def version(self, name: str) -> int | None:
        versions = self._versions(name)
        return versions[-1] if versions else None

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def bucketing(self, name: str) -> tuple[list[str], int] | None:
        """(key columns, bucket count) if the table is bucketed."""
        snap = self.snapshot(name)
        return snap.bucketing if snap else None

    def is_bucketed_read(self, name: str) -> bool:
        snap = self.snapshot(name)
        return snap is not None and self._by_bucket(snap)

    @staticmethod
    def _by_bucket(snap: Snapshot) -> bool:
        return snap.bucketing is not None and snap.balanced and len(snap.parts) == 1 and snap.parts[0].buckets is None

    def _commit(self, name: str, snap: Snapshot) -> None:
        fs, path = self._path(self._version_file(name, snap.version))
        _, temp = self._path(f"{self._table_dir(name)}/_committing-{uuid.uuid4().hex}")
        out = fs.create(temp, False)
        out.write(bytearray(snap.to_json().encode()))
        out.close()
        if fs.exists(path) or not fs.rename(temp, path):
            fs.delete(temp, False)
            raise CommitConflict(f"table {name}: version {snap.version} was committed by another load meanwhile; run this load again")
        self._expire(name)

    def _expire(self, name: str) -> None:
        versions = self._versions(name)
        old, kept = versions[:-self.keep_versions], versions[-self.keep_versions:]
        if not old:
            return
        needed = {p.folder for v in kept for p in self._load(name, v).parts}
        for v in old:
            for p in self._load(name, v).parts:
                if p.folder not in needed:
                    path = f"{self._table_dir(name)}/{p.folder}"
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(path)}")
                    remove_path(self.spark, path)
            remove_path(self.spark, self._version_file(name, v))

    # -- buckets -----------------------------------------------------------
    def _catalog_name(self, path: str) -> str:
        return "mapflow_v_" + hashlib.sha1(path.encode()).hexdigest()[:20]

    def _register(self, path: str, schema: T.StructType, keys: Sequence[str], n: int) -> str:
        cat = self._catalog_name(path)
        if not self.spark.catalog.tableExists(cat):
            columns = ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {cat} ({columns}) USING parquet "
                           f"CLUSTERED BY ({', '.join(_quote(k) for k in keys)}) INTO {int(n)} BUCKETS LOCATION '{path}'")
        return cat

    def _bucket_files(self, path: str) -> dict[int, list[tuple[str, int]]]:
        """(path, size) of the files of each bucket."""
        fs, p = self._path(path)
        files: dict[int, list[tuple[str, int]]] = {}
        for st in fs.listStatus(p):
            if m := _BUCKET_OF_FILE.search(st.getPath().getName()):
                files.setdefault(int(m.group(1)), []).append((st.getPath().toString(), st.getLen()))
        return files

    def _is_balanced(self, path: str, n: int) -> bool:
        sizes = [sum(size for _, size in files) for files in self._bucket_files(path).values()]
        sizes = sorted(sizes + [0] * max(0, n - len(sizes)))
        hot, median = sizes[-1], sizes[len(sizes) // 2]
        return hot <= self.skew_min_bytes or hot <= self.skew_factor * max(median, 1)

    def touched_buckets(self, snap: Snapshot, batch: DataFrame) -> list[int]:
        """Buckets that the keys of ``batch`` (in the table's types) fall into; at most the bucket count."""
        keys, n = snap.bucketing
        bucket = F.pmod(F.hash(*[F.col(_quote(k)) for k in keys]), F.lit(n))
        return sorted(r[0] for r in batch.select(bucket.alias("b")).distinct().collect())

    # -- reads -------------------------------------------------------------
    def current_path(self, name: str) -> str | None:
        """Folder of the newest part."""
        snap = self.snapshot(name)
        return f"{self._table_dir(name)}/{snap.parts[-1].folder}" if snap else None

    def read(self, name: str, snap: Snapshot | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table's newest version, or ``snap``; with ``buckets`` only the rows of these."""
        snap = snap or self.snapshot(name)
        if snap is None:
            raise TableNotFound(f"table {name} has no committed version under {self.root}")
        paths = [f"{self._table_dir(name)}/{p.folder}" for p in snap.parts]
        if buckets is None and self._by_bucket(snap):
            return self.spark.table(self._register(paths[0], snap.schema, *snap.bucketing))
        wanted = None if buckets is None else set(buckets)
        files: list[str] = []
        for path, part in zip(paths, snap.parts):
            live = wanted if part.buckets is None else set(part.buckets) & (wanted if wanted is not None else set(part.buckets))
            if live is None:
                files.append(path)
            else:
                files += [f for b, held in sorted(self._bucket_files(path).items()) if b in live for f, _ in held]
        if not files:
            return self.spark.createDataFrame([], snap.schema)
        return self.spark.read.schema(snap.schema).parquet(*files)

    # -- writes ------------------------------------------------------------
    def _write(self, df: DataFrame, path: str, bucketing: tuple[list[str], int] | None, distribute: bool = True) -> bool:
        """Write a part; returns whether its buckets are balanced."""
        writer = df.write.mode("errorifexists").option("compression", self.compression)
        if bucketing is None:
            writer.parquet(path)
            return False
        keys, n = bucketing
        if distribute:
            # About one task per bucket, so a bucket lands in few files; REBALANCE
            # (unlike repartition) lets AQE split a hot bucket over several tasks.
            df = df.hint("rebalance", n, *keys)
        (df.write.mode("errorifexists").format("parquet").option("compression", self.compression).option("path", path)
         .bucketBy(n, *keys).saveAsTable(self._catalog_name(path)))
        return self._is_balanced(path, n)

    def _add(self, name: str, df: DataFrame, base: Snapshot | None, kept: Sequence[Part], bucketing, tags, distribute=True,
             buckets: Sequence[int] | None = None) -> str:
        """Write ``df`` as a new part and commit it with the ``kept`` ones as the version after ``base``."""
        folder = f"data-{uuid.uuid4().hex}"
        path = f"{self._table_dir(name)}/{folder}"
        schema = base.schema if base and kept else T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        try:
            balanced = self._write(df, path, bucketing, distribute)
            self._commit(name, Snapshot(
                (base.version if base else 0) + 1, (*kept, Part(folder, None if buckets is None else tuple(buckets))), schema,
                bucketing, balanced and not kept, {**(base.tags if base else {}), **(tags or {})}))
        except BaseException:
            if bucketing:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(path)}")
            remove_path(self.spark, path)
            raise
        return path

    def overwrite(self, name: str, df: DataFrame, bucket_by: tuple[Sequence[str], int] | None = None,
                  distribute: bool = True, base: Snapshot | None = None, tags: dict[str, Any] | None = None) -> str:
        """Replace the table's rows by ``df``; readers switch at the commit.

        ``bucket_by=(keys, n)`` makes the table bucketed from now on.  ``distribute=False``
        skips redistributing rows by bucket, for input that is already partitioned by the
        buckets.  ``base``: the version ``df`` was made from, or ``ABSENT`` if there was no table; the newest one if not given,
        so that the last writer wins.
        """
        base = self.snapshot(name) if base is None else base
        bucketing = (list(bucket_by[0]), int(bucket_by[1])) if bucket_by else base.bucketing if base else None
        return self._add(name, df, base, (), bucketing, tags, distribute)

    def append(self, name: str, df: DataFrame, base: Snapshot | None = None, tags: dict[str, Any] | None = None) -> str:
        """Add rows to the table (or create it): all of them at once, or none.  ``base`` as in ``overwrite``."""
        base = self.snapshot(name) if base is None else base
        return self._add(name, df, base, base.parts if base else (), base.bucketing if base else None, tags)

    def replace_buckets(self, name: str, df: DataFrame, buckets: Sequence[int], base: Snapshot,
                        tags: dict[str, Any] | None = None) -> str:
        """Replace the rows of ``buckets`` by ``df``; files of other buckets are neither read nor written."""
        gone, every = set(buckets), range(base.bucketing[1])
        kept = [Part(p.folder, live) for p in base.parts
                if (live := tuple(b for b in (every if p.buckets is None else p.buckets) if b not in gone))]
        return self._add(name, df, base, kept, base.bucketing, tags, buckets=sorted(gone))

    def truncate(self, name: str) -> str:
        """Empty the table, keeping its schema."""
        return self.overwrite(name, self.read(name).where("1=0"))
