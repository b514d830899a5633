"""Where models find their inputs.

``source`` names resolve to external tables (Parquet paths, catalog tables or
DataFrames the caller registers); ``ref`` names resolve to another model's
output: its DataFrame if it ran in this process, else its committed version in
the table store, else a catalog table.  Names match case-insensitively.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import TableRef
from .store import TableStore

Loader = Callable[[], DataFrame]


class TableRegistry:
    def __init__(self, spark: SparkSession, store: TableStore | None = None):
        self.spark = spark
        self.store = store
        self._sources: dict[str, Loader] = {}
        self._refs: dict[str, DataFrame] = {}

    # -- registration --------------------------------------------------------
    def register_source(self, name: str, what: str | DataFrame | Loader, fmt: str = "parquet") -> "TableRegistry":
        if isinstance(what, DataFrame):
            self._sources[name.upper()] = lambda df=what: df
        elif isinstance(what, str):
            self._sources[name.upper()] = lambda p=what: self.spark.read.format(fmt).load(p)
        else:
            self._sources[name.upper()] = what
        return self

    def register_parquet_dir(self, directory: str, tables: Iterable[str], schema: str | None = None) -> "TableRegistry":
        """Register ``<directory>/<t>.parquet`` as source ``t`` (and ``schema.t``)."""
        for t in tables:
            path = f"{directory.rstrip('/')}/{t}.parquet"
            self.register_source(t, path)
            if schema:
                self.register_source(f"{schema}.{t}", path)
        return self

    def register_ref(self, name: str, df: DataFrame) -> "TableRegistry":
        self._refs[name.upper()] = df
        return self

    def tables(self, schema: str, table: str | None = None) -> list[str]:
        """Names of a schema's registered tables (or of one of them), in any letter case, ordered."""
        start = schema.upper() + "."
        return sorted(k for k in self._sources if k.startswith(start) and "." not in k[len(start):]
                      and (table is None or k[len(start):] == table.upper()))

    # -- lookup ----------------------------------------------------------------
    def source(self, name: str) -> DataFrame:
        key = name.upper()
        if key in self._sources:
            return self._sources[key]()
        # DATABASE.SCHEMA.TABLE may have been registered without its database, but a name
        # never loses its schema: another schema's table of the same name is another table.
        parts = key.split(".")
        if len(parts) == 3 and ".".join(parts[1:]) in self._sources:
            return self._sources[".".join(parts[1:])]()
        return self.spark.table(name)

    def ref(self, name: str) -> DataFrame:
        key = name.upper()
        if key in self._refs:
            return self._refs[key]
        if self.store is not None and self.store.exists(key):
            return self.store.read(key)
        return self.spark.table(name)

    def resolve(self, table: TableRef) -> DataFrame:
        return self.source(table.name) if table.kind == "source" else self.ref(table.name)


def column_profile(df: DataFrame) -> DataFrame:
    """A table's columns in ordinal order with their row and NULL counts, from one scan.

    All counts are one aggregate, combined per task, whose single row is then turned into one
    row per column.
    """
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col("`" + c.replace("`", "``") + "`")).alias(f"__c{i}")
                                                       for i, c in enumerate(df.columns)])
    per = F.array(*[F.struct(F.lit(i + 1).alias("ORDINAL_POSITION"), F.lit(c).alias("COLUMN_NAME"), F.col("__rows").alias("ROW_CNT"),
                             (F.col("__rows") - F.col(f"__c{i}")).alias("NULL_CNT")) for i, c in enumerate(df.columns)])
    return counts.select(F.inline(per)).orderBy("ORDINAL_POSITION")


def schema_profile(registry: TableRegistry, schema: str, table: str | None = None) -> DataFrame:
    """``column_profile`` of every registered table of a schema, or of one: by table, then in ordinal order.

    Each table is scanned once; no rows but the counts are shuffled.
    """
    names = registry.tables(schema, table)
    if not names:
        raise LookupError(f"no table {table or ''} is registered in schema {schema}")
    parts = [column_profile(registry.source(n)).select(F.lit(schema.upper()).alias("TABLE_SCHEMA"),
                                                       F.lit(n.split(".")[-1]).alias("TABLE_NAME"), "*") for n in names]
    return reduce(DataFrame.unionByName, parts).orderBy("TABLE_NAME", "ORDINAL_POSITION")


def catalog_listing(spark: SparkSession, schema: str, table: str | None = None) -> DataFrame:
    """The columns of a catalog schema's tables and views (or of one), by table, then in ordinal order.

    From the session's catalog alone; names match in any letter case, temporary views belong to no schema.
    """
    rows = [(schema.upper(), t.name.upper(), i, f.name, f.dataType.simpleString())
            for t in spark.catalog.listTables(schema)
            if not t.isTemporary and (table is None or t.name.upper() == table.upper())
            for i, f in enumerate(spark.table(".".join("`" + p.replace("`", "``") + "`" for p in (schema, t.name))).schema.fields, 1)]
    return (spark.createDataFrame(rows, "TABLE_SCHEMA string, TABLE_NAME string, ORDINAL_POSITION int, COLUMN_NAME string, DATA_TYPE string")
            .coalesce(1).sortWithinPartitions("TABLE_NAME", "ORDINAL_POSITION"))


def catalog_columns(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """A table's columns in ordinal order, as a DataFrame.

    Works on a catalog table name or any DataFrame; the schema comes from the
    Parquet footer or catalog, never from scanning rows.
    """
    schema = spark.table(table).schema if isinstance(table, str) else table.schema
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    out_schema = T.StructType([
        T.StructField("ORDINAL_POSITION", T.IntegerType(), False),
        T.StructField("COLUMN_NAME", T.StringType(), False),
        T.StructField("DATA_TYPE", T.StringType(), False),
    ])
    # One row per column: a single partition sorts them without a range shuffle.
    return spark.createDataFrame(rows, out_schema).coalesce(1).sortWithinPartitions("ORDINAL_POSITION")
