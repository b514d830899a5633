"""Conforming a source to a target layout, and publishing views.

* ``match_columns`` / ``conform_by_name``: fill each target column from the
  source column of the same name (case-insensitive, first match wins), after
  explicit rename rules; audit names get target-flavour audit values; the rest
  are unmapped (``''``, or typed NULL when the target type is not a string).
* ``landing_projection``: every source column in order, audit-named ones
  replaced with source-flavour values.
* ``positional_rename`` / ``publish_view``: a view with its own column list.

All of it is a single ``select`` over the source: no shuffle, and only the
columns the target needs are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.audit import RunContext, source_flavour, target_flavour
from ..fixed_values import AUDIT_PGM_COLUMNS, AUDIT_TIME_COLUMNS, AUDIT_USER_COLUMNS
from ..functions.expressions import col, quote
from ..spec import AUDIT_COLUMNS


@dataclass(frozen=True)
class ColumnMatch:
    mapping: dict[str, str | None]  # target name -> source name (None: unmapped)
    audit: tuple[str, ...]          # target names filled with audit values

    @property
    def mapped_count(self) -> int:
        return sum(1 for v in self.mapping.values() if v is not None) + len(self.audit)

    @property
    def total_count(self) -> int:
        return len(self.mapping) + len(self.audit)


def match_columns(source_columns: Sequence[str], target_columns: Sequence[str],
                  rules: Mapping[str, str] | None = None) -> ColumnMatch:
    """Target -> source name matching on schemas (driver side, names only)."""
    # rules map a source name to a target name
    by_target_rule = {t.upper(): s.upper() for s, t in (rules or {}).items()}
    src_upper = {}
    for s in source_columns:
        src_upper.setdefault(s.upper(), s)
    mapping, audit = {}, []
    for t in target_columns:
        if t.upper() in AUDIT_COLUMNS:
            audit.append(t)
            continue
        ruled = by_target_rule.get(t.upper())
        if ruled is not None and ruled in src_upper:
            mapping[t] = src_upper[ruled]
        elif t in source_columns:
            mapping[t] = t
        else:
            mapping[t] = src_upper.get(t.upper())
    return ColumnMatch(mapping, tuple(audit))


def _target_fields(target: Sequence[str] | T.StructType) -> list[tuple[str, T.DataType | None]]:
    if isinstance(target, T.StructType):
        return [(f.name, f.dataType) for f in target.fields]
    return [(n, None) for n in target]


def conform_by_name(df: DataFrame, target: Sequence[str] | T.StructType, target_name: str,
                    ctx: RunContext = RunContext(), rules: Mapping[str, str] | None = None) -> DataFrame:
    from .select import default_value

    fields = _target_fields(target)
    match = match_columns(df.columns, [n for n, _ in fields], rules)
    audit = target_flavour(target_name, ctx)
    out = []
    for name, dtype in fields:
        if name in match.audit:
            e = audit[name.upper()]
        elif match.mapping.get(name) is not None:
            e = col(match.mapping[name])
        else:
            e = default_value(dtype)
        out.append((e.cast(dtype) if dtype is not None else e).alias(name))
    return df.select(*out)


def landing_projection(df: DataFrame, source_name: str, target_name: str,
                       ctx: RunContext = RunContext()) -> DataFrame:
    audit = source_flavour(source_name, target_name, ctx)
    return df.select(*[
        audit[c.upper()].alias(c) if c.upper() in audit else col(c)
        for c in df.columns
    ])


def positional_rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"view lists {len(names)} columns but its select has {len(df.columns)}")
    return df.toDF(*names)


def create_view(spark: SparkSession, view_name: str, relation: str, columns: Sequence[str], names: Sequence[str] | None = None,
                source_name: str | None = None, ctx: RunContext = RunContext()) -> DataFrame:
    """Create or replace a lasting catalog view with its own column list over a stored relation.

    ``relation`` is a catalog table or a path relation such as ``parquet.`/lake/t.parquet```;
    audit-named columns get source-flavour values when ``source_name`` is given.  Unlike a
    temporary view it is the catalog's, not the session's.
    """
    names = list(names or columns)
    if len(names) != len(columns):
        raise ValueError(f"view lists {len(names)} columns but its select has {len(columns)}")
    text = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    stamp = "localtimestamp()" if ctx.run_ts is None else f"timestamp_ntz {text(ctx.run_ts.isoformat(sep=' '))}"
    user = "current_user()" if ctx.run_user is None else text(ctx.run_user)
    audit = {n: stamp for n in AUDIT_TIME_COLUMNS} | {n: user for n in AUDIT_USER_COLUMNS}
    audit |= {n: text(view_name) for n in AUDIT_PGM_COLUMNS} | {"DATA_SRC": text(source_name or "")}
    picked = [audit[c.upper()] if source_name and c.upper() in audit else quote(c) for c in columns]
    spark.sql(f"CREATE OR REPLACE VIEW {view_name} ({', '.join(map(quote, names))}) AS SELECT {', '.join(picked)} FROM {relation}")
    return spark.table(view_name)


def publish_view(df: DataFrame, view_name: str, names: Sequence[str] | None = None,
                 source_name: str | None = None, target_name: str | None = None,
                 ctx: RunContext = RunContext()) -> DataFrame:
    """Register a (temporary) view with its own column list; audit-named
    columns get source-flavour values when ``source_name`` is given."""
    if source_name:
        df = landing_projection(df, source_name, target_name or view_name, ctx)
    if names:
        df = positional_rename(df, names)
    df.createOrReplaceTempView(view_name)
    return df.sparkSession.table(view_name)
