"""Set difference with ``MINUS`` / ``EXCEPT`` semantics: distinct rows, NULLs equal.

Spark's own ``subtract`` plans a null-safe anti join whose keys are rewritten
to ``coalesce`` expressions, so the join re-shuffles after the distinct, and
duplicate right rows all travel to one reducer before they are collapsed.
Here each column is first split into (value-or-default, is-null) so plain
equality is null-safe; both sides are de-duplicated (map-side partial
aggregation, so a hot group of identical rows shrinks to one row per task
before the shuffle), and the anti join then reuses the aggregation's hash
partitioning: one shuffle per side.  Float and double columns are keyed by
their exact text (after folding -0.0 into 0.0; NaN equals NaN, as in Spark):
Spark wraps float join keys in a normalisation expression, which would stop
the join from reusing the aggregation's partitioning and add a shuffle.
"""

from __future__ import annotations

import datetime as _dt
import decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import col


def _default(dtype: T.DataType):
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DecimalType):
        return F.lit(decimal.Decimal(0)).cast(dtype)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(_dt.date(1970, 1, 1))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(_dt.datetime(1970, 1, 1)).cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.lit(bytearray()).cast(dtype)
    return None


def _encodable(schema: T.StructType) -> bool:
    return all(_default(f.dataType) is not None for f in schema.fields)


def _is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def _encode(df: DataFrame) -> DataFrame:
    out = []
    for i, f in enumerate(df.schema.fields):
        c = col(f.name)
        if _is_float(f.dataType):
            # shortest round-trip text: exact, and equal for equal values
            v = F.when(c == 0, F.lit(0.0).cast(f.dataType)).otherwise(c).cast("string")
            out.append(F.coalesce(v, F.lit("")).alias(f"__v{i}"))
        else:
            out.append(F.coalesce(c, _default(f.dataType)).alias(f"__v{i}"))
        out.append(c.isNull().alias(f"__n{i}"))
    return df.select(*out)


def _decode(df: DataFrame, schema: T.StructType) -> DataFrame:
    out = []
    for i, f in enumerate(schema.fields):
        v = F.col(f"__v{i}").cast(f.dataType) if _is_float(f.dataType) else F.col(f"__v{i}")
        out.append(F.when(F.col(f"__n{i}"), F.lit(None).cast(f.dataType)).otherwise(v).alias(f.name))
    return df.select(*out)


def distinct_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` absent from ``right`` (columns matched by position)."""
    if len(left.columns) != len(right.columns):
        raise ValueError(f"EXCEPT needs equal column counts: {left.columns} vs {right.columns}")
    right = right.toDF(*left.columns)
    if [f.dataType for f in left.schema.fields] != [f.dataType for f in right.schema.fields]:
        # Compare in Spark's common type of both sides, as UNION and EXCEPT do: casting one
        # side to the other's type would make different values equal.
        common = left.limit(0).union(right.limit(0)).schema
        widened = [col(f.name).cast(f.dataType).alias(f.name) for f in common.fields]
        left, right = left.select(*widened), right.select(*widened)
    if not _encodable(left.schema):
        return left.subtract(right)
    keys = [c for i in range(len(left.columns)) for c in (f"__v{i}", f"__n{i}")]
    l_enc = _encode(left).distinct()
    r_enc = _encode(right).distinct()
    return _decode(l_enc.join(r_enc, on=keys, how="left_anti"), left.schema)
