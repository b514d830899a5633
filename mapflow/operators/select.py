"""Model builder: a ``ModelSpec`` becomes one DataFrame plan.

``source`` (aliased) -> join chain -> WHERE -> derived expressions -> projection, or GROUP BY /
ROLLUP / CUBE / GROUPING SETS with the aggregate calls the logic text carries, and a condition on groups.  Everything is
declarative, so Catalyst prunes columns to the Parquet scan, pushes the filter
below the joins and picks the join strategy; nothing here runs a job except the
size probe of a non-equi join (see ``join.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.audit import RunContext, default_audit_logic
from ..functions.expressions import col, is_bare_identifier, quote, rewrite_main
from ..sources.registry import TableRegistry
from ..spec import ColumnSpec, ModelSpec
from .join import apply_join


def model_frame(spec: ModelSpec, registry: TableRegistry) -> tuple[DataFrame, list[str]]:
    """Joined and filtered input of a model; also the main relation's columns."""
    base = registry.resolve(spec.source)
    df = base.alias(spec.main_alias)
    for j in spec.joins:
        df = apply_join(df, registry.resolve(j.table), j, spec.main_alias)
    if spec.where and spec.where.strip():
        df = df.where(F.expr(rewrite_main(spec.where, spec.main_alias)))
    if spec.derived:
        # A step of its own: Catalyst keeps an expression that several columns use in one place.
        df = df.withColumns({name: F.expr(rewrite_main(logic, spec.main_alias)) for name, logic in spec.derived})
    return df, list(base.columns)


def projected_columns(spec: ModelSpec) -> list[ColumnSpec]:
    """Columns the model selects, in target layout order.

    Sheet artefacts and sequence (``NEXTVAL``) columns are left out: a sequence
    column is filled at insert time (``keys.assign_surrogate_keys``).  With a
    contract the contract order wins and unknown names go last; otherwise a
    numeric ``position`` orders them; otherwise the spec order stands.
    """
    cols = [c for c in spec.columns if not c.is_artefact and not c.is_sequence]
    if spec.contract is not None:
        order = {f.name.upper(): i for i, f in enumerate(spec.contract.fields)}
        return sorted(cols, key=lambda c: order.get(c.target.upper(), len(order)))
    if any(c.position is not None for c in cols):
        return sorted(cols, key=lambda c: (c.position is None, c.position if c.position is not None else 0))
    return cols


def default_value(dtype: T.DataType | None) -> Column:
    """Value of an unmapped column: '' for strings (or unknown type), else typed NULL."""
    if dtype is None or isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit("")
    return F.lit(None).cast(dtype)


def _contract_type(spec: ModelSpec, name: str) -> T.DataType | None:
    if spec.contract is None:
        return None
    for f in spec.contract.fields:
        if f.name.upper() == name.upper():
            return f.dataType
    return None


def column_expr(c: ColumnSpec, spec: ModelSpec, source_columns: list[str], ctx: RunContext) -> Column:
    """One output column of a model, named by its target."""
    if c.logic is None or not str(c.logic).strip():
        e = default_value(_contract_type(spec, c.target))
    else:
        kind = default_audit_logic(c.target, c.logic)
        logic = c.logic.strip()
        if kind == "time":
            e = ctx.ts()
        elif kind == "user":
            e = ctx.user()
        elif is_bare_identifier(logic) and logic.upper() in {s.upper() for s in source_columns}:
            e = col(logic, spec.main_alias)
        else:
            e = F.expr(rewrite_main(logic, spec.main_alias))
    return e.alias(c.target)


def apply_contract(df: DataFrame, contract: T.StructType | None) -> DataFrame:
    """Order and cast to the target layout; fill absent contract columns with the default."""
    if contract is None:
        return df
    have = {c.upper(): c for c in df.columns}
    out = []
    for f in contract.fields:
        src = have.pop(f.name.upper(), None)
        if src is None:
            out.append(default_value(f.dataType).alias(f.name))
        else:
            out.append(col(src).cast(f.dataType).alias(f.name))
    out += [col(c) for c in df.columns if c.upper() in have]
    return df.select(*out)


def build_model(spec: ModelSpec, registry: TableRegistry, ctx: RunContext = RunContext()) -> DataFrame:
    df, source_columns = model_frame(spec, registry)
    cols = projected_columns(spec)
    exprs = [column_expr(c, spec, source_columns, ctx) for c in cols]
    names = [c.target for c in cols]
    if spec.group_by:
        by_text = {k: F.expr(rewrite_main(k, spec.main_alias)) for k in spec.group_by}
        keys = list(by_text.values())
        if spec.grouping == "sets":
            grouped = df.groupingSets([[by_text[k] for k in g] for g in spec.grouping_sets], *keys)
        else:
            grouped = {"plain": df.groupBy, "rollup": df.rollup, "cube": df.cube}[spec.grouping](*keys)
        having = [F.expr(rewrite_main(spec.having, spec.main_alias)).alias("__having")] if spec.having else []
        res = grouped.agg(*exprs, *having)
        # Grouping columns come first under generated names; rename by position.
        res = res.toDF(*[f"__g{i}" for i in range(len(keys))], *names, *["__having"] * len(having))
        if having:
            res = res.where("__having")
        res = res.select(*[quote(n) for n in names])
    else:
        res = df.select(*exprs)
    return apply_contract(res, spec.contract)
