"""Delta against the current target (``MINUS`` logic).

Columns split in two.  *Compared* columns (unique keys and plain column
logic) are selected from the model's joined and filtered input and reduced by
the same columns of the current target, so only new or changed rows survive.
*Outer* columns (computed logic, literals, audit columns) are evaluated on the
surviving rows only; they may therefore use compared columns and literals but
nothing else from the source.  Used before a keyed merge, the delta shrinks
the merge input to the rows that actually changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.audit import RunContext, default_audit_logic, is_audit_name
from ..functions.expressions import col, is_bare_identifier, is_computed_logic, quote
from ..sources.registry import TableRegistry
from ..spec import ColumnSpec, ModelSpec
from .select import column_expr, default_value, model_frame, projected_columns
from .setops import distinct_except


def classify_columns(spec: ModelSpec) -> tuple[list[ColumnSpec], list[ColumnSpec]]:
    """(compared, outer) columns of a delta model, each in target layout order."""
    keys = {k.upper() for k in spec.unique_key}
    compared, outer = [], []
    for c in projected_columns(spec):
        name = c.target.upper()
        if name in keys:
            compared.append(c)
        elif is_audit_name(name) or not c.source_table or is_computed_logic(c.logic):
            outer.append(c)
        else:
            compared.append(c)
    return compared, outer


def _outer_expr(c: ColumnSpec, spec: ModelSpec, compared_names: list[str], ctx: RunContext):
    if c.logic is None or not c.logic.strip():
        return default_value(None).alias(c.target)
    kind = default_audit_logic(c.target, c.logic)
    if kind == "time":
        return ctx.ts().alias(c.target)
    if kind == "user":
        return ctx.user().alias(c.target)
    logic = c.logic.strip()
    if is_bare_identifier(logic) and logic.upper() in {n.upper() for n in compared_names}:
        return col(logic).alias(c.target)
    return F.expr(logic).alias(c.target)


def build_delta(spec: ModelSpec, registry: TableRegistry, target: DataFrame | None,
                ctx: RunContext = RunContext()) -> DataFrame:
    """New and changed rows of the model against ``target``; None stands for an empty target."""
    if spec.group_by:
        raise ValueError("delta models cannot group")
    compared, outer = classify_columns(spec)
    if not compared:
        raise ValueError("delta needs at least one compared column")
    frame, source_columns = model_frame(spec, registry)
    inner = frame.select(*[column_expr(c, spec, source_columns, ctx) for c in compared])
    names = [c.target for c in compared]
    if target is None:
        changed = inner.distinct()
    else:
        have = {c.upper(): c for c in target.columns}
        missing = [n for n in names if n.upper() not in have]
        if missing:
            raise ValueError(f"target lacks compared columns {missing}")
        changed = distinct_except(inner, target.select(*[col(have[n.upper()]) for n in names]))
    try:
        out = changed.select(*[_outer_expr(c, spec, names, ctx) for c in outer], *[quote(n) for n in names])
        out.schema  # analyse now so a bad outer logic fails here
    except AnalysisException as e:
        raise ValueError("delta outer columns may use only compared columns and literals: " + str(e).split("\n")[0]) from e
    return out
