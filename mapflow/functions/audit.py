"""Audit columns: provenance and time stamps on every loaded row.

Run time and run user are arguments of a run (``RunContext``) so a rerun with
the same context produces the same rows; when unset they fall back to the
query's current time (as ``timestamp_ntz``, the type the warehouse tables use)
and the session user.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import AUDIT_COLUMNS

from ..fixed_values import (AUDIT_PGM_COLUMNS, AUDIT_TIME_COLUMNS, AUDIT_USER_COLUMNS,  # noqa: F401
                            DEFAULT_TIME_LOGIC, DEFAULT_USER_LOGIC)


@dataclass(frozen=True)
class RunContext:
    run_ts: datetime | None = None
    run_user: str | None = None

    def ts(self) -> Column:
        if self.run_ts is None:
            return F.localtimestamp()
        # From text, so the stamp does not depend on the driver's time zone.
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")

    def user(self) -> Column:
        if self.run_user is None:
            return F.expr("current_user()")
        return F.lit(self.run_user)


def _norm(text: str) -> str:
    return re.sub(r"\s+", "", text).upper()


def is_audit_name(name: str) -> bool:
    return name.upper() in AUDIT_COLUMNS


def default_audit_logic(name: str, logic: str | None) -> str | None:
    """'time' / 'user' when a column carries the sheet's default audit logic."""
    if logic is None:
        return None
    n = _norm(logic)
    if name.upper() in AUDIT_TIME_COLUMNS and n in (_norm(DEFAULT_TIME_LOGIC), "CURRENT_TIMESTAMP"):
        return "time"
    if name.upper() in AUDIT_USER_COLUMNS and n in (_norm(DEFAULT_USER_LOGIC), "CURRENT_USER()", "CURRENT_USER"):
        return "user"
    return None


def audit_values(data_src: str, program: str, ctx: RunContext) -> dict[str, Column]:
    """All seven audit columns as Spark columns."""
    return {
        "DATA_SRC": F.lit(data_src),
        "CREATE_DT": ctx.ts(),
        "CREATE_BY": ctx.user(),
        "CREATE_PGM": F.lit(program),
        "UPDATE_DT": ctx.ts(),
        "UPDATE_BY": ctx.user(),
        "UPDATE_PGM": F.lit(program),
    }


def target_flavour(target: str, ctx: RunContext) -> dict[str, Column]:
    """Conform-by-name flavour: data source and programs are the target's name."""
    return audit_values(target, target, ctx)


def source_flavour(source: str, target: str, ctx: RunContext) -> dict[str, Column]:
    """Landing flavour: data source is the source's name, programs the target's."""
    return audit_values(source, target, ctx)
