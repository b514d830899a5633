"""Mapping spec: configuration objects only, no data.

A ``ModelSpec`` describes one target table: its source, one SQL expression per
target column, optional joins / filter / grouping, how it is loaded, and the
merge key.  ``ModelSpec.from_config`` accepts the JSON shape of a flattened
mapping workbook (``Source`` / ``Target`` / ``Columns`` / ``DAG``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql.types import StructType

from .fixed_values import (ADDED_MATERIALIZATIONS, AUDIT_COLUMNS, DEFAULT_UPDATE_EXCLUDE, MATERIALIZATIONS,  # noqa: F401
                           SEQUENCE_WORD, SHEET_ARTEFACTS)
from .functions.expressions import split_list

GROUPINGS = ("plain", "rollup", "cube", "sets")


def _join_table(row: dict[str, Any]) -> "TableRef":
    """A join row's table: ``source name.table`` for an external one, the model's own name otherwise."""
    kind, name = row.get("Table Type", "ref"), row["Table Name"]
    table = TableRef(name, kind)
    if table.kind == "source" and row.get("Source Name") and "." not in name:
        return TableRef(f"{row['Source Name']}.{name}", kind)
    return table


def _key_names(cell: str | Iterable[str] | None) -> tuple[str, ...]:
    """Column names of a key cell (comma separated) or list, without blanks."""
    return tuple(k.strip() for k in (cell.split(",") if isinstance(cell, str) else cell or ()) if k and k.strip())


def parse_grouping(text: str) -> tuple[tuple[str, ...], str, tuple[tuple[str, ...], ...]]:
    """Keys, kind and sets of a grouping cell: a list, ``ROLLUP (...)``, ``CUBE (...)`` or ``GROUPING SETS ((...), ...)``."""
    m = re.fullmatch(r"\s*(ROLLUP|CUBE|GROUPING\s+SETS)\s*\((.*)\)\s*", text, re.I | re.S)
    if not m:
        return tuple(split_list(text)), "plain", ()
    items = split_list(m.group(2))
    if not m.group(1).upper().startswith("GROUPING"):
        return tuple(items), m.group(1).lower(), ()
    sets = tuple(tuple(split_list(x[1:-1])) if x.startswith("(") and x.endswith(")") else (x,) for x in items)
    return tuple(dict.fromkeys(c for g in sets for c in g)), "sets", sets


@dataclass(frozen=True)
class TableRef:
    """A relation a model reads: an external ``source`` or another model (``ref``)."""

    name: str
    kind: str = "source"

    def __post_init__(self):
        kind = (self.kind or "source").lower()
        object.__setattr__(self, "kind", "source" if kind in ("source", "src") else "ref")


@dataclass(frozen=True)
class ColumnSpec:
    target: str
    logic: str | None = None
    source_table: str | None = None
    position: int | None = None

    @property
    def is_sequence(self) -> bool:
        return self.logic is not None and SEQUENCE_WORD in self.logic.upper()

    @property
    def is_artefact(self) -> bool:
        return self.target.strip().upper() in SHEET_ARTEFACTS


@dataclass(frozen=True)
class JoinSpec:
    """One join row.  ``skew="split"`` plans an outer join as inner join plus
    anti joins, so a hot key on either side can be split; ``"auto"`` does so where
    AQE alone cannot, ``"none"`` never (see ``join.py``)."""

    how: str
    table: TableRef
    alias: str
    condition: str | None
    skew: str = "auto"

    def __post_init__(self):
        if self.skew not in ("auto", "split", "none"):
            raise ValueError(f"skew must be 'auto', 'split' or 'none', got {self.skew!r}")


@dataclass(frozen=True)
class ModelSpec:
    source: TableRef
    target: str
    columns: tuple[ColumnSpec, ...]
    joins: tuple[JoinSpec, ...] = ()
    where: str | None = None
    group_by: tuple[str, ...] = ()
    grouping: str = "plain"
    grouping_sets: tuple[tuple[str, ...], ...] = ()  # with grouping "sets": the groupings, each some of ``group_by``
    having: str | None = None                        # a condition on groups
    derived: tuple[tuple[str, str], ...] = ()        # (name, logic) computed once per row, for the columns' logic to use
    materialization: str = "table"
    unique_key: tuple[str, ...] = ()
    sheet_key: tuple[str, ...] = ()        # the mapping sheet's key cell: used where no key is declared or kept
    primary_key: tuple[str, ...] = ()      # the target's primary key: used where no column name tells a key
    update_columns: tuple[str, ...] | None = None
    update_exclude: tuple[str, ...] | None = None
    delta: bool = False
    contract: StructType | None = None
    depends_on: tuple[str, ...] = ()
    buckets: int | None = None
    main_alias: str = "source"
    extra: dict[str, Any] = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.grouping not in GROUPINGS:
            raise ValueError(f"grouping must be one of {GROUPINGS}, got {self.grouping!r}")
        loads = MATERIALIZATIONS + ADDED_MATERIALIZATIONS
        if self.materialization not in loads:
            raise ValueError(f"materialization must be one of {loads}, got {self.materialization!r}")
        if len(self.target.split(".")) != 2:
            raise ValueError(f"target must be SCHEMA.TABLE, got {self.target!r}")
        # A blank key is no key.
        for name in ("unique_key", "sheet_key", "primary_key"):
            object.__setattr__(self, name, _key_names(getattr(self, name)))
        if self.buckets is not None and (self.buckets < 1 or not self.unique_key):
            raise ValueError("buckets needs a positive count and a unique key to bucket by")
        if bool(self.grouping_sets) != (self.grouping == "sets"):
            raise ValueError("grouping 'sets' and grouping_sets belong together")
        if unknown := {c for g in self.grouping_sets for c in g} - set(self.group_by):
            raise ValueError(f"grouping sets name {sorted(unknown)}, which group_by does not have")
        if self.having and not self.group_by:
            raise ValueError("a condition on groups needs a grouping")
        if self.delta and self.group_by:
            raise ValueError("a delta model cannot also group; the comparison runs on ungrouped rows")

    @property
    def target_schema(self) -> str:
        return self.target.split(".")[0]

    @property
    def target_table(self) -> str:
        return self.target.split(".")[1]

    @property
    def replaces(self) -> bool:
        """True for loads after which the table holds exactly the model's rows."""
        return self.materialization in ("table", "truncate_load", "lnd_load")

    @property
    def sequence_column(self) -> str | None:
        """The target column that a sequence numbers, if the mapping has one."""
        names = [c.target for c in self.columns if c.is_sequence and not c.is_artefact]
        if len(names) > 1:
            raise ValueError(f"more than one sequence column: {names}")
        return names[0] if names else None

    @property
    def exclusions(self) -> tuple[str, ...]:
        return DEFAULT_UPDATE_EXCLUDE if self.update_exclude is None else tuple(self.update_exclude)

    def refs(self) -> list[str]:
        """Names of other models this one reads (graph edges)."""
        out = [self.source.name] if self.source.kind == "ref" else []
        out += [j.table.name for j in self.joins if j.table.kind == "ref"]
        return out + list(self.depends_on)

    def with_(self, **changes) -> "ModelSpec":
        return replace(self, **changes)

    @classmethod
    def from_config(cls, cfg: dict[str, Any], **overrides) -> "ModelSpec":
        """Build a spec from the JSON shape of a flattened mapping sheet."""
        src = cfg["Source"]
        tgt = cfg["Target"]
        # A model is referred to by its target name; an external table also by its database.
        kind = src.get("Type", "source")
        base = f"{src['Schema']}.{src['Table Name']}"
        external = TableRef(base, kind).kind == "source" and src.get("Database")
        source = TableRef(f"{src['Database']}.{base}" if external else base, kind)
        columns = tuple(
            ColumnSpec(c["Target Column"], c.get("Logic"), c.get("Source Table") or None, c.get("Position"))
            for c in cfg.get("Columns", [])
        )
        joins = tuple(
            JoinSpec(j.get("Join Type") or "LEFT", _join_table(j), j["Alias"],
                     j.get("Join Condition") or None, (j.get("Skew") or "auto").lower())
            for j in cfg.get("Joins", [])
        )
        dag = cfg.get("DAG") or {}
        dep_schemas, dep_objects = dag.get("Dependency Schema") or [], dag.get("Dependency Object") or []
        if len(dep_schemas) != len(dep_objects):
            raise ValueError(f"dependency lists differ in length: {dep_schemas} vs {dep_objects}")
        deps = tuple(f"{s}.{o}" for s, o in zip(dep_schemas, dep_objects))
        group_by, grouping, sets = cfg.get("Group By") or (), "plain", ()
        if isinstance(group_by, str):
            group_by, grouping, sets = parse_grouping(group_by)
        exclude = cfg.get("MERGE_UPDATE_EXCLUDE_COLUMNS")
        kwargs = dict(
            source=source,
            target=f"{tgt['Schema']}.{tgt['Table Name']}",
            columns=columns,
            joins=joins,
            where=cfg.get("Where") or None,
            group_by=tuple(group_by),
            grouping=grouping,
            grouping_sets=sets,
            having=cfg.get("Having") or None,
            materialization=tgt.get("materialization") or "table",
            unique_key=_key_names(tgt.get("unique_key")),
            sheet_key=_key_names(cfg.get("UNIQUE_KEY")),
            primary_key=_key_names(tgt.get("primary_key")),
            update_exclude=tuple(exclude) if exclude is not None else None,
            delta=str(cfg.get("MINUS_LOGIC_REQUIRED", "N")).upper() in ("Y", "YES", "TRUE"),
            depends_on=deps,
        )
        kwargs.update(overrides)
        return cls(**kwargs)
