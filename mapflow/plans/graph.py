"""Runs of dependent models, in order.

Edges come from ``ref`` sources and joins and from declared dependencies.
Ordering, cycle detection and step lists are driver-side bookkeeping over a
handful of specs; every model itself is a Spark plan.  A model that loads a
table is written once and its downstream models read the stored version (so
an upstream is never recomputed per consumer); a ``view`` model stays a lazy
DataFrame that Catalyst inlines into its consumers.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.audit import RunContext
from ..operators.delta import build_delta
from ..operators.keys import assert_unique_keys, with_merge_key
from ..operators.load import materialize
from ..operators.select import build_model
from ..sources.registry import TableRegistry
from ..sources.store import TableStore
from ..spec import ModelSpec


class CycleError(ValueError):
    pass


def topo_order(specs: Sequence[ModelSpec]) -> list[ModelSpec]:
    """Models ordered so each runs after the models it reads; stable by input order."""
    by_name = {s.target.upper(): s for s in specs}
    if len(by_name) != len(specs):
        raise ValueError("two models load the same target")
    deps = {n: [r.upper() for r in s.refs() if r.upper() in by_name] for n, s in by_name.items()}
    done: list[str] = []
    state: dict[str, int] = {}

    def visit(n: str, path: list[str]):
        if state.get(n) == 2:
            return
        if state.get(n) == 1:
            raise CycleError("cyclic model references: " + " -> ".join(path + [n]))
        state[n] = 1
        for d in deps[n]:
            visit(d, path + [n])
        state[n] = 2
        done.append(n)

    for s in specs:
        visit(s.target.upper(), [])
    return [by_name[n] for n in done]


def merge_key(spec: ModelSpec, store: TableStore) -> tuple[ModelSpec, dict]:
    """``spec`` with its merge key, and tags for the version that the merge will commit.

    A declared key is kept with the table for later loads that declare none.  A key told from names alone is
    trusted only after the table's rows are found unique by it: one ``groupBy``, not repeated while
    the table's newest version is one that a merge by this key has made.
    """
    if spec.materialization != "incremental":
        return spec, {}
    now = store.snapshot(spec.target)
    tags = now.tags if now else {}
    keyed = with_merge_key(spec, tags.get("declared_key"))
    key = list(keyed.unique_key)
    if spec.unique_key:
        return keyed, {"declared_key": key}
    if tags.get("declared_key") or spec.sheet_key:
        return keyed, {}
    if now and tags.get("checked_key") != [key, now.version]:
        assert_unique_keys(store.read(spec.target, now), key, what=f"table {spec.target}, whose key was chosen by name,")
    return keyed, {"checked_key": [key, (now.version if now else 0) + 1]}


def run_models(specs: Sequence[ModelSpec], registry: TableRegistry, store: TableStore | None = None,
               ctx: RunContext = RunContext()) -> dict[str, DataFrame]:
    """Build (and load) every model in dependency order; returns each output."""
    out: dict[str, DataFrame] = {}
    for spec in topo_order(specs):
        if store is not None:
            spec, tags = merge_key(spec, store)  # an incremental model always merges by some key
        if spec.delta and store is not None:
            # A replacing load empties its target first: every row of the model is new to it.
            current = store.read(spec.target) if store.exists(spec.target) and not spec.replaces else None
            df = build_delta(spec, registry, current, ctx)
        else:
            df = build_model(spec, registry, ctx)
        if spec.materialization != "view":
            if store is None:
                raise ValueError(f"model {spec.target} loads a table but no store was given")
            df = materialize(spec, df, store, ctx, tags)
        registry.register_ref(spec.target, df)
        out[spec.target.upper()] = df
    return out


@dataclass
class Job:
    """Ordered load steps, each one Spark action (build, merge, insert...)."""

    name: str
    steps: list[tuple[str, Callable[[], object]]] = field(default_factory=list)
    timings: dict[str, float] = field(default_factory=dict)

    def add(self, name: str, fn: Callable[[], object]) -> "Job":
        self.steps.append((name, fn))
        return self

    def run(self) -> dict[str, object]:
        results = {}
        for name, fn in self.steps:
            t0 = time.perf_counter()
            results[name] = fn()
            self.timings[name] = time.perf_counter() - t0
        return results


def spec_job(spec: ModelSpec, registry: TableRegistry, store: TableStore, ctx: RunContext = RunContext(),
             steps: Sequence[str] = ("build", "merge", "insert")) -> Job:
    """The load steps of one spec in their fixed order: build, then merge, then insert.

    ``build`` loads the model's table as its spec says; ``merge`` upserts the model's
    rows by its key; ``insert`` appends them by name.  ``steps`` picks which run.
    """
    if unknown := set(steps) - {"build", "merge", "insert"}:
        raise ValueError(f"unknown steps {sorted(unknown)}")

    def merge() -> DataFrame:
        keyed, tags = merge_key(spec.with_(materialization="incremental"), store)
        return materialize(keyed, build_model(keyed, registry, ctx), store, ctx, tags)

    runs = {
        "build": lambda: run_models([spec], registry, store, ctx)[spec.target.upper()],
        "merge": merge,
        "insert": lambda: materialize(spec.with_(materialization="insert"), build_model(spec, registry, ctx), store, ctx),
    }
    job = Job(spec.target)
    for name in ("build", "merge", "insert"):
        if name in steps:
            job.add(name, runs[name])
    return job
