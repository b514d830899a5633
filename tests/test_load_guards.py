"""Loads that must not lose, change or misnumber rows: casts, first loads at once, sequences."""

import datetime as dt
from decimal import Decimal

import pytest

from conftest import rows
from mapflow.operators import load_append, load_insert_by_name, load_merge, load_truncate
from mapflow.operators.keys import DuplicateKeyError
from mapflow.operators.load import last_number
from mapflow.operators.merge import align_to
from mapflow.sources.store import CommitConflict


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_keys_are_guarded_in_the_targets_type(spark, store):
    store.overwrite("DW.T", frame(spark, [(1, "a"), (2, "b")], "K bigint, V string"))
    with pytest.raises(Exception, match="does not fit bigint"):
        load_merge(store, "DW.T", frame(spark, [(1.2, "x"), (1.4, "y")], "K double, V string"), ["K"])
    with pytest.raises(DuplicateKeyError):
        load_merge(store, "DW.T", frame(spark, [("1", "x"), ("01", "y")], "K string, V string"), ["K"])
    assert rows(store.read("DW.T")) == [(1, "a"), (2, "b")]
    load_merge(store, "DW.T", frame(spark, [(2.0, "x"), (3.0, "y"), (None, "n")], "K double, V string"), ["K"])
    assert rows(store.read("DW.T")) == sorted([(1, "a"), (2, "x"), (3, "y"), (None, "n")], key=repr)


@pytest.mark.parametrize("value, have, want, ok", [
    (10.7, "double", "int", False), (10.0, "double", "int", True), (float("nan"), "double", "int", False),
    (2 ** 53 + 1, "bigint", "double", False), (2 ** 40, "bigint", "int", False), (7, "int", "bigint", True),
    (Decimal("1.25"), "decimal(10,2)", "decimal(10,1)", False), (Decimal("1.50"), "decimal(10,2)", "decimal(10,1)", True),
    ("abc", "string", "int", False), ("007", "string", "int", True), (None, "double", "int", True),
    (dt.datetime(2024, 1, 1, 5), "timestamp", "date", False), (dt.datetime(2024, 1, 1), "timestamp", "date", True),
    (dt.date(2024, 1, 1), "date", "timestamp", True), (0.1, "double", "float", False), (0.5, "double", "float", True),
    (3, "int", "string", True), (1.5, "double", "decimal(10,2)", True),
])
def test_casts_that_change_a_value_are_refused(spark, value, have, want, ok):
    out = align_to(frame(spark, [(value,)], f"V {have}"), frame(spark, [], f"V {want}").schema)
    if ok:
        assert (out.first()[0] is None) == (value is None)
    else:
        with pytest.raises(Exception, match="does not fit"):
            out.collect()


def test_insert_refuses_a_lossy_value(spark, store):
    store.overwrite("DW.I", frame(spark, [(1, "a")], "N int, V string"))
    with pytest.raises(Exception, match="column N"):
        load_insert_by_name(store, "DW.I", frame(spark, [(10.7,)], "n double"))
    assert rows(store.read("DW.I")) == [(1, "a")]


@pytest.mark.parametrize("load", ["merge", "append"])
def test_two_first_loads_conflict(spark, store, monkeypatch, load):
    run = (lambda d: load_merge(store, "DW.F", d, ["K"])) if load == "merge" else (lambda d: load_append(store, "DW.F", d))
    mine, theirs = frame(spark, [(1, "mine")], "K bigint, V string"), frame(spark, [(2, "theirs")], "K bigint, V string")
    snapshot, calls = store.snapshot, []

    def meanwhile(name):
        seen = snapshot(name)
        if not calls:  # the other load commits after this one has looked
            calls.append(1)
            store.overwrite("DW.F", theirs)
        return seen

    monkeypatch.setattr(store, "snapshot", meanwhile)
    with pytest.raises(CommitConflict):
        run(mine)
    monkeypatch.undo()
    assert rows(store.read("DW.F")) == [(2, "theirs")]
    run(mine)
    assert rows(store.read("DW.F")) == [(1, "mine"), (2, "theirs")]


def test_sequences_never_go_back(spark, store):
    batch = lambda *names: frame(spark, [(n,) for n in names], "NM string")
    numbers = lambda: {r.NM: r.SK for r in store.read("DW.S").collect()}
    load_truncate(store, "DW.S", batch("a", "b", "c"), sequence="SK", order_by=["NM"])
    assert numbers() == {"a": 1, "b": 2, "c": 3}
    load_truncate(store, "DW.S", batch("d", "e"), sequence="SK", order_by=["NM"])
    assert numbers() == {"d": 4, "e": 5}
    store.overwrite("DW.S", store.read("DW.S").where("SK < 5"))  # the largest is deleted
    load_append(store, "DW.S", batch("f"), "SK", ["NM"])
    assert numbers() == {"d": 4, "f": 6}
    load_merge(store, "DW.S", batch("f", "g"), ["NM"], sequence="SK")
    assert numbers() == {"d": 4, "f": 6, "g": 7}
    store.truncate("DW.S")
    load_insert_by_name(store, "DW.S", batch("h", "i"), "SK", ["NM"])
    assert numbers() == {"h": 8, "i": 9} and last_number(store, "DW.S", "sk") == 9
    load_insert_by_name(store, "DW.S", batch().where("1=0"), "SK", ["NM"])
    assert last_number(store, "DW.S", "SK") == 9


def test_numbering_starts_after_what_an_unmarked_table_holds(spark, store):
    store.overwrite("DW.U", frame(spark, [(41, "a")], "SK bigint, NM string"))
    load_append(store, "DW.U", frame(spark, [("b",)], "NM string"), "SK", ["NM"])
    assert rows(store.read("DW.U")) == [(41, "a"), (42, "b")]


def test_truncate_with_a_base_keeps_what_came_meanwhile(spark, store):
    schema = "K bigint"
    store.overwrite("DW.B", frame(spark, [(1,)], schema))
    base = store.snapshot("DW.B")
    store.append("DW.B", frame(spark, [(50,)], schema))
    with pytest.raises(CommitConflict):
        load_truncate(store, "DW.B", frame(spark, [(2,)], schema), base=base)
    assert rows(store.read("DW.B")) == [(1,), (50,)]
    load_truncate(store, "DW.B", frame(spark, [(2,)], schema))  # without one, the last writer wins
    assert rows(store.read("DW.B")) == [(2,)]
