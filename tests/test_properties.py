"""Property checks against plain-Python semantics on random small tables."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mapflow.operators import distinct_except, merge_frames

ROW = st.tuples(st.one_of(st.none(), st.integers(-3, 3)),
                st.one_of(st.none(), st.sampled_from(["a", "b", ""])),
                st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan")])))
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))


def _norm(v):
    if isinstance(v, float):
        if v != v:
            return "NaN"
        return 0.0 if v == 0 else v
    return v


def _key(row):
    return tuple(_norm(v) for v in row)


@SETTINGS
@given(left=st.lists(ROW, max_size=12), right=st.lists(ROW, max_size=12))
def test_except_is_set_difference(spark, left, right):
    schema = "a int, b string, c double"
    l, r = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = Counter(_key(tuple(x)) for x in distinct_except(l, r).collect())
    want = Counter(set(_key(x) for x in left) - set(_key(x) for x in right))
    assert got == want


TARGET = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["t1", "t2"]),
                            st.sampled_from(["old"])), max_size=10)
BATCH = st.dictionaries(st.integers(0, 9), st.sampled_from(["s1", "s2"]), max_size=6)


@SETTINGS
@given(target=TARGET, batch=BATCH, null_rows=st.integers(0, 2), how=st.sampled_from(["shuffle", "broadcast"]))
def test_merge_is_dict_upsert(spark, target, batch, null_rows, how):
    schema = "K int, V string, CREATE_BY string"
    src_rows = [(k, v, "new") for k, v in batch.items()] + [(None, "sn", "new")] * null_rows
    out = merge_frames(spark.createDataFrame(target, schema), spark.createDataFrame(src_rows, schema),
                       ["K"], strategy=how)
    want = []
    keys_in_target = {k for k, _, _ in target if k is not None}
    for k, v, c in target:  # matched rows take V from the batch, keep CREATE_BY
        want.append((k, batch[k], c) if k is not None and k in batch else (k, v, c))
    want += [(k, v, "new") for k, v in batch.items() if k not in keys_in_target]
    want += [(None, "sn", "new")] * null_rows  # NULL keys never match: inserted
    assert Counter(tuple(x) for x in out.collect()) == Counter(want)
