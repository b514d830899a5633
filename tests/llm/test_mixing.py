import collections

import pytest
from edge import ROWS, edge, empty, same, wide

from conftest import SF01
from mapflow.llm.mixing import mix, mixed_rows, op5_mixing, targets


def reshare(sizes, weights=(3, 1, 2)):
    """Targets by the rule's own words: share by weight, stop at twice the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            out.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 10, "d": 5}, {"a": 1, "b": 1, "c": 1, None: 100}, {"z": 7}, {"a": 0, "b": 9},
                                   {f"s{i:02}": (i * 37) % 101 for i in range(30)}])
def test_targets_are_the_reshared_ones(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in targets(df).collect()}
    want = reshare(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_whole_table(spark):
    rows = op5_mixing(spark, SF01).collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    taken, target, largest = collections.Counter(), {}, collections.Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    same(op5_mixing(spark, SF01), op5_mixing(spark, SF01))


def test_rows_of_the_mix(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = {r.doc_id: r.taken // r["size"] for r in op5_mixing(spark, SF01).collect() if r.taken}
    got = collections.Counter(r.doc_id for r in mixed_rows(docs).collect())
    assert {d: n for d, n in got.items() if d in want} == want
    assert mixed_rows(docs).columns == docs.columns


def test_one_hot_source_of_equal_sizes(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'one two three' as text", "if(id % 3 = 0, 'x', 'hot') as source")
    rows = mix(docs).collect()
    per = collections.Counter()
    for r in rows:
        per[r.source] += r.taken
    assert all(abs(per[r.source] - r.target) <= 3 for r in rows)


def test_edges(spark):
    assert mix(empty(spark)).count() == 0 and mixed_rows(empty(spark)).count() == 0
    rows = mix(edge(spark)).collect()
    assert len(rows) == len(ROWS)
    assert {r["size"] for r in rows if r.doc_id in (2, 3, 5)} == {0}
    same(mix(wide(spark)), mix(edge(spark)))
    out = mixed_rows(wide(spark))
    assert out.columns == wide(spark).columns
    out.collect()
