"""Prefix tries against a dictionary of prefixes, against their SQL, over small shards and layers."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mapflow.llm.prefix_trie import OP11_SQL, DoubleArray, op11_prefix_trie, prefix_nodes

SCHEMA = "conv_id long, turn long, role string, text string"


def test_double_array_holds_its_paths_and_no_others():
    rng = random.Random(1)
    for width, n in ((3, 60), (40, 400), (2000, 2000)):
        paths = sorted({tuple(rng.randrange(width) for _ in range(rng.randint(0, 6))) for _ in range(n)})
        trie = DoubleArray([list(p) for p in paths])
        node, prefixes = {(): 0}, {p[:d] for p in paths for d in range(len(p) + 1)}
        for p in sorted(prefixes - {()}, key=len):
            to = int(trie.step(np.array([node[p[:-1]]]), np.array([p[-1]]))[0])
            assert to > 0 and trie.check[to] == node[p[:-1]]
            node[p] = to
        assert len(set(node.values())) == len(prefixes) == 1 + (trie.check >= 0).sum()
        for _ in range(300):
            p, c = rng.choice(sorted(prefixes)), rng.randrange(width + 5)
            assert (trie.step(np.array([node[p]]), np.array([c]))[0] >= 0) == (p + (c,) in prefixes)
        assert len(trie.check) <= 4 * (len(prefixes) + width) + 1024


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
        convs.setdefault(conv, []).append((turn is not None, turn or 0, digest, len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    for x in convs.values():
        x.sort()
    built = {}
    for c, own in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        donor = convs.get(c - c % 20, []) if c is not None else []
        built[c] = [x[2:] for x in donor[:h] + own[h:]]
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    name = lambda cs: min((c for c in cs if c is not None), default=None)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children.get(p, [])) or 1
        saved[p] = sum(saved[c] for c in children.get(p, [])) + ((len(members[p]) - 1) * p[-1][1] if p else 0)
    out = []
    for p, cs in members.items():
        ends = sorted((c for c in cs if len(built[c]) == len(p)), key=lambda c: (c is not None, c))
        digest = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((name(cs), len(p), name(members[p[:-1]]) if p else None, len(cs), len(children.get(p, [])), leaves[p], saved[p], digest))
    return sorted(out, key=repr)


def result(df):
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def odd_rows(seed=2, convs=60):
    rng, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        if rng.random() < .1:
            continue
        for turn in [None, *range(rng.randint(0, 5))]:
            rows.append((conv, turn if rng.random() > .05 else None, rng.choice(["user", None, ""]),
                         rng.choice(["a b", "c", "", None, " \t", "é ü"])))
    return rows + [(41, 1, "user", "same"), (41, 1, "user", "same"), (10**12, 1, "x", "far " * 5000)]


@pytest.mark.parametrize("segment, shard", [(1 << 14, 50_000), (1 << 14, 6), (3, 50_000), (2, 4), (1, 1)])
def test_odd_conversations_over_shards_and_layers(spark, segment, shard):
    rows = odd_rows()
    got = result(prefix_nodes(spark.createDataFrame(rows, SCHEMA).repartition(3), segment, shard))
    assert got == brute(rows)


def test_hot_prefix_copies_and_a_long_conversation(spark):
    rng = random.Random(4)
    rows = [(c, t, "user", f"copy {t}") for c in range(0, 900) for t in range(3)]
    rows += [(c, t, "user", "start here" if t == 0 else f"{rng.random()}") for c in range(1000, 1400) for t in range(3)]
    rows += [(5000, t, "user", f"long {t % 17} {t // 40}") for t in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert result(prefix_nodes(df, shard=200)) == want
    assert result(prefix_nodes(df, segment=256, shard=100)) == want


def test_empty_turnless_and_wide_tables(spark):
    assert result(prefix_nodes(spark.createDataFrame([], SCHEMA))) == []
    # Conversation 1 keeps nothing: its donor is absent and it has fewer turns than it would take.
    rows = [(c, 0, "user", "only") for c in range(1, 20)]
    assert result(prefix_nodes(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    lone = [next(r for r in rows if zlib.crc32(str(r[0]).encode()) % 4)]
    assert [r[1:7] for r in result(prefix_nodes(spark.createDataFrame(lone, SCHEMA)))] == [(0, None, 1, 0, 1, 0)]
    rows = odd_rows(8, 30)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pid", "pos", "place", "symbol", "path", "context", "layer", "mark", "n", "kind"):
        df = df.withColumn(name, F.lit("x"))
    assert result(prefix_nodes(df)) == brute(rows)


@pytest.mark.parametrize("odd", [False, True])
def test_query_matches_sql(spark, tmp_path, odd):
    path = "/root/testdata/sf0.01"
    if odd:
        path = str(tmp_path)
        spark.createDataFrame(odd_rows(5), SCHEMA).write.parquet(f"{path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{path}/conversations.parquet{'/*.parquet' if odd else ''}')")
    cur = con.execute(OP11_SQL)
    names = [d[0] for d in cur.description]
    at = [names.index(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")]
    assert result(op11_prefix_trie(spark, path)) == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=repr)
