"""Conversation repair against exhaustive search, against its SQL, and over block borders."""

import heapq
import itertools
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from mapflow.llm.turn_repair import (LEGAL_PAIRS, OP13_SQL, best_symbol, chart, chosen, damaged, leaf, op13_turn_repair, parse,
                                     parse_tokens, repair, repaired_lines, short)

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def edits_of(token):
    """(cost, letter, output) of one row."""
    out = [(4, "D", "")]
    if token != "x":
        late = 3 if token.isupper() else 0
        if token.lower() != "o":
            out.append((late, "K", token.lower()))
        out += [(3 + late, "R", "u"), (3 + late, "R", "a")]
    return out


def every_way(tokens):
    """Least (cost, audit) by trying all edits with up to two insertions in every gap."""
    gaps = ["", *"ua", *map("".join, itertools.product("ua", repeat=2))]
    best = None
    for added in itertools.product(gaps, repeat=len(tokens) + 1):
        for edits in itertools.product(*map(edits_of, tokens)):
            out = added[0] + "".join(e[2] + g for e, g in zip(edits, added[1:]))
            if LEGAL.fullmatch(out):
                audit = "I" * len(added[0]) + "".join(e[1] + "I" * len(g) for e, g in zip(edits, added[1:]))
                cost = sum(e[0] for e in edits) + 3 * sum(map(len, added))
                best = min(best or (cost, audit), (cost, audit))
    return best


def search(tokens):
    """The same by uniform-cost search over (row, last output), for longer conversations."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(tokens) and last in ("", "a"):
            return cost, audit
        for out in set(follows[last]) & {"u", "a"}:
            heapq.heappush(heap, (cost + 3, audit + "I", i, out))
        if i < len(tokens):
            for c, letter, out in edits_of(tokens[i]):
                if not out or out in follows[last]:
                    heapq.heappush(heap, (cost + c, audit + letter, i + 1, out or last))


def answer(span):
    cell = span[best_symbol(span)]
    return cell.cost, cell.audit


def test_all_short_conversations():
    for n in (1, 2):
        for tokens in itertools.product("suaoSUAOx", repeat=n):
            assert answer(parse_tokens("".join(tokens))) == every_way(tokens) == search(tokens), tokens


def test_longer_conversations_across_charts():
    rng = random.Random(3)
    for _ in range(150):
        tokens = "".join(rng.choices("suaoSUAOx", [1, 5, 5, 1, 1, 2, 2, 1, 2], k=rng.randint(3, 40)))
        assert answer(parse_tokens(tokens)) == search(tokens), tokens


def test_any_cut_gives_the_same_cells():
    rng = random.Random(5)
    for _ in range(60):
        tokens = "".join(rng.choices("suaUAx", k=7))
        whole = {s: (c.cost, c.audit) for s, c in short(tokens).items()}
        k = rng.randint(1, 6)
        halves = chart([short(tokens[:k]), short(tokens[k:])])
        assert {s: (c.cost, c.audit) for s, c in halves.items()} == whole


def test_chosen_symbols_rebuild_the_audit():
    rng = random.Random(7)
    for n in (1, 2, 9, 30):
        parts = [dict(leaf(t)) for t in rng.choices("suaxA", k=n)]
        whole = parse(parts)
        name = best_symbol(whole)
        names = chosen(whole, name, parts)
        assert "".join(p[x].audit for p, x in zip(parts, names)) == whole[name].audit


def brute(rows):
    """Result rows of one conversation, without its id, from its damaged rows in order."""
    import hashlib

    seen, tokens, tally = set(), "", dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            tally[fault] += 1
        kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
        tokens += "x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
    cost, audit = search(tokens)
    lines, at, last = [], 0, ""
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        wanted = "assistant" if last == "u" else "user"
        lines.append((wanted, "") if letter == "I" else (rows[at][1] if letter == "K" else wanted, rows[at][2]))
        at += letter != "I"
        last = lines[-1][0][:1]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in LEGAL_PAIRS for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, tally["blank"], tally["duplicate"], tally["truncated"], illegal, cost, audit, digest), lines


def result(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def expected(spark, rows, originals):
    by_conv = {r[0]: [] for r in originals.select("conv_id").distinct().collect()}
    for r in rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text").collect():
        by_conv[r.conv_id].append((r.turn, r.role, r.text))
    return {c: brute(x) for c, x in by_conv.items()}


def odd_conversations(spark):
    rng, rows = random.Random(11), []
    for conv in [*range(40), None]:
        for turn in [None, *range(rng.randint(0, 9))]:
            rows.append((conv, turn if rng.random() > .1 else None, rng.choice(["user", "assistant", "system", "tool", "", None, "Über"]),
                         rng.choice(["Fine.", "Cut", "", None, " \t ", "Ends? \n", "“quoted.”", "line\nbreak!", "퟿ ", "x" * 50_000 + "."])))
    rows += [(77, 1, "user", "Same row."), (77, 1, "user", "Same row.")]
    return spark.createDataFrame(rows, SCHEMA)


def test_odd_conversations_over_small_blocks(spark):
    table = odd_conversations(spark)
    rows = damaged(table)
    want = {c: x[0] for c, x in expected(spark, rows, table).items()}
    assert result(repair(rows, table)) == want
    assert result(repair(rows, table, block=2)) == want
    assert result(repair(rows.repartition(5), table, block=3)) == want


def test_hot_conversation_and_its_lines(spark):
    rng = random.Random(13)
    rows = spark.createDataFrame(
        [(1 if i % 3 else 2 + i % 50, i, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", "Perhaps!", f"Number {i}."])) for i in range(3000)],
        SCHEMA)
    want = expected(spark, rows, rows)
    assert result(repair(rows, rows, block=16)) == {c: x[0] for c, x in want.items()}
    lines = {}
    for r in repaired_lines(rows, block=16).orderBy("conv_id", "line").collect():
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    assert lines == {c: x[1] for c, x in want.items() if x[1]}


def test_empty_table_and_further_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert result(repair(damaged(none), none)) == {}
    wide = odd_conversations(spark)
    plain = result(repair(damaged(wide), wide))
    for name in ("pid", "pos", "at", "of", "cells", "symbol", "kind", "what", "fault"):
        wide = wide.withColumn(name, F.lit("x"))
    assert result(repair(damaged(wide), wide)) == plain


@pytest.mark.parametrize("odd", [False, True])
def test_query_matches_sql(spark, tmp_path, odd):
    path = "/root/testdata/sf0.01"
    if odd:
        path = str(tmp_path)
        odd_conversations(spark).write.parquet(f"{path}/conversations.parquet")
    got = {r["conv_id"]: r.asDict() for r in op13_turn_repair(spark, path).collect()}
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{path}/conversations.parquet{'/*.parquet' if odd else ''}')")
    rows = con.execute(OP13_SQL)
    names = [d[0] for d in rows.description]
    assert got == {r[0]: dict(zip(names, r)) for r in rows.fetchall()}
