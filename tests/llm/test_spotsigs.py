import hashlib
import random
import re

from edge import ROWS, edge, empty, wide
from pyspark.sql import functions as F

from conftest import SF001, plan_text
from mapflow.llm.spotsigs import (_buckets, ANCHORS, CHAIN, LEAST, RUN, length_class, likeness, near_classes, op10_spotsigs, with_next,
                                  with_signatures)


def brute(text):
    """Signatures word by word: chains start behind anchors, at the start, and after every RUN words without one."""
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    content, starts, since = [], [], 0
    fresh = True
    for w in words:
        if w in ANCHORS:
            fresh = True
            continue
        if fresh or since == RUN:
            starts.append(len(content))
            since = 0
        fresh, since = False, since + 1
        content.append(w)
    return {"  ".join(content[s:s + CHAIN]) for s in starts}


def jaccard(a, b):
    if not a and not b:
        return 1.0
    if not a or not b or min(len(a), len(b)) < LEAST * max(len(a), len(b)):
        return 0.0
    j = len(a & b) / len(a | b)
    return j


def test_whole_table_against_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{SF001}/documents.parquet").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in op10_spotsigs(spark, SF001).collect()}
    assert len(got) == len(docs)
    for r, nxt in zip(docs, docs[1:] + docs[:1]):
        cut = len(r.text) // 4
        edited = r.text[:len(r.text) - cut] + nxt.text[:cut]
        a, b, c = brute(r.text), brute(edited), brute(nxt.text)
        g = got[r.doc_id]
        assert g.n_chars == len(r.text) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert g.fingerprint == ",".join(sorted({hashlib.md5(x.encode()).hexdigest()[:16] for x in a}))
        assert g.near_edited == jaccard(a, b) and g.near_next == jaccard(a, c)


def test_near_texts_are_near(spark):
    rows = op10_spotsigs(spark, SF001).where("n_chars > 400").collect()
    assert sum(r.near_edited for r in rows) / len(rows) > 0.5
    assert sum(r.near_next for r in rows) / len(rows) < 0.05


def test_pruning_never_hides_a_likeness(spark):
    sets = spark.createDataFrame([([f"{i}" for i in range(a, b)],) for a, b in ((0, 0), (0, 1), (0, 5), (0, 100), (2, 90), (0, 2000), (1990, 2005))],
                                 "s array<string>")
    rows = sets.crossJoin(sets.withColumnRenamed("s", "t")).select("s", "t", likeness(F.col("s"), F.col("t")).alias("j"),
                                                                   F.abs(length_class(F.col("s")) - length_class(F.col("t"))).alias("d")).collect()
    for r in rows:
        assert r.j == jaccard(set(r.s), set(r.t))
        if r.d > 1 and r.s and r.t:
            assert len(set(r.s) & set(r.t)) / len(set(r.s) | set(r.t)) < LEAST


def test_next_document_with_many_ranges(spark):
    ids = [i * i * (-1) ** i for i in range(500)] + [10 ** 17, -(10 ** 17)]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(7)
    want = dict(zip(sorted(ids), sorted(ids)[1:] + sorted(ids)[:1]))
    assert {r.doc_id: r.next_text for r in with_next(docs).collect()} == {i: f"t{j}" for i, j in want.items()}


def test_native_plan(spark):
    text = plan_text(op10_spotsigs(spark, SF001))
    assert not re.search("Python|Pandas|MapInArrow", text)


def test_edges(spark, tmp_path):
    for name, df in (("edge", edge(spark)), ("wide", wide(spark)), ("empty", empty(spark)), ("one", edge(spark).where("doc_id = 4"))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    rows = op10_spotsigs(spark, f"{tmp_path}/edge").collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].fingerprint == by_id[3].fingerprint == by_id[5].fingerprint == "" and by_id[2].near_next == 1.0
    first = [r for r in rows if r.doc_id == 1]
    assert first[0].fingerprint == first[1].fingerprint and max(r.near_next for r in first) == 1.0
    assert sorted(map(repr, op10_spotsigs(spark, f"{tmp_path}/wide").collect())) == sorted(map(repr, rows))
    assert op10_spotsigs(spark, f"{tmp_path}/empty").count() == 0
    one = op10_spotsigs(spark, f"{tmp_path}/one").collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_near_classes_against_all_pairs(spark):
    rng, texts = random.Random(2), []
    for _ in range(12):
        words = [rng.choice(("the", "of", "and", f"w{rng.randrange(400)}", f"v{rng.randrange(400)}")) for _ in range(rng.randint(30, 300))]
        for _ in range(rng.randint(1, 6)):
            texts.append(" ".join(w if rng.random() > 0.01 else f"x{rng.randrange(99)}" for w in words))
    texts += [texts[0], texts[0], "", " ", "the of"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    pairs, member = near_classes(docs, 0.6)
    sets = [frozenset(brute(t)) for t in texts]
    first = {s: i for i, s in reversed(list(enumerate(sets)))}
    assert {r.doc_id: r.class_id for r in member.collect()} == {i: first[s] for i, s in enumerate(sets)}
    want = {(a, b) for a in first.values() for b in first.values()
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    got = pairs.collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want) > 10


def test_long_rows_of_anchors(spark):
    """A repeated group in the splitting pattern would overflow the stack here."""
    df = spark.createDataFrame([("the " * 60_000 + "cat sat " + "of the and " * 20_000,), ("word " * 50_000,)], "t string")
    a, b = with_signatures(df, "t", "s").select("s").collect()
    assert len(a.s) == 1 and len(b.s) <= 3


def test_equal_texts_have_equal_signatures(spark):
    df = spark.createDataFrame([("The cat of the house, and a dog.",), ("the CAT of the house and a dog",)], "t string")
    a, b = with_signatures(df, "t", "s").select("s").collect()
    assert a.s == b.s and len(a.s) == 3


def test_many_rows_of_one_id_fall_into_several_ranges(spark):
    """A third of the rows have no id and a third share one: ranges stay even, and the order is that of id and hash."""
    rows = [(None if i % 3 == 0 else 500 if i % 3 == 1 else i, f"the text {i} of some and other words {i * 7}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    keyed = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("h"))
    sizes = [r["count"] for r in keyed.groupBy(_buckets(keyed.select("k"), 30).alias("b")).count().collect()]
    assert len(sizes) >= 28 and max(sizes) <= 75
    got = with_next(docs).collect()
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    line = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], hashes[r[1]]))
    want = {(a[0], a[1]): b[1] for a, b in zip(line, line[1:] + line[:1])}
    assert len(got) == 900 and {(r.doc_id, r.text): r.next_text for r in got} == want
