import random
import zlib

import numpy as np
import pytest
from edge import ROWS, edge, empty, labels, same, wide

from pyspark.sql import functions as F

from mapflow.llm.toxicity import (BUCKETS, best_window, fit, grams, hash_of, learnt_from, op1_toxicity, plain_words, score,
                                   train)

CHECK_S = "/root/testdata/sf0.1"
BAD = "idiotic worthless disgusting pathetic moronic".split()


def corpus(n, seed):
    rng = random.Random(seed)
    syll = "an er th on re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    word = lambda: "".join(rng.choices(syll, k=rng.randint(1, 4)))
    texts, toxic = [], []
    for _ in range(n):
        t = [word() for _ in range(rng.randint(20, 400))]
        y = rng.random() < 0.25
        if y:
            for _ in range(3):
                t.insert(rng.randrange(len(t)), rng.choice(BAD))
        texts.append(" ".join(t))
        toxic.append(int(y))
    return texts, toxic


@pytest.fixture(scope="module")
def model():
    texts, toxic = corpus(700, 1)
    return train([plain_words(t) for t in texts], toxic, [i % 4 == 0 for i in range(len(texts))], buckets=1 << 16)


def raw(model, text):
    return best_window(model.word_scores(plain_words(text)), model.window)[0]


def test_held_out_accuracy(model):
    texts, toxic = corpus(400, 2)
    p = model.probability(np.array([raw(model, t) for t in texts])) >= 0.3
    y = np.array(toxic, bool)
    assert p[y].mean() > 0.97 and p[~y].mean() < 0.03


def test_unseen_misspellings_share_vectors(model):
    number = lambda w: float(model.word_scores(plain_words(w)).mean())
    for w, known in (("w0rthless", "worthless"), ("worthlesss", "worthless"), ("worthles", "worthless"), ("disgustingg", "disgusting"),
                     ("path3tic", "pathetic"), ("disgusting!!", "disgusting"), ("IDIOTIC", "idiotic"), ("moronicc", "moronic")):
        assert number(w) > 0.4 * number(known) > 0 > number("the"), w


def test_a_few_words_in_a_very_long_text_count(model):
    clean = " ".join(corpus(1, 3)[0] * 100)
    assert model.probability(np.array([raw(model, clean)])) < 0.3
    assert model.probability(np.array([raw(model, f"{clean} disgusting moronic worthless {clean}")])) > 0.9


def test_grams_of_each_word_stand_alone():
    words = [b"abc", b"a", "é".encode(), b"abcdefgh", b"abc"]
    ids, starts = grams(words, BUCKETS)
    parts = np.split(ids, starts[1:])
    assert parts[0].tolist() == parts[4].tolist()
    for w, got in zip(words, parts):
        alone, _ = grams([w], BUCKETS)
        assert got.tolist() == alone.tolist() and len(got) == 1 + sum(max(0, len(w) + 2 - n + 1) for n in (3, 4, 5, 6))


def test_whole_table_held_out(spark):
    got = {r.doc_id: r for r in op1_toxicity(spark, CHECK_S).collect()}
    assert len(got) == spark.read.parquet(f"{CHECK_S}/documents.parquet").count()
    rows = [r for r in spark.read.parquet(f"{CHECK_S}/labels.parquet").collect() if r.doc_id in got]
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(got[r.doc_id].score, r.toxic) for r in rows if got[r.doc_id].held_out]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(np.array(neg) < s).mean() + 0.5 * (np.array(neg) == s).mean() for s in pos])
    assert auc > 0.9
    assert np.mean(np.array(neg) >= 0.3) < 0.03


def test_held_out_recall_and_precision_at_the_cut(spark):
    """Trained in full, three toxic documents in four are predicted; 18 passes instead of 42 found 74 of 120."""
    got = {r.doc_id: r for r in op1_toxicity(spark, CHECK_S).collect()}
    held = [(got[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{CHECK_S}/labels.parquet").collect()
            if r.doc_id in got and got[r.doc_id].held_out]
    hits = sum(p and y for p, y in held)
    assert hits / sum(y for _, y in held) > 0.72 and hits / sum(p for p, _ in held) > 0.9


def test_labels_of_held_out_rows_change_nothing(spark):
    texts, toxic = corpus(200, 6)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    one = [(i, 1, y) for i, y in enumerate(toxic)]
    two = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, q, y in one]
    a, b = (fit(docs, labels(spark, rows), start_epochs=2, rounds=1, least_steps=4) for rows in (one, two))
    assert np.array_equal(a.bucket, b.bucket) and (a.slope, a.shift) == (b.slope, b.shift)


def test_edges(spark, model):
    rows = score(edge(spark), model).collect()
    assert len(rows) == len(ROWS)
    assert len({round(r.score, 12) for r in rows if r.doc_id in (2, 3, 5)}) == 1
    assert all(0 <= r.score <= 1 for r in rows)
    same(score(wide(spark), model), score(edge(spark), model))
    assert score(empty(spark), model).count() == 0
    for lab in (labels(spark), labels(spark, [(1, 1, 0), (4, 1, 0), (None, 1, 1), (6, 1, None)])):
        know_nothing = fit(edge(spark), lab)
        assert len({r.score for r in score(edge(spark), know_nothing).collect()}) == 1
    assert fit(empty(spark), labels(spark, [(1, 1, 1)])).slope == 0
    assert hash_of(-1) >= 0


def test_labelled_texts_without_words(spark):
    docs = spark.createDataFrame([(i, "" if i % 2 else None) for i in range(40)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    scores = {r.score for r in score(docs, fit(docs, marks)).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


def test_sample_is_bounded_in_rows_and_bytes(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, "word " * (10 + i % 7)) for i in range(400)] + [(ids[0], "word " * 60)] * 50
                                 + [(401, "long " * 100_000), (None, "word")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(402)] * 2, "doc_id long, toxic int")
    length = {i: 5 * (10 + i % 7) - 1 for i in ids}
    everything = learnt_from(docs, marks)
    assert everything.column("doc_id").to_pylist() == sorted([*ids, *([401] if zlib.crc32(b"401") % 4 != 2 else [])])
    assert len(learnt_from(docs, marks, sample_docs=25)) == 25
    order = [r.doc_id for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    few = learnt_from(docs, marks, sample_bytes=6400)  # a 64th is 100 bytes: the long text is left out, not those before it
    total, taken = 0, []
    for i in order:
        total += length[i]
        if total > 6400:
            break
        taken.append(i)
    assert 0 < len(taken) < len(ids) and few.column("doc_id").to_pylist() == sorted(taken)
    assert sum(map(len, few.column("words").to_pylist())) <= 6400
    assert all(0 <= r.score <= 1 for r in score(docs, fit(docs, marks, sample_bytes=6400)).collect())
