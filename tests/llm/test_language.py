"""Language identification: codes, margins against a plain loop, held-out accuracy, awkward tables."""

import numpy as np
import pytest
from edge import edge, empty, wide
from pyspark.sql import functions as F

from conftest import SF01
from mapflow.llm import language
from mapflow.llm.language import BUCKETS, LanguageModel, codewords, fit, identify, logistic, op12_language, plain


@pytest.mark.parametrize("k", [2, 3, 4, 7, 8, 20])
def test_codewords_are_apart_and_cut_both_ways(k):
    m = codewords(k)
    assert set(np.unique(m)) == {-1.0, 1.0}
    apart = (m.shape[1] - m @ m.T) / 2
    assert apart[~np.eye(k, dtype=bool)].min() >= (2 ** (k - 2) if k <= 7 else np.log2(k))
    assert (np.abs(m.sum(axis=0)) < k).all()
    assert len({tuple(c * c[0]) for c in m.T}) == m.shape[1] or k > 7  # no column is another or its negative


def slow_margin(text, weights):
    b, total = plain(text), np.zeros(weights.shape[1])
    for i in range(len(b) - 3):
        three = b[i] | b[i + 1] << 8 | b[i + 2] << 16
        total += weights[(three * 0x9E3779B1 & 0xFFFFFFFF) >> 16]
        total += weights[((three | b[i + 3] << 24) * 0x85EBCA6B & 0xFFFFFFFF) >> 16]
    return total / np.sqrt(max(2 * (len(b) - 3), 1))


def test_margins_do_not_depend_on_neighbours_or_cuts(monkeypatch):
    rng = np.random.default_rng(1)
    w = np.concatenate([rng.normal(size=(BUCKETS, 3)), np.zeros((1, 3))]).astype(np.float32)
    model = LanguageModel(["a", "b"], np.ones((2, 3)), w, np.ones(3), np.zeros(3), np.ones(3))
    texts = ["a", "Ünïcödé 漢字 text", "the quick brown fox " * 30, "x y", "É", "ends here"]
    want = np.array([slow_margin(t, w) for t in texts])
    for piece in (1 << 19, 64, 7):
        monkeypatch.setattr(language, "PIECE", piece)
        assert np.allclose(model.margins([plain(t) for t in texts]), want, atol=1e-4)


def test_plain():
    assert plain(None) == plain("") == plain(" 12 — 34!") == plain("\n\t") == b""
    assert plain("Don't  STOP, 24/7") == b"  don t stop "
    assert len(plain("a")) >= 4


def test_logistic_separates():
    x = np.linspace(-5, 5, 11)
    a, c = logistic(x, (x > 0).astype(float), (x <= 0).astype(float))
    assert a > 0 and a * 3 + c > 0 > a * -3 + c
    assert logistic(x, np.zeros(11), np.ones(11)) == (1.0, 0.0)


def test_held_out_accuracy_and_labels_that_must_not_matter(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = op12_language(spark, SF01)
    both = out.join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out and lang is not null")
    right, total = both.agg(F.count_if(F.expr("lang = lang_pred")), F.count("*")).first()
    assert total > 200 and right / total >= 0.98
    assert out.where("score < 0 or score > 1 or score is null").count() == 0
    hidden = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    garbled = docs.withColumn("lang", F.when(hidden, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    again = identify(docs, fit(garbled.repartition(7)))
    same = out.join(again.select("doc_id", F.col("lang_pred").alias("p"), F.col("score").alias("s")), "doc_id")
    assert same.where("p <> lang_pred or abs(s - score) > 1e-6").count() == 0
    assert same.count() == docs.count()


def test_mixed_texts_are_flagged_or_scored_lower(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = fit(docs)
    by_lang = {r.lang: r.text for r in docs.where("length(text) > 1500").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    mixed = by_lang["en"][:700] + " " + by_lang["de"][:700]
    pure = by_lang["en"][:1400]
    loss = model.losses(model.margins([plain(mixed), plain(pure)]))
    gap = np.sort(loss, axis=1)
    assert gap[0, 1] - gap[0, 0] < gap[1, 1] - gap[1, 0]
    n = {lang: i for i, lang in enumerate(model.languages)}
    assert set(np.argsort(loss[0])[:2]) == {n["en"], n["de"]}


def test_awkward_tables(spark):
    out = identify(edge(spark), fit(edge(spark)))
    rows = sorted(map(tuple, out.collect()), key=repr)
    assert len(rows) == edge(spark).count()
    assert all(r[2] == "und" and r[3] == 0 and not r[4] for r in rows if r[0] in (2, 3, 5))
    assert sorted(map(tuple, identify(wide(spark), fit(wide(spark))).collect()), key=repr) == rows
    assert fit(empty(spark)) is None and identify(empty(spark), None).count() == 0
    assert {r.lang_pred for r in identify(edge(spark), None).collect()} == {"und"}


def test_one_language(spark):
    docs = spark.createDataFrame([(i, "some words here", "en", None, 1) for i in range(20)] + [(99, "12", None, None, 1)], edge(spark).schema)
    out = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, fit(docs)).collect()}
    assert out[99] == ("und", 0.0) and out[0] == ("en", 1.0)
