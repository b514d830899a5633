import random

import numpy as np
from edge import ROWS, edge, empty, labels, same, wide

from conftest import SF01
from mapflow.llm.quality import (BINS, BUCKETS, META, REACH, Confidence, _inputs, calibrate, co_train, confidence, fit, fit_linear,
                                 metadata_features, op8_quality, score_quality, text_features)

SF1 = "/root/testdata/sf0.1"


def test_whole_table_separates_good_from_bad(spark):
    got = {r.doc_id: r for r in op8_quality(spark, SF1).collect()}
    assert len(got) == spark.read.parquet(f"{SF1}/documents.parquet").count()
    rows = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{SF1}/labels.parquet").collect() if r.doc_id in got]
    good, bad = [g for g, y in rows if y], [g for g, y in rows if not y]
    assert np.mean([g.kept for g in good]) > 0.98
    assert np.mean([not g.kept for g in bad]) > 0.9
    for name in ("text_score", "metadata_score", "score"):
        n = np.array([g[name] for g in bad])
        assert np.mean([(n < g[name]).mean() for g in good]) > 0.97


def test_views_teach_each_other():
    """Few labels and two noisy, independent views: the pool makes both better."""
    rng = np.random.default_rng(3)
    n = 4000
    y = (rng.random(n) < 0.6).astype(np.int64)
    views = [rng.standard_normal((n, 40)) + 0.4 * np.outer(2 * y - 1, rng.standard_normal(40) * (np.arange(40) < 12)) for _ in range(2)]
    known = np.full(n, -1)
    known[:30] = y[:30]
    held = np.zeros(n, bool)
    held[30:430] = True
    known[30:430] = y[30:430]

    def accuracy(rounds, **options):
        m = co_train(*views, known, held, rounds=rounds, **options)
        return np.array([np.mean((s >= 0.5) == y[430:]) for s in m.scores(views[0][430:], views[1][430:])])

    alone = accuracy(0)
    assert (accuracy(4) > alone + 0.01).all() and (accuracy(4, trust=0.5) > alone + 0.03).all()


def test_confidence_over_tasks_is_that_of_all_rows(spark):
    """What tasks add up against a plain loop over all documents, the sample left out."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = docs.where("doc_id < 200").collect()
    x = np.array([text_features(r.text or "") for r in rows])
    m = np.array([metadata_features(r.text or "", r.lang, r.source) for r in rows])
    y = np.array([r.doc_id % 2 for r in rows], float)
    models = [fit_linear(x, y), fit_linear(m, y)]
    some = {r.doc_id for r in rows if r.doc_id % 5 == 0}
    got = confidence(_inputs(docs.where("doc_id < 200")).repartition(7), models, some)
    n, sums = [np.zeros(BINS), np.zeros(BINS)], [np.zeros((BINS, META)), np.zeros((BINS, BUCKETS))]
    for r, a, b in zip(rows, x, m):
        if r.doc_id not in some:
            for k, (own, other) in enumerate(((a, b), (b, a))):
                at = min(BINS - 1, max(0, int((models[k].logit(own[None])[0] / REACH + 1) * BINS / 2)))
                n[k][at] += 1
                sums[k][at] += other
    assert sum(n[0]) == 160
    for k in range(2):  # a logit on a bin's border may fall to either side
        assert np.abs(got.n[k] - n[k]).sum() <= 2 and np.abs(got.sums[k].sum(axis=0) - sums[k].sum(axis=0)).max() < 1e-2


def test_lessons_take_the_most_confident_share():
    n = np.zeros(BINS)
    n[[0, 1, BINS - 2, BINS - 1, BINS // 2]] = 10, 5, 8, 2, 75
    c = Confidence([n, n], [np.arange(BINS)[:, None] * n[:, None], np.zeros((BINS, 3))])
    points, labels, counts = c.lessons(0, 0.1, 0.6, 0.9)
    assert points[:, 0].tolist() == [BINS - 1, BINS - 2, 0] and labels.tolist() == [1, 1, 0] and np.allclose(counts, [2, 4, 4])
    assert len(c.lessons(0, 1.0, 0.5, 0.9)[0]) == 4  # the unsure bin is never taught


def test_calibration_matches_frequencies():
    rng = np.random.default_rng(1)
    x = rng.standard_normal(20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    a, b = calibrate(x[:, None], y)
    assert abs(a - 2) < 0.15 and abs(b + 1) < 0.1


def test_features_read_whole_texts():
    base = "ab cd " * 100_000
    assert not np.allclose(text_features(base), text_features(base + "###$$$|||" * 2000))
    assert text_features("").sum() == 0 and metadata_features("", None, None).shape == (META,)
    joined = "x" * ((1 << 18) + 5)
    assert abs((text_features(joined) ** 2).sum() - 1) < 1e-4


def test_edges(spark):
    model = fit(spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet"))
    rows = score_quality(edge(spark), model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    same(score_quality(wide(spark), model), score_quality(edge(spark), model))
    assert score_quality(empty(spark), model).count() == 0
    for docs, lab in ((empty(spark), labels(spark)), (edge(spark), labels(spark)), (edge(spark), labels(spark, [(1, 1, 0), (1, None, 0)]))):
        m = fit(docs, lab)
        assert all(r.kept for r in score_quality(edge(spark), m).collect())
    random.seed(0)
