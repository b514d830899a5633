"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word's vector is the mean of the embeddings of its character n-grams (hashed into a
fixed number of buckets), a passage's the mean over its words, and a linear softmax on
it gives the two classes; embeddings and softmax are trained together.  Training starts
from whole documents and goes on with each document's most toxic passage of ``WINDOW``
words under the model so far, so that a few words in a long text count.  A misspelling
shares most n-grams with its word and so most of its vector.

Two classes need only the difference of the softmax's rows, so a trained model is one
number per bucket, and a document's raw score is the highest window mean of its words'
numbers.  Logistic calibration on labelled documents kept out of the fit turns it into
a probability.

The fit uses a sample of labelled documents, bounded twice: at most ``sample_docs`` of them
(the lowest hashes of their ids) and, in that order, only as long as their words add up to ``sample_bytes``;
a text of over a 64th of these bytes is scored like any other but not learnt from.  Only the
sample's ids, labels and words reach the driver, so its memory is bounded however long texts are.

Null and empty texts get the score of a text without toxic words.  Null ``doc_id``:
scored, held out by the hash of the empty text, never trained on.  Repeated labels:
toxic if any says so.  Repeated rows are scored each; rows that share an id teach once, with
the least text.  Ties: ids of one hash are sampled by id; of equally toxic passages the first counts.
Further columns of either table are not read.  Empty tables: no rows, or a model
that knows nothing and gives the base rate.  Very long texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapflow.session import scratch_dir
from mapflow.sources.store import remove_path

from .common import doc_texts, map_arrow, stored, table

WINDOW = 10
BUCKETS = 1 << 18
DIM = 8
GRAMS = (3, 4, 5, 6)
SCORES = "doc_id long, held_out boolean, score double"
#: At and above this score a document is predicted toxic.
CUT = 0.3

# Lower case, digits read as the letters they stand for in disguised words, all other ASCII marks as spaces.
_PLAIN = bytearray(range(256))
for _b in range(128):
    _PLAIN[_b] = ord(chr(_b).lower()) if chr(_b).isalpha() else 32
for _a, _b in zip(b"0134578@", b"oieastba"):
    _PLAIN[_a] = _b
_PLAIN = bytes(_PLAIN)


def plain_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def grams(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the n-grams of all ``<word>``, end to end, and where each word's begin.

    Every word has at least one: the whole of it, with its brackets.
    """
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    raw = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    first = np.cumsum(lens) - lens
    owner = np.repeat(np.arange(len(words)), lens)
    left = np.repeat(first + lens, lens) - np.arange(len(raw))  # bytes from here to the end of the word
    owners, ids = [], []
    mix = np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(len(raw), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(raw) < n:
            break
        h = h[:len(raw) - n + 1] * np.uint64(0x100000001B3) + raw[n - 1:] + np.uint64(1)
        if n in GRAMS:
            ok = left[:len(h)] >= n
            x = (h[ok] + np.uint64(n)) * mix
            ids.append((x >> np.uint64(40)) % np.uint64(buckets))
            owners.append(owner[:len(h)][ok])
    # The word itself: a digest of all its bytes.
    power = np.uint64(0x100000001B3) ** np.arange(max(lens, default=0), dtype=np.uint64)
    whole = np.add.reduceat(raw * power[np.arange(len(raw)) - np.repeat(first, lens)], first) if len(words) else raw
    ids.append(((whole * mix) >> np.uint64(40)) % np.uint64(buckets))
    owners.append(np.arange(len(words)))
    who = np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    counts = np.bincount(who, minlength=len(words))
    return np.concatenate(ids)[order].astype(np.int32), np.cumsum(counts) - counts


def grams_of_many(words: list[bytes], buckets: int, chunk: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """``grams`` of a long list, in chunks: the intermediate arrays are many times the result."""
    parts = [grams(words[k:k + chunk], buckets) for k in range(0, len(words), chunk)]
    shift = np.cumsum([0, *(len(i) for i, _ in parts)])
    return (np.concatenate([i for i, _ in parts]), np.concatenate([s + d for (_, s), d in zip(parts, shift)]))


def _means(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean of each stretch of rows; no stretch is empty."""
    lens = np.diff(np.append(starts, len(values)))
    sums = np.add.reduceat(values, starts, axis=0)
    return sums / (lens if values.ndim == 1 else lens[:, None])


@dataclass
class ToxicityModel:
    """``bucket``: what a bucket adds to class 1 against class 0; ``slope``, ``shift``: calibration."""

    bucket: np.ndarray
    slope: float
    shift: float
    window: int = WINDOW

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        ids, starts = grams_of_many(words, len(self.bucket))
        return _means(self.bucket[ids].astype(np.float64), starts)

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * raw + self.shift, -40, 40)))


def best_window(scores: np.ndarray, window: int) -> tuple[float, int]:
    """Highest mean over ``window`` words in a row (over all words of a shorter text, at least four) and its place."""
    n = len(scores)
    if n == 0:
        return 0.0, 0
    if n <= window:
        return float(scores.sum() / max(n, 4)), 0
    total = np.concatenate([[0.0], np.cumsum(scores)])
    sums = total[window:] - total[:-window]
    at = int(sums.argmax())
    return float(sums[at] / window), at


class _Trainer:
    """Embeddings and softmax rows with Adam; passages are arrays of word numbers."""

    def __init__(self, words: list[bytes], buckets: int, dim: int, seed: int):
        rng = np.random.default_rng(seed)
        self.ids, self.starts = grams_of_many(words, buckets)
        self.words, self.buckets = len(words), buckets
        self.used = np.zeros(buckets, bool)
        self.used[self.ids] = True
        self.params = [(rng.standard_normal((buckets, dim)) * 0.05).astype(np.float32),
                       (rng.standard_normal((dim, 2)) * 0.5).astype(np.float32), np.zeros(2, np.float32)]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.params]
        self.t = 0
        self.lens = np.diff(np.append(self.starts, len(self.ids)))

    def word_numbers(self) -> np.ndarray:
        e, w, _ = self.params
        return _means((e @ (w[:, 1] - w[:, 0]))[self.ids], self.starts)

    def step(self, passages: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, rate: float, decay: float) -> None:
        e, w, b = self.params
        flat = np.concatenate(passages)
        sizes = np.fromiter(map(len, passages), np.int64, len(passages))
        begins = np.cumsum(sizes) - sizes
        here, back = np.unique(flat, return_inverse=True)  # words of this batch
        lens = self.lens[here]
        first = np.cumsum(lens) - lens
        ids = self.ids[np.repeat(self.starts[here] - first, lens) + np.arange(lens.sum())]
        vectors = np.add.reduceat(e[ids], first, axis=0) / lens[:, None]
        hidden = np.add.reduceat(vectors[back], begins, axis=0) / sizes[:, None]
        logits = hidden @ w + b
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        g = p - np.stack([1 - toxic, toxic], axis=1)
        g *= (weight / weight.sum())[:, None]
        back_hidden = np.repeat(g @ w.T / sizes[:, None], sizes, axis=0)
        to_words = _scatter(back, back_hidden, len(here)) / lens[:, None]
        to_buckets = np.repeat(to_words, lens, axis=0)
        touched, where = np.unique(ids, return_inverse=True)
        ge = _scatter(where, to_buckets, len(touched)) + decay * e[touched]
        self.t += 1
        for k, (grad, rows) in enumerate(((ge, touched), (hidden.T @ g + decay * w, slice(None)), (g.sum(axis=0), slice(None)))):
            m, v = self.moments[k]
            m[rows] = 0.9 * m[rows] + 0.1 * grad
            v[rows] = 0.99 * v[rows] + 0.01 * grad * grad
            self.params[k][rows] -= (rate * (m[rows] / (1 - 0.9 ** self.t)) / (np.sqrt(v[rows] / (1 - 0.99 ** self.t)) + 1e-8)).astype(np.float32)


def _scatter(to: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(to, rows[:, k], n) for k in range(rows.shape[1])], axis=1)


def _calibrate(raw: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the raw score, by Newton steps with a light ridge."""
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    beta = np.array([1.0, np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - toxic) + np.array([0.001, 0.0]) * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.001, 1e-6])
        move = np.linalg.solve(hess, grad)
        beta -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def train(texts: Iterable[list[bytes]], toxic: list[int], calibration: list[bool], buckets: int = BUCKETS, dim: int = DIM,
          window: int = WINDOW, start_epochs: int = 12, rounds: int = 5, epochs: int = 6, least_steps: int = 60, batch: int = 256,
          seed: int = 5) -> ToxicityModel:
    """A model from documents as word lists; those marked ``calibration`` only place the probabilities.

    The start and each round go over their passages ``start_epochs`` or ``epochs`` times, and
    more often for few passages, until ``least_steps`` steps are made.
    """
    y, held = np.array(toxic, np.float64), np.array(calibration, bool)
    index: dict[bytes, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in t], np.int32) for t in texts]
    fit = [i for i in np.flatnonzero(~held) if len(docs[i])]
    if len(set(y[fit])) < 2:  # nothing to tell apart among texts that have words
        base = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        return ToxicityModel(np.zeros(buckets, np.float32), 0.0, float(np.log(base / (1 - base))), window)
    trainer, rng = _Trainer(list(index), buckets, dim, seed), np.random.default_rng(seed)
    share = max(1e-3, float(y[fit].mean()))
    weight = np.where(y == 1, min(1.0, 0.5 / share), 1.0)
    # Words that several documents share carry the start; the rest joins with the passages.
    seen = np.bincount(np.concatenate([np.unique(docs[i]) for i in fit]), minlength=len(index))
    bags = {i: d for i in fit if len(d := np.unique(docs[i])[seen[np.unique(docs[i])] >= 4])}
    times = lambda n, least: max(least, -(-least_steps * batch // max(n, batch)))
    for _ in range(times(len(bags), start_epochs)):
        order = rng.permutation(list(bags))
        for k in range(0, len(order), batch):
            part = order[k:k + batch]
            trainer.step([bags[i] for i in part], y[part], weight[part], 0.02, 1e-6)
    for _ in range(rounds):
        numbers = trainer.word_numbers()
        passages, marks, weights = [], [], []
        for i in fit:
            d = docs[i]
            _, at = best_window(numbers[d], window)
            passages.append(d[at:at + window])
            marks.append(y[i])
            weights.append(weight[i])
            if not y[i]:  # any other passage of a clean document is clean too
                at = int(rng.integers(0, max(1, len(d) - window + 1)))
                passages.append(d[at:at + window])
                marks.append(0.0)
                weights.append(0.3)
        marks, weights = np.array(marks), np.array(weights)
        for _ in range(times(len(passages), epochs)):
            order = rng.permutation(len(passages))
            for k in range(0, len(order), batch):
                part = order[k:k + batch]
                trainer.step([passages[j] for j in part], marks[part], weights[part], 0.01, 1e-6)
    e, w, _ = trainer.params
    bucket = np.where(trainer.used, e @ (w[:, 1] - w[:, 0]), 0).astype(np.float32)
    numbers = trainer.word_numbers()
    use = np.flatnonzero(held) if y[held].sum() > 0 else np.arange(len(y))
    raw = np.array([best_window(numbers[docs[i]], window)[0] for i in use])
    slope, shift = _calibrate(raw, y[use])
    return ToxicityModel(bucket, slope, shift, window)


def held_out() -> F.Column:
    """Documents whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def learnt_from(docs: DataFrame, labels: DataFrame, sample_docs: int = 6000, sample_bytes: int = 64 << 20) -> pa.Table:
    """The sample that a fit learns from, one row per document by id: ``doc_id``, its ``words``, space-joined, and ``toxic``."""
    spark = docs.sparkSession
    marked = (labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max("toxic").cast("int").alias("toxic")).where(~held_out()))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [b" ".join(plain_words(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(packed, pa.binary())], ["doc_id", "toxic", "words"])

    joined = doc_texts(docs).join(F.broadcast(sample), "doc_id").where(F.octet_length("text") <= sample_bytes // 64)
    # A repeated document counts once, so the sample's bounds hold for what is collected.
    packed = (map_arrow(joined.select("doc_id", "text", "toxic"), pick, "doc_id long, toxic int, words binary").groupBy("doc_id")
              .agg(F.min(F.struct("words", "toxic")).alias("r")).select("doc_id", "r.*"))
    path = scratch_dir(spark, "toxicity-sample")
    try:
        packed = stored(packed, "toxicity-sample", path)
        # One task adds up lengths: a number for each of at most ``sample_docs`` documents.
        upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
        within = (packed.select("doc_id", F.sum(F.octet_length("words").cast("long")).over(upto).alias("total"))
                  .where(F.col("total") <= sample_bytes).select("doc_id"))
        return packed.join(F.broadcast(within), "doc_id").orderBy("doc_id").toArrow()
    finally:
        remove_path(spark, path)


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = 6000, sample_bytes: int = 64 << 20, **options) -> ToxicityModel:
    """A model from labelled documents that are not held out (see ``learnt_from``); a quarter of them calibrates."""
    rows = learnt_from(docs, labels, sample_docs, sample_bytes)
    ids = rows.column("doc_id").to_pylist()
    return train((w.as_py().split() for w in rows.column("words")), rows.column("toxic").to_pylist(),
                 [hash_of(i) % 4 == 0 for i in ids], **options)


def hash_of(doc_id: int) -> int:
    return ((doc_id * 0x9E3779B97F4A7C15) & (1 << 64) - 1) >> 33


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``held_out`` and ``score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one float per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                texts = [plain_words(t) for t in b.column(1).to_pylist()]
                new = list({w for t in texts for w in t if w not in known})
                if len(known) > 500_000:  # bounded memory: start anew
                    known, new = {}, list({w for t in texts for w in t})
                known.update(zip(new, shared.value.word_scores(new).tolist()))
                raw = [best_window(np.fromiter(map(known.__getitem__, t), np.float64, len(t)), shared.value.window)[0] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(shared.value.probability(np.array(raw)), pa.float64())],
                    ["doc_id", "held_out", "score"])

    return map_arrow(doc_texts(docs).withColumn("held_out", held_out()), run, SCORES)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
