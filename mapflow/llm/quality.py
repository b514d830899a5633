"""Quality classifier by co-training of a text view and a page-metadata view.

The text view sees the document's content as hashed byte n-grams; the metadata view sees
what a crawl record tells beside it: language, source, length, lines and the shares of
kinds of characters.  Each is a logistic regression.  Starting from the labelled sample,
the views teach each other.  In every round both score all documents outside the sample; the most
confident of a view, a share that grows by rounds and is split in the labelled classes' proportion, join what the other
learns from, with the first view's guess as their label.  In the end each view's output is calibrated on labelled documents
kept out of all fits, and a logistic regression of the two calibrated outputs on the same
documents gives the combined score for all documents.

A round is one pass over all texts: a task counts its documents by bins of either view's score and adds
up the other view's features in each bin.  The sums over all tasks are what the views exchange: a bin enters the other
view's fit as one point, the mean of its documents, weighing as many as it holds (all of them
together ``trust`` times as much as the labelled ones).
So nothing is capped, and what tasks send and the driver holds has a fixed size.

The cut is the highest score, up to one half, below which at most ``lose`` of the good
calibration documents fall.

Sampling bound: ``sample_docs`` labelled documents (lowest
hashes of their ids), whose feature vectors reach the driver.  The exchange and scoring cover all documents.

Null and empty texts: scored by an all-zero text view and their metadata.  Null language
or source: a value of its own.  Null ``doc_id``: scored, never trained on.  Repeated
labels: good if all say so.  Repeated rows are scored each.  Ties of confidence share a bin.  Further columns are
not read and never clash.  Empty tables: no rows, or a
model that gives every document the base rate and keeps it.  Very long texts are read
whole, in pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table

BUCKETS = 2048
HASHED = 16
_LAYOUT = 15
META = _LAYOUT + 2 * HASHED
#: Bins of a view's logit between -REACH and REACH.
BINS, REACH = 48, 9.0
SCORES = "doc_id long, text_score double, metadata_score double, score double, kept boolean"


def text_features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte 1-, 2-, 3- and 4-grams."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(BUCKETS, np.float64)
    step = 1 << 18
    for at in range(0, len(raw), step):
        part = raw[at:at + step + 3].astype(np.uint32)
        h = np.zeros(len(part), np.uint32)
        for n in range(1, 5):
            if len(part) < n:
                break
            h = h[:len(part) - n + 1] * np.uint32(16777619) + part[n - 1:] + np.uint32(1)
            out += np.bincount(((h[:step] * np.uint32(2654435761)) >> np.uint32(18)) % BUCKETS, minlength=BUCKETS)
    total = out.sum()
    return np.sqrt(out / total).astype(np.float32) if total else out.astype(np.float32)


_KIND = np.full(256, 7, np.int64)  # other bytes
for _b in range(128):
    _c = chr(_b)
    _KIND[_b] = 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c == " " else 4 if _c == "\n" \
        else 5 if _c in ".,;:'\"()-" else 6


def metadata_features(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Length, lines, shares of kinds of characters, word statistics; language and source, hashed."""
    data = text.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, np.uint8)
    words, n = data.split(), max(1, len(raw))
    lines = data.split(b"\n")
    out = np.zeros(META, np.float32)
    out[:8] = np.bincount(_KIND[raw], minlength=8) / n if len(raw) else 0
    out[8:_LAYOUT] = (np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(lines)), np.log1p(len(raw) / len(lines)),
                      len(raw) / max(1, len(words)) / 10, len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines))
    out[_LAYOUT + zlib.crc32(f"l:{lang}".encode()) % HASHED] = 1
    out[_LAYOUT + HASHED + zlib.crc32(f"s:{source}".encode("utf-8", "surrogatepass")) % HASHED] = 1
    return out


@dataclass
class Linear:
    """Logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weight + self.bias


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 150, count: np.ndarray | None = None) -> Linear:
    """Accelerated gradient descent; ``count``: how much a row weighs; classes weigh the same in total."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = ((x - mean) / scale).astype(np.float32)
    weight = np.where(y == 1, 0.5 / max(1e-9, y.mean()), 0.5 / max(1e-9, 1 - y.mean())) / len(y)
    if count is not None:
        weight = np.where(y == 1, 0.5 / max(1e-9, count[y == 1].sum()), 0.5 / max(1e-9, count[y == 0].sum())) * count
    weight, y = weight.astype(np.float32), y.astype(np.float32)
    w, b = np.zeros(z.shape[1], np.float32), 0.0
    look, look_b, t = w.copy(), b, 1.0
    curve = 0.25 * float((weight * (z ** 2).sum(axis=1)).sum()) + ridge / len(y)
    rate = 1.0 / max(1e-6, min(curve, 0.25 * _top(z, weight) + ridge / len(y) + 0.25))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ look + look_b, -30, 30)))
        g = weight * (p - y)
        new, new_b = (look - rate * (z.T @ g + ridge / len(y) * look)).astype(np.float32), look_b - rate * float(g.sum())
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look, look_b = new + np.float32((old - 1) / t) * (new - w), new_b + (old - 1) / t * (new_b - b)
        w, b = new, new_b
    return Linear(mean, scale, w, float(b))


def _top(z: np.ndarray, weight: np.ndarray) -> float:
    """Largest eigenvalue of the weighted second moments, by a few power steps."""
    v = np.full(z.shape[1], 1 / np.sqrt(z.shape[1]), np.float32)
    value = 1.0
    for _ in range(12):
        u = z.T @ (weight * (z @ v))
        value = float(np.linalg.norm(u))
        v = (u / max(value, 1e-12)).astype(np.float32)
    return 1.3 * value


def calibrate(logits: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias of a logistic regression on a few logits, by Newton steps with a light ridge."""
    x = np.column_stack([logits, np.ones(len(y))])
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        move = np.clip(np.linalg.solve(hess, grad), -3, 3)
        beta -= move
        if np.abs(move).max() < 1e-9:
            break
    return beta


@dataclass
class QualityModel:
    text: Linear | None
    meta: Linear | None
    text_cal: np.ndarray
    meta_cal: np.ndarray
    both: np.ndarray
    cut: float

    def views(self, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated logits of both views."""
        if self.text is None:
            return np.full(len(x), self.text_cal[1]), np.full(len(x), self.meta_cal[1])
        return (self.text.logit(x) * self.text_cal[0] + self.text_cal[1], self.meta.logit(m) * self.meta_cal[0] + self.meta_cal[1])

    def scores(self, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.views(x, m)
        sig = lambda v: 1 / (1 + np.exp(-np.clip(v, -40, 40)))
        return sig(a), sig(b), sig(a * self.both[0] + b * self.both[1] + self.both[2])


@dataclass
class Confidence:
    """Documents by bins of a view's logit: by teaching view their number and the sums of the other view's features."""

    n: list[np.ndarray]
    sums: list[np.ndarray]

    @classmethod
    def of(cls, models: list[Linear], text: np.ndarray, meta: np.ndarray) -> "Confidence":
        n, sums = [], []
        for model, own, other in zip(models, (text, meta), (meta, text)):
            at = np.clip((model.logit(own) / REACH + 1) * BINS / 2, 0, BINS - 1).astype(np.int64)
            held = np.zeros((BINS, len(own)), np.float32)
            held[at, np.arange(len(own))] = 1
            n.append(held.sum(axis=1).astype(np.float64))
            sums.append((held @ other.astype(np.float32)).astype(np.float64))
        return cls(n, sums)

    def add(self, more: "Confidence") -> "Confidence":
        return Confidence([a + b for a, b in zip(self.n, more.n)], [a + b for a, b in zip(self.sums, more.sums)])

    def lessons(self, view: int, share: float, good: float, sure: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points, labels and weights that ``view`` teaches the other: bins from the most confident on, up to ``share`` of all documents."""
        p = 1 / (1 + np.exp(-((np.arange(BINS) + 0.5) * 2 / BINS - 1) * REACH))
        points, labels, counts = [], [], []
        for label, certainty, part in ((1.0, p, good), (0.0, 1 - p, 1 - good)):
            left = share * part * self.n[view].sum()
            for b in np.argsort(-certainty, kind="stable"):
                if certainty[b] < sure or left <= 0:
                    break
                if self.n[view][b]:
                    points.append(self.sums[view][b] / self.n[view][b])
                    labels.append(label)
                    counts.append(min(left, self.n[view][b]))  # a bin that passes the share counts in part
                    left -= counts[-1]
        return np.array(points).reshape(len(points), -1), np.array(labels), np.array(counts)


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, rounds: int = 3, grow: float = 0.1,
             sure: float = 0.9, lose: float = 0.01, trust: float = 0.1, pool: Callable[[list[Linear]], Confidence] | None = None) -> QualityModel:
    """``y``: 1 good, 0 bad, -1 unlabelled; ``held``: labelled documents kept for calibration.

    ``pool``: both views' confidence on the unlabelled documents, if these are not among the rows given.
    """
    known = (y >= 0) & ~held
    if not known.any() or len(set(y[known].tolist())) < 2:
        base = float(np.clip(y[y >= 0].mean() if (y >= 0).any() else 1.0, 1e-6, 1 - 1e-6))
        at = np.array([0.0, np.log(base / (1 - base))])
        return QualityModel(None, None, at, at, np.array([0.5, 0.5, 0.0]), 0.0)
    views = (text, meta)
    models = [fit_linear(v[known], y[known].astype(np.float64)) for v in views]
    good = float(y[known].mean())
    for r in range(1, rounds + 1):
        seen = pool(models) if pool else Confidence.of(models, text[y < 0], meta[y < 0])
        new = []
        for k in range(2):  # what view 1 - k teaches view k
            points, labels, counts = seen.lessons(1 - k, min(1.0, grow * r), good, sure)
            if not len(points):
                new.append(models[k])
                continue
            weight = np.concatenate([np.ones(known.sum()), counts * trust * known.sum() / counts.sum()])
            new.append(fit_linear(np.concatenate([views[k][known], points]).astype(np.float32), np.concatenate([y[known], labels]), count=weight))
        models = new
    cal = np.flatnonzero(held & (y >= 0)) if len(set(y[held & (y >= 0)].tolist())) == 2 else np.flatnonzero(known)
    logits = [models[k].logit(views[k][cal]) for k in range(2)]
    out = QualityModel(models[0], models[1], calibrate(logits[0][:, None], y[cal]), calibrate(logits[1][:, None], y[cal]), np.zeros(3), 0.5)
    out.both = calibrate(np.column_stack(out.views(text[cal], meta[cal])), y[cal])
    mine = np.sort(out.scores(text[cal], meta[cal])[2][y[cal] == 1])
    out.cut = float(min(0.5, mine[int(lose * len(mine))]))
    return out


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
                       docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source"))


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    rows = list(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))))
    return (np.array([text_features(t) for t, _, _ in rows]).reshape(-1, BUCKETS),
            np.array([metadata_features(t, a, b) for t, a, b in rows]).reshape(-1, META))


def confidence(inputs: DataFrame, models: list[Linear], sample: set[int]) -> Confidence:
    """Both views' confidence on all documents whose id is not in ``sample``."""
    shared = inputs.sparkSession.sparkContext.broadcast((models, sample))  # two weight vectors, and ids within the sample's bound

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, sample = shared.value
        total = None
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                b = b.filter(pa.array([i not in sample for i in b.column(0).to_pylist()], pa.bool_()))
                if b.num_rows:
                    one = Confidence.of(models, *_features(b))
                    total = total.add(one) if total else one
        if total:
            rows = [(v, i, total.n[v][i], total.sums[v][i].astype("<f4").tobytes()) for v in range(2) for i in np.flatnonzero(total.n[v])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["view", "bin", "n", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, sums = None, 0.0, None
        for b in batches:
            for view, i, k, raw in zip(*(b.column(c).to_pylist() for c in range(4))):
                if key is not None and key != (view, i):
                    yield one(key, n, sums)
                if key != (view, i):
                    key, n, sums = (view, i), 0.0, 0.0
                n, sums = n + k, sums + np.frombuffer(raw, "<f4").astype("<f8")
        if key is not None:
            yield one(key, n, sums)

    def one(key: tuple[int, int], n: float, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([n]), pa.array([sums.tobytes()])],
                                          ["view", "bin", "n", "sums"])

    shape = "view long, bin long, n double, sums binary"
    rows = map_arrow(map_arrow(inputs, count, shape).repartition("view", "bin").sortWithinPartitions("view", "bin"), add, shape).collect()
    out = Confidence([np.zeros(BINS), np.zeros(BINS)], [np.zeros((BINS, META)), np.zeros((BINS, BUCKETS))])
    for r in rows:  # one per view and bin
        out.n[r["view"]][r["bin"]] = r["n"]
        out.sums[r["view"]][r["bin"]] = np.frombuffer(r["sums"], "<f8")
    return out


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = 3000, **options) -> QualityModel:
    """Model from a bounded labelled sample and all other documents; every fourth labelled document (by hash) calibrates only."""
    marked = (labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min("quality").cast("int").alias("y")))
    inputs = _inputs(docs)
    sample = marked.orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(sample_docs)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, m = _features(b)
            packed = [np.concatenate([u, v]).astype("<f2").tobytes() for u, v in zip(x, m)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(4), pa.array(packed, pa.binary())], ["doc_id", "y", "x"])

    joined = inputs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "lang", "source", "y")
    rows = (map_arrow(joined, pick, "doc_id long, y int, x binary").groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r"))
            .select("doc_id", "r.*").orderBy("doc_id").toArrow())
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), "<f2").astype(np.float32).reshape(-1, BUCKETS + META)
    ids = rows.column("doc_id").to_pylist()
    held = np.array([((i * 0x9E3779B97F4A7C15) & (1 << 64) - 1) >> 33 & 3 == 0 for i in ids], bool)
    return co_train(x[:, :BUCKETS], x[:, BUCKETS:], np.array(rows.column("y").to_pylist(), np.int64), held,
                    pool=lambda models: confidence(inputs, models, set(ids)), **options)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Both views' probabilities, the combined ``score`` and ``kept`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two weight vectors of fixed length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                a, m, both = shared.value.scores(*_features(b))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(a, pa.float64()), pa.array(m, pa.float64()), pa.array(both, pa.float64()),
                     pa.array(both >= shared.value.cut, pa.bool_())], ["doc_id", "text_score", "metadata_score", "score", "kept"])

    return map_arrow(_inputs(docs), run, SCORES)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit(docs, table(spark, sf_dir, "labels")))
