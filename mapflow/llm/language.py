"""Language identification with error-correcting output codes.

Every language learnt has a codeword of +1 and -1 (``codewords``): up to seven
languages all ways of cutting them in two, beyond that drawn columns, of which the
draw with the largest least distance is taken.  One binary classifier per bit
tells the languages marked +1 from those marked -1 by hashed byte 3-grams and
4-grams of the lower-cased letters: the weight of an n-gram is the log ratio of
its share on either side, with each language counting alike.  A text's margin for a
bit is the mean weight times the root of its number of n-grams.  Margins are put
on a common scale by a logistic fit per bit, on labelled documents that were not
counted.

Decoding is loss-weighted: a language's loss is the sum over bits of
``log(1 + exp(-codeword * margin))``, each bit weighing as much as it was better
than chance on the calibrating documents.  The least loss wins; ``score`` is its share of
``exp(-loss)`` over all languages.  ``ambiguous`` flags texts whose second
language is less than ``GAP`` behind.

Three passes in Arrow batches.  Counting: every labelled document that may be learnt from, each
with the weight of 1,000 n-grams at most; a task sends one vector per language, and
vectors are added in a stream sorted by language and bucket range.  Calibration:
histograms of margins.  Scoring: whole texts, cut into overlapping pieces in memory.  The
driver holds one vector of 65,536 numbers per language, at any input size.

Null texts and texts without a letter: ``und``, score 0, not ambiguous.  Nothing to learn from (no
label, or no letter in any labelled text): ``und`` for all.  One language only: it, for every text with a
letter.  Ties of loss: the first language by code point.  Null ``doc_id``: kept, held
out as the empty text's remainder says.  Repeated rows: returned and learnt from each.  Empty
table: no rows.  Further columns of the input are not read and never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table
from .toxicity import held_out

BUCKETS = 1 << 16
#: Buckets of one row of counts, when tasks' vectors are added.
SLICE = 1 << 10
#: Bytes of text whose n-grams are looked up at a time.
PIECE = 1 << 19
#: Loss by which the second language has to be behind, else a text is flagged.
GAP = 1.0
#: Margins are counted in so many bins between -RANGE and RANGE.
BINS, RANGE = 400, 40.0

_PLAIN = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def codewords(k: int, seed: int = 11) -> np.ndarray:
    """``k`` rows of +1 and -1, pairwise different, and no column of one sign alone."""
    if k < 2:
        return np.ones((k, 1))
    if k <= 7:  # the first language is always +1, so no column is another's negative
        cut = [[1 if i == 0 or i in plus else -1 for i in range(k)]
               for size in range(k - 1) for plus in combinations(range(1, k), size)]
        return np.array(cut, float).T
    rng, best, least = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(k)))
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (k, bits))
        m = m[:, np.abs(m.sum(axis=0)) < k]
        apart = (m.shape[1] - m @ m.T) / 2
        np.fill_diagonal(apart, bits)
        if apart.min() > least:
            best, least = m, apart.min()
    return best


def plain(text: str | None) -> bytes:
    """Lower-cased text as UTF-8 with one space for every run of other ASCII, long enough for a 4-gram; empty if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return b"  " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()) + b" "


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of the 3-grams and 4-grams of the texts, some texts or a part of one at a time.

    Yields (text of each stretch, first position of each stretch, two rows of buckets); a
    position where a text ends gets the bucket ``BUCKETS``, which weighs nothing.
    """
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, t in enumerate(texts):
        # Cut with an overlap of three bytes: every 4-gram is in one piece, and the 3-gram at the
        # overlap's last position is counted there only, as the last three positions of a piece are void.
        for at in range(0, max(len(t) - 3, 0), PIECE):
            part = t[at:at + PIECE + 3]
            if size and size + len(part) > PIECE:
                yield _look_up(held)
                held, size = [], 0
            held.append((i, part))
            size += len(part)
    if held:
        yield _look_up(held)


def _look_up(held: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = np.frombuffer(b"".join(t for _, t in held) + b"   ", np.uint8).astype(np.uint32)
    three = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16
    four = three | b[3:] << 24
    found = np.stack([(three * np.uint32(0x9E3779B1)) >> 16, (four * np.uint32(0x85EBCA6B)) >> 16])
    ends = np.cumsum([len(t) for _, t in held])
    found[:, (ends[:, None] - np.arange(1, 4)).ravel()] = BUCKETS
    return np.array([i for i, _ in held]), np.concatenate([[0], ends[:-1]]), found


def gram_count(text: bytes) -> int:
    return 2 * max(len(text) - 3, 0)


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray    # languages x bits
    weights: np.ndarray  # (BUCKETS + 1) x bits
    slope: np.ndarray
    shift: np.ndarray
    trust: np.ndarray    # weight of each bit in a loss

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """texts x bits: the mean weight of a text's n-grams times the root of their number."""
        total = np.zeros((len(texts), self.weights.shape[1]))
        for who, starts, found in pieces(texts):
            for row in found:
                np.add.at(total, who, np.add.reduceat(self.weights[row], starts, axis=0, dtype=np.float64))
        n = np.array([gram_count(t) for t in texts], float)
        return total / np.sqrt(np.maximum(n, 1))[:, None]

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """texts x languages."""
        z = margins * self.slope + self.shift
        return np.stack([(np.logaddexp(0, -z * code) * self.trust).sum(axis=1) for code in self.codes], axis=1)

    def decode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest codeword, score and ambiguity of each text."""
        if len(self.languages) == 1:
            return np.zeros(len(texts), int), np.ones(len(texts)), np.zeros(len(texts), bool)
        loss = self.losses(self.margins(texts))
        order = np.sort(loss, axis=1)
        share = 1 / np.exp(order[:, :1] - loss).sum(axis=1)
        return loss.argmin(axis=1), share, order[:, 1] - order[:, 0] < GAP


def learnable(docs: DataFrame) -> DataFrame:
    """``lang``, ``text`` and whether the row calibrates, of the labelled rows that may be learnt from."""
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return (rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
            .select("lang", "text", (F.crc32("text") % 6 == 1).alias("calibrates")))


def gram_counts(labelled: DataFrame, most: int = 1000) -> dict[str, np.ndarray]:
    """For each language the sum of its documents' n-gram shares, each weighing ``most`` n-grams at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for big in batches:
            for b in (big.slice(at, 512) for at in range(0, big.num_rows, 512)):
                langs, texts = b.column(0).to_pylist(), [plain(t) for t in b.column(1).to_pylist()]
                for who, starts, found in pieces(texts):
                    spans = np.diff([*starts, found.shape[1]])
                    for lang in {langs[i] for i in who}:
                        w = np.array([min(1, most / gram_count(texts[i])) if langs[i] == lang else 0.0 for i in who])
                        each = np.repeat(w, spans)
                        add = sum(np.bincount(row, each, BUCKETS + 1)[:BUCKETS] for row in found)
                        sums[lang] = sums[lang] + add if lang in sums else add
        yield from vectors(sums)

    def vectors(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, v in sums.items():
            n = BUCKETS // SLICE
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n), pa.array(range(n), pa.int32()), pa.array([p.astype("<f8").tobytes() for p in v.reshape(n, SLICE)])],
                ["lang", "part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for b in batches:
            for lang, part, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (lang, part) == key:
                    total = total + np.frombuffer(raw, "<f8")
                else:
                    if key:
                        yield one(key, total)
                    key, total = (lang, part), np.frombuffer(raw, "<f8")
        if key:
            yield one(key, total)

    def one(key: tuple[str, int], total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([total.tobytes()])],
                                          ["lang", "part", "sums"])

    shape = "lang string, part int, sums binary"
    per_task = map_arrow(labelled.select("lang", "text"), count, shape)
    summed = map_arrow(per_task.repartition("lang", "part").sortWithinPartitions("lang", "part"), add, shape)
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():  # one vector per language
        out.setdefault(r["lang"], np.zeros(BUCKETS))[r["part"] * SLICE:(r["part"] + 1) * SLICE] = np.frombuffer(r["sums"], "<f8")
    return {lang: v for lang, v in sorted(out.items()) if v.sum() > 0}


def bit_weights(counts: np.ndarray, codes: np.ndarray, smooth: float = 0.5) -> np.ndarray:
    """(BUCKETS + 1) x bits: log ratios of an n-gram's share among the languages of either sign."""
    share = (counts + smooth) / (counts + smooth).sum(axis=1, keepdims=True)
    sides = [np.stack([share[c == sign].mean(axis=0) for c in codes.T], axis=1) for sign in (1, -1)]
    return np.concatenate([np.log(sides[0] / sides[1]), np.zeros((1, codes.shape[1]))]).astype(np.float32)


def logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and shift that fit the weights ``good`` (sign +1) and ``bad`` at ``x``, by Newton's method; sides weigh alike."""
    if not good.sum() or not bad.sum():
        return 1.0, 0.0
    good, bad = good / good.sum(), bad / bad.sum()
    a, c = 1.0, 0.0
    design = np.stack([x, np.ones_like(x)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + c, -30, 30)))
        slope = design @ ((good + bad) * p - good) + ridge * np.array([a, c])
        curve = (design * ((good + bad) * p * (1 - p))) @ design.T + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        a, c = a - step[0], c - step[1]
    return max(a, 1e-3), c


def fit(docs: DataFrame) -> LanguageModel | None:
    """Classifiers and calibration from all documents that may be learnt from; None if there are none."""
    labelled = learnable(docs)
    counts = gram_counts(labelled.where(~F.col("calibrates"))) or gram_counts(labelled)
    if not counts:
        return None
    languages = list(counts)
    codes = codewords(len(languages))
    bits = codes.shape[1]
    plain_fit = LanguageModel(languages, codes, bit_weights(np.stack(list(counts.values())), codes) if len(languages) > 1
                              else np.zeros((BUCKETS + 1, 1), np.float32), np.ones(bits), np.zeros(bits), np.ones(bits))
    if len(languages) == 1:
        return plain_fit
    shared = docs.sparkSession.sparkContext.broadcast(plain_fit)  # BUCKETS numbers per bit

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = {lang: i for i, lang in enumerate(model.languages)}
        seen = np.zeros((len(number), bits, BINS + 1), np.int64)
        for big in batches:
            for b in (big.slice(at, 512) for at in range(0, big.num_rows, 512)):
                rows = [(number[lang], t) for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                        if lang in number and (t := plain(text))]
                if rows:
                    at = np.clip(np.rint((model.margins([t for _, t in rows]) / RANGE + 1) * BINS / 2), 0, BINS).astype(int)
                    np.add.at(seen, (np.array([i for i, _ in rows])[:, None], np.arange(bits)[None, :], at), 1)
        lang, bit, place = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (lang, bit, place, seen[lang, bit, place])],
                                         ["lang", "bit", "place", "n"])

    histogram = np.zeros((len(languages), bits, BINS + 1))
    for r in (map_arrow(labelled.where("calibrates").select("lang", "text"), margins, "lang long, bit long, place long, n long")
              .groupBy("lang", "bit", "place").agg(F.sum("n").alias("n")).collect()):  # languages x bits x bins at most
        histogram[r["lang"], r["bit"], r["place"]] = r["n"]
    # Every language weighs alike on its side of a bit.
    share = histogram / np.maximum(histogram.sum(axis=2, keepdims=True), 1)
    x = (np.arange(BINS + 1) * 2 / BINS - 1) * RANGE
    slope, shift, trust = np.ones(bits), np.zeros(bits), np.ones(bits)
    for j in range(bits):
        good, bad = (share[codes[:, j] == sign, j].sum(axis=0) for sign in (1, -1))
        slope[j], shift[j] = logistic(x, good, bad)
        if good.sum() and bad.sum():
            up = slope[j] * x + shift[j] > 0
            trust[j] = max(good[up].sum() / good.sum() + bad[~up].sum() / bad.sum() - 1, 0.01)
    # Bits are not independent: losses are on the scale of one bit, not of all in which two codewords differ.
    apart = (bits - codes @ codes.T)[np.triu_indices(len(languages), 1)].min() / 2
    return LanguageModel(languages, codes, plain_fit.weights, slope, shift, trust * bits / trust.sum() / apart)


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``ambiguous`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for big in batches:
            for b in (big.slice(at, 512) for at in range(0, big.num_rows, 512)):
                texts = [plain(t) for t in b.column(2).to_pylist()]
                known = [i for i, t in enumerate(texts) if t] if m else []
                lang, score, close = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                if known:
                    best, score[known], close[known] = m.decode([texts[i] for i in known])
                    for i, k in zip(known, best):
                        lang[i] = m.languages[k]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(close)],
                                                 ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, SCHEMA)


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
