"""Secret scans: base patterns, and character Markov models that tell random strings from identifiers.

Two first-order models over ASCII characters: on the one side values that the base patterns
caught and seeded random strings, on the other ordinary tokens and seeded identifiers.  What
comes from the corpus is counted over all documents, inside the tasks, as tables of character
pairs of fixed size; only the seeded strings are samples, and they weigh at least as much as
what was counted.  A token's score is the log-likelihood ratio of the two per character, from
the start of the token on; the cut lies between a histogram of the scores of all long tokens
of the corpus and held-out seeded ones, and the same of caught values.  Tokens above it that
touch no base span are added as spans of kind ``markov``.  Two models of characters cannot tell a UUID from a key, so
UUIDs, groups of digits, times and data behind ``base64,`` are left out by their written form.

Null and empty texts have no spans; null ``doc_id`` is kept; repeated rows are
scanned each; an empty table gives no rows (the models then rest on the seeded
samples).  Very long texts are scanned whole.  Ties: spans at one place are in the order of
their kinds; a score equal to the cut is ordinary.  Further columns are kept by ``redact`` and not read by ``scan_secrets``.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_texts, map_arrow, ship_package, table

# The base patterns, in their listed order, and the least length of each.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "markov")

TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
#: Written forms that are public by what they are, however random their characters: UUIDs, groups of digits (versions, card
#: and phone numbers), dates with times.  They are no tokens for the cut and the spans, and UUIDs teach no model.
ORDINARY = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[vV]?[0-9]+(?:[-/_=+]+[0-9]+)*[-/_=+]*|"
                      r"[0-9]{4}[-/]?[0-9]{2}[-/]?[0-9]{2}[T_-][0-9_-]*(?:Z|[+-][0-9]+)?")
#: What encoded data, such as an image in a page, follows.
DATA = "base64,"
UUID_PART = re.compile(r"-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")
SPANS = ("doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string, "
         "found array<struct<kind:string,start:long,end:long,value_start:long,value_end:long>>")

#: Words that identifiers are made of, beside those of the documents.
PROGRAM_WORDS = tuple(
    "get set put add remove delete update insert create open close read write load save send receive start stop run init parse "
    "format print check test find search select sort filter map list array table index key value name type data file path text "
    "string number count size length width height time date user account order customer item price total config option param "
    "request response server client session message event handler error result status state buffer stream thread process "
    "queue stack node tree graph link page image color font view model control service manager factory builder helper util "
    "default current previous next first last min max sum average version release build module package class method function "
    "interface object instance field property attribute element content header footer title description comment".split())

_CODE = np.zeros(256, np.int64)
for _i, _c in enumerate(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"):
    _CODE[_c] = _i + 1
_STATES = 68  # 67 characters, and 0 for the start of a token


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, place of the kind, end, value start, value end) of the base patterns, in order of start and kind."""
    out = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST["assign"]:
            out.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST["access"]:
                out.append((m.start(), 1, m.end(), m.start(), m.end()))
    for m in HEX_RUN.finditer(text):  # a run that is long enough is the whole of a leftmost match
        out.append((m.start(), 2, m.end(), m.start(), m.end()))
    return sorted(out)


def transitions(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pair codes of all characters of all tokens (start to first, first to second, ...) and each token's first place."""
    raw = np.frombuffer("".join(tokens).encode("ascii"), np.uint8)
    now = _CODE[raw]
    lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
    first = np.cumsum(lens) - lens
    prev = np.concatenate([[0], now[:-1]]) if len(now) else now
    prev[first] = 0
    return prev * _STATES + now, first


@dataclass(frozen=True)
class MarkovModel:
    """``ratio``: log-likelihood ratio of every pair of characters, flat; ``cut``: a token that scores above it is a secret."""

    ratio: np.ndarray
    cut: float

    def scores(self, tokens: list[str]) -> np.ndarray:
        if not tokens:
            return np.zeros(0)
        pairs, first = transitions(tokens)
        return np.add.reduceat(self.ratio[pairs], first) / np.fromiter(map(len, tokens), np.int64, len(tokens))


def seeded_randoms(n: int, seed: int) -> list[str]:
    """Random strings over the alphabets that keys and tokens are written in."""
    rng = random.Random(seed)
    up, low, dig = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = [up + low + dig, up + low + dig + "+/", up + low + dig + "_-", up + "234567", "0123456789abcdef",
                 "0123456789ABCDEF", up + dig, low + dig]
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 64))) for _ in range(n)]


def identifiers(words: list[str], n: int, seed: int) -> list[str]:
    """Ordinary long names built from words: long words, snake_case, kebab-case, CONSTANTS, paths, camelCase, numbered."""
    rng = random.Random(seed)
    out = [w for w in words if len(w) >= 12]
    short = [w for w in words if 2 <= len(w) <= 12] or list(PROGRAM_WORDS)
    for _ in range(n):
        own = rng.random() < 0.5
        w = [rng.choice(PROGRAM_WORDS if own else short) for _ in range(rng.randint(3, 7))]
        kind = rng.randrange(6)
        out.append("_".join(w).lower() if kind == 0 else "-".join(w).lower() if kind == 1
                   else "_".join(w).upper() if kind == 2 else "/".join(w) if kind == 3
                   else w[0].lower() + "".join(x.capitalize() for x in w[1:]) if kind == 4
                   else "_".join(w) + str(rng.randint(0, 2030)))
    letters = "abcdefghijklmnopqrstuvwxyz"
    runs = [letters, letters.upper(), "0123456789" * 2, letters + "0123456789", "qwertyuiopasdfghjklzxcvbnm"]
    out += [c * rng.randint(16, 80) for c in letters + letters.upper() + "0123456789+/_=-" for _ in range(80 if c in "-_=" else 6)]
    out += [r[i:] for r in runs for i in range(0, max(1, len(r) - 12)) for _ in range(3)]
    return [t for t in out if len(t) >= 12]


def pair_counts(tokens: list[str]) -> np.ndarray:
    """How often each pair of characters occurs, flat."""
    return np.bincount(transitions(tokens)[0], minlength=_STATES * _STATES).astype(np.int64)


def run_counts(texts: list[str], step: int = 1 << 20) -> np.ndarray:
    """Pair counts of all runs of token characters, of any length, in ``texts``, which the base spans have been taken out of."""
    out = np.zeros(_STATES * _STATES, np.int64)
    raw = np.frombuffer(" ".join(texts).encode("ascii", "replace"), np.uint8)  # one byte a character, "?" is no token character
    last = 0
    for at in range(0, len(raw), step):
        now = _CODE[raw[at:at + step]]
        prev = np.concatenate([[last], now[:-1]])
        last = now[-1]
        out += np.bincount((prev * _STATES + now)[now > 0], minlength=len(out))
    return out


def _held_out(tokens: list[str]) -> tuple[list[str], list[str]]:
    return [t for i, t in enumerate(tokens) if i % 4], [t for t in tokens[::4] if len(t) >= 16]


def _ratio(secret: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of two tables of pair counts, add-one-half, flat."""
    def table_of(counts):
        counts = counts.reshape(_STATES, _STATES) + 0.5
        return np.log(counts / counts.sum(axis=1, keepdims=True))

    return (table_of(secret) - table_of(plain)).ravel()


def train(secrets: list[str], ordinary: list[str]) -> MarkovModel:
    """Add-one-half models of both samples; a fourth of each is held out to place the cut.

    The cut is half-way between what one ordinary token in a thousand exceeds and what
    one secret in a hundred falls short of, and no lower than the former.
    """
    (fit_secret, held_secret), (fit_plain, held_plain) = _held_out(secrets), _held_out(ordinary)
    model = MarkovModel(_ratio(pair_counts(fit_secret), pair_counts(fit_plain)), 0.0)
    plain = float(np.quantile(model.scores(held_plain), 0.999)) if held_plain else 0.0
    secret = float(np.quantile(model.scores(held_secret), 0.01)) if held_secret else plain
    return MarkovModel(model.ratio, max(plain, (plain + secret) / 2))


def blend(seeded: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """``counted`` plus ``seeded``, which weighs as much as the former at least."""
    return counted + seeded * max(1.0, counted.sum() / max(1, seeded.sum()))


_VALUE = re.compile(r"[^A-Za-z0-9+/_=-]")
_BINS = 8192


def place_cut(edges: np.ndarray, caught: np.ndarray, tokens: np.ndarray, held_secret: np.ndarray, held_free: np.ndarray,
              held_plain: np.ndarray) -> float:
    """The cut of ``train``, from histograms of the scores of caught values, corpus tokens and held-out seeded strings.

    The corpus tokens hold the very secrets that are sought: a third more than score above the
    lower quartile of ``held_free``, seeded strings that no base pattern catches.  What that many
    secrets put above a score, with three standard errors, does not count against it.
    Seeded identifiers and corpus tokens each have to stay below the cut.
    """
    def above(hist):
        """What lies in a bin or above it."""
        return np.cumsum(hist[::-1])[::-1]

    def shares(hist):
        return above(hist) / max(1, hist.sum())

    free = shares(held_free)
    sought = above(tokens)[max(0, int((free >= 0.75).sum()) - 1)] / 0.75
    hidden = sought * free
    excess = above(tokens) - hidden - 3 * np.sqrt(hidden + hidden ** 2 / max(1, held_free.sum()))
    corpus = np.flatnonzero(excess > 0.001 * max(0, tokens.sum() - sought))
    seeded = np.flatnonzero(shares(held_plain) > 0.001)
    plain = float(edges[max(int(x[-1]) if len(x) else -1 for x in (corpus, seeded)) + 1])
    return max(plain, (plain + float(edges[int((shares(blend(held_secret, caught)) >= 0.99).sum())])) / 2)


def fit(docs: DataFrame, randoms: int = 4000, names: int = 20_000, seed: int = 11) -> MarkovModel:
    """Models from all of ``docs``, beside ``randoms`` seeded random strings and about ``names`` seeded identifiers.

    One pass counts the character pairs of caught values and of ordinary tokens, a second
    one the scores of both.  The driver gets sums: two tables of 68 x 68 and two histograms.
    """
    texts = doc_texts(docs)
    plain_seeds = identifiers([], names, seed)
    random.Random(seed).shuffle(plain_seeds)
    (fit_secret, held_secret), (fit_plain, held_plain) = _held_out(seeded_randoms(randoms, seed)), _held_out(plain_seeds)

    def summed(count, size: int) -> list[np.ndarray]:
        """Sums over all documents of the two arrays (caught, ordinary) that ``count`` gives for a list of texts."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, size), np.int64)
            for big in batches:
                for at in range(0, big.num_rows, 1024):
                    total += count(big.slice(at, 1024).column(1).to_pylist())
            kind, place = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(place, pa.int32()), pa.array(total[kind, place])],
                                             ["kind", "place", "n"])

        out = np.zeros((2, size), np.int64)
        for r in map_arrow(texts, run, "kind int, place int, n long").groupBy("kind", "place").agg(F.sum("n").alias("n")).collect():
            out[r.kind, r.place] = r.n
        return list(out)

    def pairs(batch: list[str]) -> np.ndarray:
        caught, rest = [], []
        for text in batch:
            spans = base_spans(text)
            caught += caught_values(text, spans)
            for s in reversed(spans):
                text = f"{text[:s[0]]} {text[s[2]:]}"
            rest.append(TOKEN.sub(_unless_public, text) if DATA in text or UUID_PART.search(text) else text)
        return np.stack([pair_counts(caught), run_counts(rest)])

    caught, plain = summed(pairs, _STATES * _STATES)
    model = MarkovModel(_ratio(blend(pair_counts(fit_secret), caught), blend(pair_counts(fit_plain), plain)), 0.0)
    edges = np.linspace(model.ratio.min(), model.ratio.max(), _BINS + 1)

    def histogram(tokens: list[str]) -> np.ndarray:
        at = np.searchsorted(edges, model.scores(tokens), side="left") - 1
        return np.bincount(np.clip(at, 0, _BINS - 1), minlength=_BINS)

    def scored(batch: list[str]) -> np.ndarray:
        caught, tokens = [], []
        for text in batch:
            spans = base_spans(text)
            caught += [v for v in caught_values(text, spans) if len(v) >= 16]
            tokens += [text[a:b] for a, b in free_tokens(text, spans)]
        return np.stack([histogram(caught), histogram(tokens)])

    free, held_plain = ([t for t in x if not base_spans(t)] for x in (held_secret, held_plain))
    return MarkovModel(model.ratio, place_cut(edges, *summed(scored, _BINS), *map(histogram, (held_secret, free, held_plain))))


def caught_values(text: str, spans: list[tuple[int, int, int, int, int]]) -> list[str]:
    """The values of base spans, token characters only, of 12 characters at least.

    Fill such as a row of zeros, with under six distinct characters, does not teach what secrets look like.
    """
    return [v for v in (_VALUE.sub("", text[s[3]:s[4]]) for s in spans) if len(v) >= 12 and len(set(v)) >= 6]


def is_public(text: str, a: int, b: int) -> bool:
    """Whether the token at ``a`` to ``b`` has an ordinary form or is encoded data."""
    return ORDINARY.fullmatch(text, a, b) is not None or text[max(0, a - len(DATA)):a] == DATA


def _unless_public(m: re.Match) -> str:
    return " " if is_public(m.string, *m.span()) else m.group()


def free_tokens(text: str, spans: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int]]:
    """Places of the long tokens that touch no base span, but for ordinary forms and encoded data."""
    out, k = [], 0
    reach = 0  # furthest end of the spans that start before the token's end
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while k < len(spans) and spans[k][0] < b:
            reach, k = max(reach, spans[k][2]), k + 1
        if reach <= a and not is_public(text, a, b):
            out.append((a, b))
    return out


def spans_of(texts: list[str], model: MarkovModel) -> list[list[tuple[int, int, int, int, int]]]:
    """All spans of each text, base and added, in order of start and kind."""
    out, owner, where, tokens = [], [], [], []
    for i, text in enumerate(texts):
        spans = base_spans(text)
        out.append(spans)
        for a, b in free_tokens(text, spans):
            owner.append(i)
            where.append((a, b))
            tokens.append(text[a:b])
    for k in np.flatnonzero(model.scores(tokens) > model.cut):
        a, b = where[k]
        out[owner[k]].append((a, 3, b, a, b))
    return [sorted(s) for s in out]


def joined(spans: list[tuple[int, int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _, _ in spans)


def scan_secrets(docs: DataFrame, model: MarkovModel | None = None) -> DataFrame:
    """One row per document: counts by kind, digest of the base spans, all spans, and ``found`` with the values' places."""
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 68 x 68 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                          ("value_start", pa.int64()), ("value_end", pa.int64())])
        for big in batches:
            for at in range(0, big.num_rows, 1024):
                b = big.slice(at, 1024)
                rows = spans_of(b.column(1).to_pylist(), shared.value)
                count = [pa.array([sum(s[1] == k for s in r) for r in rows], pa.int64()) for k in range(4)]
                base = [hashlib.sha256(joined([s for s in r if s[1] < 3]).encode()).hexdigest() for r in rows]
                found = [[{"kind": KINDS[k], "start": a, "end": e, "value_start": va, "value_end": ve}
                          for a, k, e, va, ve in r] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *count, pa.array(base, pa.string()), pa.array(map(joined, rows), pa.string()),
                     pa.array(found, pa.list_(kind))],
                    ["doc_id", "n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans", "found"])

    return map_arrow(doc_texts(docs), run, SPANS)


def redact(docs: DataFrame, model: MarkovModel | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret value replaced by ``mark`` and ``n_chars``, if there, counted anew; no row is dropped."""
    model = model or fit(docs)
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        plain = ["" if t is None else t for t in texts]
        out = []
        for t, orig, spans in zip(plain, texts, spans_of(plain, shared.value)):
            at, parts = 0, []
            for a, b in sorted((s[3], s[4]) for s in spans):
                if b <= at:
                    continue
                parts += [t[at:max(a, at)], mark] if a >= at else []
                at = b
            out.append(None if orig is None else "".join(parts) + t[at:] if parts else t)
        return pd.Series(out, dtype=object)

    out = docs.withColumn("text", cleaned(docs["text"]))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.length("text").cast(kind)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
    return out


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("found")
