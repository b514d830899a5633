"""Packing: hierarchical packing of documents into windows of several lengths.

Each document becomes its token ids and one closing id.  Whole long windows are
cut off first; what is left goes to the shortest context tier that holds it.
Every tier is packed longest piece first; gaps are filled with the largest piece
that fits, from the same tier and then from shorter ones, and what still gapes
takes the head of a piece whose rest is routed again.  So all windows are full
but the last one of each input partition.  Windows of a tier are dealt into step
groups by attention cost, back and forth, so that the groups cost about the same.

Packing runs inside each input partition in chunks of ``chunk_docs`` rows: no
shuffle, and memory holds one chunk (also bounded by its texts' bytes, but for a single
longer one) and under one window of carried pieces.
Input partitions come from file splits, which do not depend on keys, so a hot
source or a large group of copies changes nothing.  A retried task reads the
same split and packs the same windows.

Null and empty texts: one piece holding the closing id.  Null ``doc_id``: kept as
null.  Repeated rows: each row is a document of its own.  Empty table: no rows.
Very long texts: cut into as many windows as they need.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import doc_texts, map_arrow, table

TIERS = (256, 512, 1024, 2048)
#: Tokens of a step group, whatever its tier.
STEP_TOKENS = 65_536
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier long, step_group long")
_PUNCT = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


#: A tokenizer that lower-cases, makes every white space one space and then keeps only matches without spaces: it
#: never joins text across a space.  Others get whole texts.
_WORDWISE = (["NFC", "Replace", "Lowercase"], {"Regex": r"\s+"}, " ",
             {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "Removed", True)


def wordwise(spec: dict) -> bool:
    """Whether a tokenizer's own description proves that a text's ids are those of its lower-cased words in order."""
    try:
        normal, first = spec["normalizer"]["normalizers"], spec["pre_tokenizer"]["pretokenizers"][0]
        return _WORDWISE == ([x["type"] for x in normal], normal[1]["pattern"], normal[1]["content"],
                             first["pattern"], first["behavior"], first["invert"])
    except (KeyError, IndexError, TypeError):
        return False


class WordTokenizer:
    """Ids of whole texts by way of their words, which occur again and again.

    A tokenizer that is ``wordwise`` never joins text across a space, so a text's ids are those of
    its space-separated words in order; with any other, texts are encoded whole.  Words seen before come from a bounded
    memory (of ``memory`` words the less used half is dropped when it is full);
    only new ones are encoded.
    """

    def __init__(self, path: str, memory: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.memory = memory
        self.wordwise = wordwise(json.loads(self.tok.to_str()))
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.used = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lens = np.zeros(1 << 14, np.int32)
        self.hits = np.zeros(1 << 14, np.int32)

    def _shrink(self) -> None:
        """Keeps the words used most, half of the memory at most."""
        n, keep = len(self.index), self.memory // 2
        least = np.partition(self.hits[:n], n - keep)[n - keep] if n > keep else 0
        kept = np.flatnonzero(self.hits[:n] > least)
        words = list(self.index)
        words, ids, lens = [words[i] for i in kept], self._gather(kept), self.lens[kept]
        self._forget()
        self._add(words, ids, lens)

    def _encode(self, new: list[str]) -> None:
        """Learns words from the tokenizer; plain ones go in one text, in which a word-end id closes each of them."""
        plain = [w for w in new if w.isalpha() and w.isascii()]
        rest = new
        if plain:
            ids = np.array(self.tok.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.uint32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(plain):
                self._add(plain, ids, np.diff(cut, prepend=0))
                rest = [w for w in new if w not in self.index]
        if rest:
            ids = [e.ids for e in self.tok.encode_batch_fast(rest, add_special_tokens=False)]
            self._add(rest, np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def _learn(self, new: set[str]) -> None:
        # A word and the punctuation behind it are separate for the tokenizer: learn them once each.
        ending = [(w, core, w[len(core):]) for w in new if w[-1:] in _PUNCT and (core := w.rstrip(_PUNCT)).isalpha()]
        parts = new.difference([w for w, _, _ in ending]).union([c for _, c, _ in ending], [e for _, _, e in ending])
        self._encode([w for w in parts if w not in self.index])
        if ending:
            get = self.index.__getitem__
            k = np.fromiter((get(x) for _, core, end in ending for x in (core, end)), np.int64, 2 * len(ending))
            self._add([w for w, _, _ in ending], self._gather(k), self.lens[k].reshape(-1, 2).sum(axis=1))

    def _gather(self, k: np.ndarray) -> np.ndarray:
        """Ids of the words numbered ``k``, end to end."""
        lens = self.lens[k].astype(np.int64)
        ends = np.cumsum(lens)
        return self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[k] - (ends - lens), lens)]

    def _add(self, words: list[str], ids: np.ndarray, lens: np.ndarray) -> None:
        n, total = len(self.index), len(ids)
        while n + len(words) > len(self.lens):
            self.starts, self.lens, self.hits = (np.resize(x, 2 * len(x)) for x in (self.starts, self.lens, self.hits))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.lens[n:n + len(words)] = lens
        self.hits[n:n + len(words)] = 0
        self.starts[n:n + len(words)] = self.used + np.cumsum(lens) - lens
        self.flat[self.used:self.used + total] = ids
        self.used += total
        self.index.update(zip(words, range(n, n + len(words))))

    def encode(self, texts: pa.Array, close: int) -> list[np.ndarray]:
        """Ids of each text (no nulls), followed by ``close``."""
        if not self.wordwise:
            return [np.array([*e.ids, close], np.uint32) for e in self.tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        if len(self.index) > self.memory:
            self._shrink()
        # ASCII letters go to lower case here already (as the tokenizer does) so that fewer words differ.
        lists = pc.split_pattern(pc.replace_substring(pc.ascii_lower(texts), "\n", " "), " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        k = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        if len(missing := np.flatnonzero(k < 0)):
            new = [words[i] for i in missing]
            self._learn(set(new))
            k[missing] = [self.index[w] for w in new]
        self.hits[k] += 1  # once for each call, however often a word occurs in it
        k = k[coded.indices.to_numpy(zero_copy_only=False)]
        ids = self._gather(k)
        ends = np.cumsum(self.lens[k])
        at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        tail = np.array([close], np.uint32)
        return [np.concatenate([ids[a:b], tail]) for a, b in zip(at[:-1], at[1:])]


class Piece:
    """Ids ``start`` to ``start + len(ids)`` of one document."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start, ids, total):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total


class Packer:
    """Pieces in, full windows out; see the module text."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tuple(sorted(tiers))
        self.pools: dict[int, list] = {t: [] for t in self.tiers}  # sorted (length, order, piece)
        self.order = 0

    def _route(self, piece: Piece) -> None:
        n = len(piece.ids)
        self.order += 1
        insort(self.pools[next(t for t in self.tiers if n <= t)], (n, -self.order, piece))

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple[int, list[Piece]]]:
        """Takes a document; yields the longest-tier windows that it fills alone."""
        top, total = self.tiers[-1], len(ids)
        full = total // top * top
        for s in range(0, full, top):
            yield top, [Piece(doc, s, ids[s:s + top], total)]
        if total > full:
            self._route(Piece(doc, full, ids[full:], total))

    def _largest(self, gap: int, tier: int) -> Piece | None:
        for t in reversed(self.tiers[:self.tiers.index(tier) + 1]):
            pool = self.pools[t]
            if i := bisect_right(pool, (gap, 1)):
                return pool.pop(i - 1)[2]
        return None

    def _head(self, gap: int) -> Piece | None:
        """The first ``gap`` ids of the shortest piece that has more; its rest is routed again."""
        for t in self.tiers:
            pool = self.pools[t]
            if (i := bisect_right(pool, (gap, 1))) < len(pool):
                p = pool.pop(i)[2]
                self._route(Piece(p.doc, p.start + gap, p.ids[gap:], p.total))
                return Piece(p.doc, p.start, p.ids[:gap], p.total)
        return None

    def windows(self, last: bool) -> Iterator[tuple[int, list[Piece]]]:
        """Full windows from the pools, longest tier first; ``last``: also what cannot fill one."""
        for tier in reversed(self.tiers):
            pool = self.pools[tier]
            while pool:
                window, gap = [pool.pop()[2]], tier
                gap -= len(window[0].ids)
                while gap and (p := self._largest(gap, tier) or self._head(gap)):
                    window.append(p)
                    gap -= len(p.ids)
                if gap:  # the pools are empty, of this tier and shorter: keep for the next chunk
                    if last:
                        yield from self._close(window)
                    else:
                        for p in window:
                            self._route(Piece(p.doc, p.start, p.ids.copy(), p.total))
                    return
                yield tier, window

    def _close(self, window: list[Piece]) -> Iterator[tuple[int, list[Piece]]]:
        """The partition's last pieces, cut into full shorter windows and one with padding."""
        window = sorted(window, key=lambda p: -len(p.ids))
        for tier in reversed(self.tiers):
            while sum(len(p.ids) for p in window) >= tier:
                full, gap = [], tier
                while gap:
                    p = window.pop(0)
                    if len(p.ids) > gap:
                        window.insert(0, Piece(p.doc, p.start + gap, p.ids[gap:], p.total))
                        p = Piece(p.doc, p.start, p.ids[:gap], p.total)
                    full.append(p)
                    gap -= len(p.ids)
                yield tier, full
        if window:
            yield self.tiers[-1], window


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group number for each window: groups of one tier, of about equal attention cost."""
    out, first = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}):
        mine = [i for i, (t, _) in enumerate(windows) if t == tier]
        mine.sort(key=lambda i: (-sum(len(p.ids) ** 2 for p in windows[i][1]), i))
        n = max(1, round(len(mine) * tier / step_tokens))
        for rank, i in enumerate(mine):
            lap, at = divmod(rank, n)
            out[i] = first + (n - 1 - at if lap % 2 else at)
        first += n
    return out


def slices(batch: pa.RecordBatch, rows: int, nbytes: int) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` of at most ``rows`` rows and about ``nbytes`` of text (second column), one row at least."""
    sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(sizes, before + nbytes, "right"))))
        yield batch.slice(at, end - at)
        at = end


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _rows(windows, sequence: int, group: int, step_tokens: int) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(9)]
    groups = step_groups(windows, step_tokens)
    for k, (tier, window) in enumerate(windows):
        offset = 0
        for p in window:
            n = len(p.ids)
            for c, v in zip(cols, (p.doc, p.start, n, zlib.crc32(np.ascontiguousarray(p.ids, "<u4")), p.total,
                                   sequence + k, offset, tier, group + groups[k])):
                c.append(v)
            offset += n
    names = [x.split()[0] for x in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def pack(docs: DataFrame, tokenizer_path: str | None = None, tiers: tuple[int, ...] = TIERS, close_id: int = 1,
         chunk_docs: int = 4096, chunk_bytes: int = 16 << 20, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: document, place in the document, window, place in the window, tier, step group.

    ``tokenizer_path``: a file of the tokenizers library on every machine; the
    installed public one by default.  ``tiers``: window lengths, powers of two.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        tok = _tokenizer(tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
        packer, base = Packer(tiers), TaskContext.get().partitionId() << 40
        sequence = group = base

        def emit(windows):
            nonlocal sequence, group
            out = _rows(windows, sequence, group, step_tokens)
            sequence += len(windows)
            group += len(windows)
            return out

        for batch in batches:
            for part in slices(batch, chunk_docs, chunk_bytes):
                windows = []
                ids = tok.encode(part.column(1).to_pylist(), close_id)
                for doc, x in zip(part.column(0).to_pylist(), ids):
                    windows += packer.add(doc, x)
                windows += packer.windows(last=False)
                if windows:
                    yield emit(windows)
        if windows := list(packer.windows(last=True)):
            yield emit(windows)

    return map_arrow(doc_texts(docs), run, PIECES)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
