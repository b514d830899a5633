import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edge import ROWS, edge, empty, same, wide
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from mapflow.llm.packing import TIERS, Packer, WordTokenizer, op4_packing, pack, slices, step_groups

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check(pieces, ids):
    """Every id once, right digests, gapless sequences, padding only in a partition's last."""
    for doc, group in pieces.groupby("doc_id", dropna=False):
        at = 0
        for r in group.sort_values("start").itertuples():
            part = ids[doc][r.start:r.start + r.length]
            assert r.start == at and len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
            assert r.doc_tokens == len(ids[doc])
            at += r.length
        assert at == len(ids[doc])
    padded = 0
    for _, group in pieces.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == (group.length.cumsum() - group.length).tolist()
        total = int(group.length.sum())
        assert total <= 2048
        padded += total & (total - 1) != 0
    return padded


def test_whole_table_round_trip(spark, plain):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").toPandas()
    pieces = op4_packing(spark, SF001).toPandas()
    assert check(pieces, {r.doc_id: plain(r.text) for r in docs.itertuples()}) <= 1


def test_word_memory_gives_the_whole_text_ids(plain):
    texts = ["", " ", "it's  we'll don't\tDON'T", "a.b,c... d!? (x) 'quoted' 's", "Straße ÉCOLE Σίσυφος ΟΔΟΣ İstanbul e\u0301",
             "12 3a4 <|endoftext|> <|startoftext|>x", "漢字 かな 🙂🙂", "x" * 5000, "\u00a0\u2028 odd\x1cmarks\x85here", "K\u212a"] * 2
    tok = WordTokenizer(PATH, memory=5)
    for _ in range(3):
        for t, got in zip(texts, tok.encode(pa.array(texts), 1)):
            assert got.tolist() == plain(t).tolist(), t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBé' .,'sd1\n\t-$"), max_size=40), max_size=8))
def test_any_text(texts):
    t = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = t
    tok = WordTokenizer(PATH) if not hasattr(test_any_text, "w") else test_any_text.w
    test_any_text.w = tok
    if texts:
        for x, got in zip(texts, tok.encode(pa.array(texts), 1)):
            assert got.tolist() == t.encode(x, add_special_tokens=False).ids + [1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 9000), min_size=1, max_size=60), st.integers(1, 20))
def test_packer_fills_every_window_but_the_last(lengths, chunk):
    packer, windows = Packer(TIERS), []
    docs = {i: np.arange(n, dtype=np.uint32) for i, n in enumerate(lengths)}
    for at in range(0, len(lengths), chunk):
        for i in range(at, min(at + chunk, len(lengths))):
            windows += packer.add(i, docs[i])
        windows += packer.windows(last=False)
    windows += packer.windows(last=True)
    assert sum(sum(len(p.ids) for p in w) != t for t, w in windows) <= 1
    seen = {i: np.zeros(n, int) for i, n in enumerate(lengths)}
    for _, w in windows:
        for p in w:
            assert p.ids.tolist() == list(range(p.start, p.start + len(p.ids)))
            seen[p.doc][p.start:p.start + len(p.ids)] += 1
    assert all((s == 1).all() for s in seen.values())


def test_slices_cover_a_batch_within_their_bounds():
    texts = ["a" * n for n in (5, 0, 0, 30, 3, 3, 3, 100, 1, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts)], ["doc_id", "text"])
    for rows, nbytes in ((3, 1000), (100, 10), (1, 1), (100, 1000)):
        parts = [p.column(1).to_pylist() for p in slices(batch, rows, nbytes)]
        assert [t for p in parts for t in p] == texts
        assert all(len(p) <= rows and (len(p) == 1 or sum(map(len, p)) <= nbytes) for p in parts)
    assert list(slices(batch.slice(0, 0), 5, 5)) == []


def test_long_windows_are_filled_from_shorter_tiers():
    packer = Packer(TIERS)
    for i, n in enumerate((2000, 48, 900, 124)):
        assert not list(packer.add(i, np.zeros(n, np.uint32)))
    windows = list(packer.windows(last=True))
    assert (2048, [0, 1]) in [(t, [p.doc for p in w]) for t, w in windows]
    assert [(t, [p.doc for p in w]) for t, w in windows][1:] == [(1024, [2, 3])]


def test_step_groups_cost_about_the_same():
    packer, windows = Packer(TIERS), []
    rng = np.random.default_rng(1)
    for i, n in enumerate(rng.integers(1, 3000, 600)):
        windows += packer.add(i, np.zeros(n, np.uint32))
    windows += packer.windows(last=True)
    groups = step_groups(windows, 16_384)
    cost = {}
    for g, (t, w) in zip(groups, windows):
        cost.setdefault(t, {}).setdefault(g, []).append(sum(len(p.ids) ** 2 for p in w))
    for per in cost.values():
        mean = [sum(c) / len(c) for c in per.values()]
        assert max(mean) <= 1.35 * min(mean)


def test_edges(spark, plain):
    pieces = pack(edge(spark).coalesce(1)).toPandas()
    assert (pieces.start == 0).sum() >= len(ROWS)
    assert int(pieces.length.sum()) == sum(len(plain(r[1])) for r in ROWS)
    assert pieces[pieces.doc_id == 2][["length", "doc_tokens"]].values.tolist() == [[1, 1]]
    assert pieces.doc_id.isna().any()
    assert pack(empty(spark)).count() == 0
    same(pack(wide(spark).coalesce(1)), pack(edge(spark).coalesce(1)))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_other_tokenizers_get_whole_texts(name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    texts = ["Hello World, it's  TWO  spaces\n\nand lines\t", "", " lead", "Ünï 漢字 🙂 <|endoftext|>", "x" * 5000]
    words = WordTokenizer(path)
    assert words.wordwise == (name == "word_bpe_49k.json")
    got = words.encode(pa.array(texts), 1)
    assert [g.tolist() for g in got] == [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in texts]
