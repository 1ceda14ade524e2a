import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lectern.llm import packing
from lectern.llm.tokens import Encoder
from tests.llm.conftest import edge_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", [
    "", " ", "  ", "a  b\n  c \n\n d ", "it's we'll '", "\t x\n", "日本 x  y", "é x", "a\r\n b", "ab'sd 12.3 «q» x²", "x\x1cy \x85 z", "<|endoftext|> a", "a   ", " b",
    "don't!!! ###$$$ 1,000.50 — “quoted” \U0001f600"])
def test_encoder_equals_the_tokenizer(plain, text):
    assert Encoder(PATH, 50).encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_encoder_in_slices(plain, monkeypatch):
    monkeypatch.setattr("lectern.llm.tokens.SLICE", 97)
    text = "The old  mill\n\nstands 'neath the hill's edge. " * 40
    assert Encoder(PATH, 50).encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_best_level_minimises_the_sum_of_squares():
    rng = np.random.default_rng(5)
    for _ in range(300):
        levels = packing.LevelArray(16)
        levels.count[1:16] = rng.integers(0, 4, 15)
        size = int(rng.integers(1, 16))

        def after(h):
            c = levels.count.copy()
            c[h] -= h > 0
            if h + size < 16:
                c[h + size] += 1
            return int((c[1:16] ** 2).sum())

        usable = [h for h in range(17 - size) if h == 0 or levels.count[h]]
        assert after(levels.best_level(size)) == min(map(after, usable))


def check(rows, docs, plain, window=2048):
    want = {}
    for doc, text, *_ in docs:
        want.setdefault(doc, []).append(plain.encode(text or "", add_special_tokens=False).ids + [1])
    pieces, sequences = {}, {}
    for r in rows:
        assert r.length * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces.keys() == want.keys()
    for doc, texts in want.items():
        if len(texts) == 1:
            own = sorted(pieces[doc], key=lambda r: r.start)
            assert b"".join(r.ids for r in own) == np.array(texts[0], "<u4").tobytes()
            assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert sum(r.length for r in pieces[doc]) == sum(map(len, texts))
    padding = 0
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= window
        padding += 0 if end & (end - 1) == 0 else window - end
    return padding / sum(r.length for r in rows)


def test_pack_documents(documents, plain):
    rows = packing.pack(documents, PATH).collect()
    assert check(rows, documents.collect(), plain) < 0.01


def test_pack_with_few_open_windows(documents, plain):
    assert check(packing.pack(documents, PATH, max_open=4).collect(), documents.collect(), plain) < 0.01
    assert check(packing.pack(documents, PATH, max_held_tokens=3000).collect(), documents.collect(), plain) < 0.01


def test_pack_edges(edge, clashing, empty, plain):
    assert check(packing.pack(edge, PATH).collect(), edge_rows(), plain) < 0.01
    assert packing.pack(clashing, PATH).count() >= edge.count()
    assert packing.pack(empty, PATH).count() == 0


def test_closing_keeps_windows_as_filled():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 7, 300):
        levels, given, full = packing.LevelArray(64), {}, []
        for doc in range(n):
            ids = rng.integers(2, 99, rng.integers(1, 64)).astype("<u4")
            given[doc] = ids
            full += [done] if (done := levels.place(packing.Piece(doc, 0, ids, len(ids)))) else []
        open_tokens = sum(len(p.ids) for held in levels.held.values() for w in held for p in w)
        closed = levels.close()
        back = {}
        for window in full + closed:
            size = sum(len(p.ids) for p in window)
            assert 0 < size <= 64 and not size & (size - 1)
            for p in window:
                back.setdefault(p.doc, []).append(p)
        for doc, ids in given.items():
            own = sorted(back[doc], key=lambda p: p.start)
            assert [p.start for p in own] == np.cumsum([0] + [len(p.ids) for p in own])[:-1].tolist()
            assert np.array_equal(np.concatenate([p.ids for p in own]), ids)
        cut = sum(len(p.ids) for window in closed for p in window if len(p.ids) < p.doc_tokens)
        assert n < 300 or cut < 0.15 * open_tokens
        assert levels.open == 0 and not levels.count[1:].any()
