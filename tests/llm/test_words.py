"""Word arrays against re and plain loops."""

import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.words import END, Lookup, Words, blocks, shingles

TEXTS = ["", "one", "a b c d", "the quick-brown fox; jumps over\nthe été_x lazy", "  ", "x" * 100_000, "a b c d e a b c d e a"]
WORD = re.compile(r"(?:[0-9a-z]|[^\x00-\x7f])+")


def column(texts, kind=None):
    return pa.array([t.encode() + bytes([END]) for t in texts], kind or pa.binary())


@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_words_and_hashes(kind):
    words = Words(column(TEXTS, kind).slice(1))
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.start, words.end)]
    want = [WORD.findall(t) for t in TEXTS[1:]]
    assert found == [w for ws in want for w in ws]
    assert np.diff(words.first).tolist() == [len(ws) for ws in want]
    by_hash, heads = {}, {}
    for word, h, k in zip(found, words.hashes().tolist(), words.heads(4).tolist()):
        assert by_hash.setdefault(h, word) == word
        assert k == 0 if len(word.encode()) < 4 else heads.setdefault(k, word.encode()[:4]) == word.encode()[:4]
    assert len(by_hash) == len(set(found))


def test_shingles():
    words = Words(column(TEXTS))
    out, bounds = shingles(words.hashes(), words.first)
    want, seen = [WORD.findall(t) for t in TEXTS], {}
    for i, ws in enumerate(want):
        grams = [tuple(ws[j : j + 5]) for j in range(max(len(ws) - 4, min(1, len(ws))))]
        assert bounds[i + 1] - bounds[i] == len(grams)
        for h, g in zip(out[bounds[i] : bounds[i + 1]].tolist(), grams):
            assert seen.setdefault(h, g) == g
    assert len(seen) == len(set(seen.values()))


def test_blocks_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([column(TEXTS)], names=["text"])
    parts = list(blocks(iter([batch, batch.slice(0, 0)]), "text", 20))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column(0).to_pylist()


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(1, 1 << 63, 5000, dtype=np.uint64))
    look = Lookup(np.concatenate([keys, [np.uint64(0)]]), np.arange(1, len(keys) + 2))
    asked = np.concatenate([keys, keys + np.uint64(1), [np.uint64(0)]])
    want = dict(zip(keys.tolist(), range(1, len(keys) + 1)))
    assert look(asked).tolist() == [want.get(k, 0) for k in asked.tolist()]
    close = np.arange(1, 40, dtype=np.uint64)
    assert Lookup(close, close)(close).tolist() == close.tolist()
    assert Lookup(keys[:0], np.zeros(0))(keys[:3]).tolist() == [0, 0, 0]


def test_blocks_give_back_unused_memory_at_their_end(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            self.released += 1

    pool = Pool()
    batch = pa.RecordBatch.from_arrays([column(TEXTS)], names=["text"])
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    cut = blocks(iter([batch, batch]), "text", 8)
    assert next(cut).num_rows and not pool.released
    assert sum(b.num_rows for b in cut) < 2 * len(TEXTS) and pool.released == 1
    assert list(blocks(iter([]), "text")) == [] and pool.released == 2
