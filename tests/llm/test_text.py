from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from convlens.llm import text
from tests.llm import plain


def test_words_and_hashes_of_any_text():
    random.seed(1)
    known: dict[bytes, int] = {}
    for _ in range(500):
        texts = [
            None if random.random() < 0.1 else "".join(random.choices(" \t\n\x0b\x0c\rabABé\x85\xa0\x1c", k=random.randrange(12)))
            for _ in range(random.randrange(6))
        ]
        column = pa.array(["cut away", *texts], pa.string()).slice(1)
        data, bounds = text.raw(column)
        found = text.words(text.translated(data, text.LOWER), bounds)
        assert found.counts.tolist() == [len(plain.words(t)) for t in texts]
        expected = [w.encode() for t in texts for w in plain.words(t)]
        vocabulary, codes = found.dictionary()
        assert [vocabulary[i].as_py() for i in codes] == expected
        for word, value in zip(expected, found.hashes().tolist(), strict=True):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_hashes_do_not_depend_on_the_piece(monkeypatch):
    data, bounds = text.raw(pa.array(["some words here " * 50, "x" * 700, "last ones"]))
    whole = text.words(data, bounds).hashes()
    monkeypatch.setattr(text, "PIECE", 64)
    assert np.array_equal(text.words(data, bounds).hashes(), whole)


def test_chunks_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(text, "CHUNK_BYTES", 10)
    batch = pa.record_batch({"text": ["aaaa", "bbbb", None, "c" * 50, "", "dd"], "k": list(range(6))})
    assert [k for piece in text.chunks([batch]) for k in piece.column("k").to_pylist()] == list(range(6))
    assert max(piece.num_rows for piece in text.chunks([batch])) == 3


def test_windows_tell_sizes_and_orders_apart():
    h = np.array([1, 2, 3], np.uint64)
    assert text.windows(h, 2)[0] != text.windows(h[::-1].copy(), 2)[1]
    assert text.windows(h[:1], 1)[0] != text.windows(np.append(h[:1], h[:1]), 2)[0]
    assert len(text.windows(h, 4)) == 0
