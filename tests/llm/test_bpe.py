from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from convlens.llm import bpe
from convlens.llm.queries import op8_bpe, tokenizer_path
from tests.llm import plain


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(tokenizer_path())
    own.no_truncation()
    own.no_padding()
    return own


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return bpe.vocabulary(file.read())


def test_walk_agrees_with_the_library(library, vocabulary):
    random.seed(2)
    words = {"a" * n for n in range(1, 80)} | {"=-" * n for n in range(1, 40)} | {"aab" * 40, "é" * 9, "漢字" * 5}
    words |= {"".join(random.choices("aaabehintrsé'-=.01漢", k=random.randrange(1, 25))) for _ in range(4000)}
    for word, ids in vocabulary.walk([w.encode() for w in words]):
        pieces = library.pre_tokenizer.pre_tokenize_str(word.decode())
        if len(pieces) == 1:
            assert ids == library.encode(word.decode(), add_special_tokens=False).ids


def test_documents_and_odd_texts(spark, sf, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op8_bpe(spark, sf).collect()}
    odd = list(enumerate([*plain.ODD_TEXTS, "<|endoftext|>", "a  <|endoftext|><|endoftext|>  b\n\n c", "it's we'll  x   y\x85", "<|endoftext", "\U0001f389‍́"]))
    frame = spark.createDataFrame([(i, t, "k") for i, t in odd], "doc_id long, text string, n_tokens string")
    odd_got = {r.doc_id: r for r in bpe.digests(frame, tokenizer_path()).collect()}
    for rows, answers in ((docs, got), (odd, odd_got)):
        assert len(answers) == len(rows)
        for doc, text in rows:
            ids = library.encode(text or "", add_special_tokens=False).ids
            assert answers[doc].n_tokens == len(ids), text
            assert answers[doc].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), text
            back = library.decode(ids, skip_special_tokens=False)
            assert answers[doc].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest(), text


def test_round_trip_and_small_caches(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_WORDS", 7)
    rows = [(i, t) for i, t in enumerate(plain.ODD_TEXTS)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    back = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path()).collect()
    assert sorted((r.doc_id, r.decoded) for r in back) == sorted((i, t or "") for i, t in rows)
    assert bpe.encode(docs.where("doc_id < 0"), tokenizer_path()).count() == 0


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    words = [b"hello", b" world", b" worlds", b" word"]
    first = vocabulary.encodings(words)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 2)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 1)
    assert vocabulary.encodings(words) == first == vocabulary.encodings(words)


def test_columns_of_any_name_and_long_texts(spark, library):
    rows = [(1, "a long text " * 400_000, "w", "i", "d", "s"), (2, None, "w", "i", "d", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, ids string, decoded string, c0 string")
    got = bpe.encode(docs, tokenizer_path())
    assert got.columns == ["doc_id", "words", "decoded", "c0", "ids"]
    found = {r.doc_id: r for r in got.collect()}
    assert list(found[1].ids) == library.encode(rows[0][1], add_special_tokens=False).ids and list(found[2].ids) == []
    assert (found[1].words, found[1].decoded, found[1].c0) == ("w", "d", "s")
    both = bpe.encode(docs, tokenizer_path(), decode_too=True)
    assert both.columns == ["doc_id", "words", "c0", "ids", "decoded"]


def test_batches_are_bounded_by_bytes(spark):
    from convlens.llm.text import BATCH_BYTES, BATCH_SETTING, small_batches

    before = spark.conf.get(BATCH_SETTING)
    try:
        for given, expected in (("64m", BATCH_BYTES), (str(1 << 20), 1 << 20)):
            spark.conf.set(BATCH_SETTING, given)
            small_batches(spark)
            assert int(spark.conf.get(BATCH_SETTING).rstrip("b")) == expected
    finally:
        spark.conf.set(BATCH_SETTING, before)
