from __future__ import annotations

import zlib
from pathlib import Path
from types import SimpleNamespace
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest

from convlens.llm import lm, text
from convlens.runtime import cut
from tests.llm import plain


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def scored(docs):
    return by_id(lm.scores(docs))


def test_base_scores_and_counts(docs, scored):
    for doc, (held, tokens, known, total, base) in plain.base_scores([(r.doc_id, r.text) for r in docs.collect()]).items():
        r = scored[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_the_model_predicts_held_out_text_better_than_word_frequency(scored):
    held = [r for r in scored.values() if r.held_out]
    assert len(held) > 5
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_routed_lookups_give_the_same_scores(docs, scored, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT_BYTES", 1 << 16)
    sent, routed = by_id(lm.scores(docs)), by_id(lm.scores(docs, filter_bytes=0))
    for doc, r in sent.items():
        assert r.score == pytest.approx(routed[doc].score, rel=1e-12)
        assert r.base_score == pytest.approx(scored[doc].base_score, rel=1e-9)


def test_scores_of_a_filter_without_errors_are_those_of_exact_counts(monkeypatch):
    """With so many bits that no answer is wrong, the counting, the filter and the smoothing give the model itself."""
    monkeypatch.setattr(lm, "BITS_PER_ENTRY", 4096)
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = np.random.default_rng(3)
    usual = [" ".join(f"w{w}" for w in rng.zipf(1.6, 40) % 60) for _ in range(60)]
    rows = list(enumerate([*plain.ODD_TEXTS, *usual, usual[0], "W1 w1 W1", "never seen"]))
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    texts = pa.array([t for _, t in rows], pa.string())
    every = pa.record_batch({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": texts, "held_out": pa.array(held)})
    trains = every.filter(pa.array([not h for h in held]))
    built = lm._segment_filter(pa.Table.from_batches(lm._ngram_rows(1)(iter([trains]))))
    field, tokens, kinds = (built.column(c)[0].as_py() for c in ("field", "tokens", "kinds"))
    chunk = lm._chunk_rows(1, lm.Filter([len(field)], field), float(tokens), float(kinds))(iter([every]))
    scored = {}
    for about in (r["about"] for b in chunk for r in b.to_pylist() if r["kind"] == lm.ABOUT):
        own = pa.ipc.open_stream(about).read_all()
        scored |= dict(zip(own.column("doc_id").to_pylist(), own.column("score").to_pylist(), strict=True))
    want = plain.pair_scores(rows, lm.BASE, lm.PRIOR)
    assert scored.keys() == want.keys()
    for doc, score in want.items():
        assert scored[doc] == pytest.approx(score, rel=1e-9)


def test_scores_stay_near_those_of_exact_counts(docs, scored):
    """The filter as it is: what its wrong answers change is little beside the text's score."""
    want = plain.pair_scores([(r.doc_id, r.text) for r in docs.collect()], lm.BASE, lm.PRIOR)
    assert sum(abs(scored[d].score - s) for d, s in want.items()) < 0.02 * sum(abs(s) for s in want.values())


def test_odd_texts_and_ids(spark):
    rows = [*enumerate(plain.ODD_TEXTS), (0, "twice"), (3, "one"), (3, "one")]
    got = lm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert all(np.isfinite([r.score, r.base_score]).all() for r in got)
    empty = [r for r in got if r.n_tokens == 1]
    assert len(empty) == 3  # NULL, empty, white space: one end each


def test_empty_and_wholly_held_out_tables(spark):
    schema = "doc_id long, text string"
    assert lm.scores(spark.createDataFrame([], schema)).count() == 0
    (row,) = lm.scores(spark.createDataFrame([(None, "only held out")], schema)).collect()
    assert (row.held_out, row.n_known, row.train_tokens) == (True, 0, 0)


def test_a_filter_never_loses_a_count():
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    counts = rng.integers(1, 3000, len(grams))
    field = lm.build_segment(grams, counts).tobytes()
    read = lm.Filter([len(field)], field).counts(grams)
    level = lm._levels(counts)
    assert (read >= lm._expected(level) - 1e-9).all()
    assert (read == lm._expected(level)).mean() > 0.9
    others = rng.integers(2**63, 2**64 - 1, 4000, dtype=np.uint64)
    assert (lm.Filter([len(field)], field).counts(others) > 0).mean() < 0.1


def test_counts_pack_and_unpack():
    times = np.array([0, 1, 254, 255, 256, 10**12])
    assert lm._large(lm._small(times), len(times)).tolist() == times.tolist()
    assert lm._large(lm._small(times[:0]), 0).tolist() == []


def test_ngrams_squeeze_and_return():
    rng = np.random.default_rng(6)
    edges = np.array([0, 1, 2**64 - 1], np.uint64)
    for count in (0, 1, 700):
        grams = np.unique(np.append(rng.integers(0, 2**64, count, dtype=np.uint64), edges[:count]))
        times = rng.integers(0, 400, len(grams))
        back = lm._unsqueezed(lm._squeezed(grams, times))
        assert back[0].tolist() == grams.tolist()
        assert back[1].tolist() == times.tolist()


def _tables(batches, key):
    """The rows of batches or tables by a column, as Spark hands them out."""
    table = pa.Table.from_batches(batches) if isinstance(batches[0], pa.RecordBatch) else pa.concat_tables(batches)
    keys = np.array(table.column(key).to_pylist())
    return {k: table.filter(pa.array(keys == k)) for k in np.unique(keys).tolist()}


@pytest.mark.parametrize("segments", [1, 5])
def test_answers_of_segments_give_the_scores_of_exact_counts(monkeypatch, segments):
    """Several blocks of several chunks: their n-grams, the segments' answers and the scoring give the model itself."""
    monkeypatch.setattr(lm, "BITS_PER_ENTRY", 4096)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(text, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = np.random.default_rng(4)
    usual = [" ".join(f"w{w}" for w in rng.zipf(1.6, 40) % 60) for _ in range(90)]
    rows = list(enumerate([*plain.ODD_TEXTS, *usual, usual[0], "a " * 400, "W1 w1 W1", "never seen"]))
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    texts = pa.array([t for _, t in rows], pa.string())
    every = pa.record_batch({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": texts, "held_out": pa.array(held)})
    blocks = list(lm._block_texts(iter([every])))
    assert len(blocks) > 2
    answers = [lm._answered(t) for t in _tables(list(lm._block_rows(segments)(iter(blocks))), "segment").values()]
    total, kinds = (float(sum(v for t in answers for v in t.column(c).to_pylist() if v is not None)) for c in ("tokens", "kinds"))
    asked = _tables(answers, "block")
    scored = {}
    for b in blocks:
        row = pa.Table.from_batches([b])
        own = pa.concat_tables([asked[row.column("block")[0].as_py()], row], promote_options="default")
        scored |= {r["doc_id"]: r for r in lm._scored_blocks(total, kinds)(own).to_pylist()}
    want = plain.pair_scores(rows, lm.BASE, lm.PRIOR)
    assert scored.keys() == want.keys()
    for doc, (is_held, tokens, known, trained, base) in plain.base_scores(rows).items():
        r = scored[doc]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (is_held, tokens, known, trained)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(want[doc], rel=1e-9)


def test_a_wholly_held_out_table_is_scored_by_segments_too(spark):
    docs = spark.createDataFrame([(None, "only held out"), (None, None)], "doc_id long, text string")
    sent, asked = (sorted(lm.scores(docs, **limit).collect(), key=str) for limit in ({}, {"filter_bytes": 0}))
    assert [tuple(r) for r in asked] == [pytest.approx(tuple(r)) for r in sent]
    assert {r.train_tokens for r in asked} == {0}


def test_lookups_by_segment_write_little(spark, tmp_path, monkeypatch):
    """What is written and shuffled stays below the text: all n-grams travel once, and their counts come back small."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    vocabulary = ["".join(rng.choice(letters, n)) for n in rng.integers(2, 9, 20_000)]
    texts = [" ".join(vocabulary[i] for i in rng.integers(0, len(vocabulary), 300)) for _ in range(400)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    tables = []
    monkeypatch.setattr(lm, "cut", lambda frame: tables.append(cut(frame)) or tables[-1])
    docs = spark.read.parquet(f"{tmp_path}/docs")
    assert lm.scores(docs, filter_bytes=0).count() == len(texts)
    files = [Path(urlparse(f).path) for t in tables for f in t.inputFiles()]
    assert sum(f.stat().st_size for f in files) < sum(map(len, texts))
