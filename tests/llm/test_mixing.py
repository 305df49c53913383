from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from convlens.llm import mixing
from convlens.llm.queries import op4_source_mix
from tests.llm import plain


def test_targets_stop_at_the_limit_and_are_shared_again():
    sizes = {"a": 100, "b": 100, "c": 1000, None: 0}
    got = mixing.capped_targets(sizes, {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}, 1.5, 2)
    assert got == {"a": 200, "b": 200, "c": 1400, None: 0}
    assert mixing.capped_targets({}, {}, 1.5, 2) == {}


def test_flow_prefers_first_uses_and_splits_overlap():
    patterns = [(("a",), 100), (("a", "b"), 100), (("b",), 50)]
    routed = mixing.route(patterns, {"a": 120.0, "b": 130.0}, 2)
    assert sum(routed[("a", "b")].values()) == pytest.approx(100)  # nothing is repeated
    assert routed[("a",)]["a"] + routed[("a", "b")]["a"] == pytest.approx(120)
    assert routed[("b",)]["b"] + routed[("a", "b")]["b"] == pytest.approx(130)
    routed = mixing.route(patterns, {"a": 50.0, "b": 220.0}, 2)  # b needs more than it has
    assert routed[("b",)]["b"] + routed[("a", "b")]["b"] == pytest.approx(220)


def test_mix_of_the_documents(spark, sf):
    rows = op4_source_mix(spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    size, taken, target, count = {}, {}, {}, {}
    for r in rows:
        own = docs[r.doc_id]
        assert r.size == len(plain.words(own.text))
        assert r.taken in (0, r.size, 2 * r.size)
        size[own.source] = size.get(own.source, 0) + r.size
        count[own.source] = count.get(own.source, 0) + 1
        taken[own.source] = taken.get(own.source, 0) + r.taken
        target[own.source] = r.target
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weights = {s: [5.0, 2.0, 1.0][i % 3] for i, s in enumerate(names)}
    assert target == pytest.approx(mixing.capped_targets(size, weights, 1.5, 2))
    for s in names:
        assert abs(taken[s] - target[s]) <= max(0.01 * target[s], size[s] / count[s] / 2)  # half a document
    assert sorted(map(str, op4_source_mix(spark, sf).collect())) == sorted(map(str, rows))


def test_odd_rows(spark):
    rows = [(i, t, s, 1) for i, t in enumerate(plain.ODD_TEXTS) for s in ("b", None, "a")] + [(4, "One  two\tthree", None, 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    mixed = mixing.mix(docs, F.array("source"), [5.0, 2.0, 1.0])
    got = mixed.documents.collect()
    assert len(got) == len(rows)
    assert all(0 <= r["_mix_copies"] <= 2 and (r["_mix_size"] or not r["_mix_copies"]) for r in got)
    assert mixing.repeated(mixed, docs.columns).schema == docs.schema
    assert mixing.repeated(mixed, docs.columns).count() == sum(r["_mix_copies"] for r in got)


def test_empty_table_and_words_nowhere(spark):
    schema = "doc_id long, text string, source string"
    for rows in ([], [(1, None, "a"), (2, " ", None)]):
        mixed = mixing.mix(spark.createDataFrame(rows, schema), F.array("source"), [1.0])
        assert [r["_mix_copies"] for r in mixed.documents.collect()] == [0] * len(rows)


def test_overlapping_sources_meet_their_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), ["a"] if i % 3 else ["b", "a"] if i % 2 else ["b"]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    mixed = mixing.mix(docs, F.col("sources"), {"a": 1.0, "b": 2.0}, share=0.6)
    used = sum(r["_mix_size"] * r["_mix_copies"] for r in mixed.documents.collect())
    assert used == pytest.approx(sum(t for _, t in mixed.sources.values()), rel=0.005)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_small_sources_come_as_near_as_any_draw(spark, seed):
    """Sources of one to nine documents, of even and of very uneven sizes, against all choices of 0, 1 or 2 uses."""
    draw = random.Random(seed)
    rows = []
    for source, count in enumerate([1, 2, 5, 9, 9]):
        for _ in range(count):
            size = draw.choice([draw.randint(1, 30), draw.randint(1, 30), draw.randint(200, 3000)])
            rows.append((len(rows), " ".join(["w"] * size), f"s{source}"))
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), F.array("source"), [5.0, 2.0, 1.0])
    got = {}
    for r in mixed.documents.collect():
        got.setdefault(r.source, []).append((r["_mix_size"], r["_mix_copies"]))
    for source, own in got.items():
        target = mixed.sources[source][1]
        missed = abs(sum(n * c for n, c in own) - target)
        best = min(abs(sum(n * c for (n, _), c in zip(own, uses)) - target) for uses in itertools.product(range(3), repeat=len(own)))
        assert missed == pytest.approx(best, abs=1e-6), source


def test_some_dozens_of_documents_meet_their_target(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(["w"] * draw.choice([7, 40, 900, 2500])), f"s{i % 3}") for i in range(120)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), F.array("source"), [5.0, 2.0, 1.0])
    taken = {}
    for r in mixed.documents.collect():
        taken[r.source] = taken.get(r.source, 0) + r["_mix_size"] * r["_mix_copies"]
    for source, (_, target) in mixed.sources.items():
        assert abs(taken[source] - target) <= 0.5


def test_nearest_sum():
    assert mixing.nearest_sum(5.2, [[0, 3], [0, 2], [0, 9]]) == [1, 1, 0]
    assert mixing.nearest_sum(0.3, [[0, 1], [0, -1]]) == [0, 0]
    assert mixing.nearest_sum(-4.0, [[0, 3, -3], [0, -7]]) == [1, 1]
    assert mixing.nearest_sum(1.0, []) == []
