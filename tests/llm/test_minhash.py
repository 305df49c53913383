from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from convlens.llm import minhash, queries
from tests.llm import plain


def run(spark, rows, **how):
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("th", "node", "left", "nid")})
    found = minhash.near_duplicates(frame.repartition(6), **how).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return sorted((tuple(r)[:3] for r in found), key=str)


def test_query_on_the_small_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_minhash_dedup(spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r)[:3] for r in got.collect()), key=str) == plain.classes(rows, 2, 80, 100)


def varied(draw, words, share):
    return " ".join(draw.choice("pqrstuvwxyz") + draw.choice("pqrstuvwxyz") if draw.random() < share else w for w in words)


@pytest.mark.parametrize("block", [4, 192])
def test_groups_of_near_copies(spark, monkeypatch, block):
    """Groups around the threshold, in whole and in dealt blocks; a passage that most texts share."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    draw = random.Random(11)
    passage = [f"w{draw.randint(0, 60)}" for _ in range(80)]
    rows = []
    for g in range(12):
        own = [f"g{g}x{draw.randint(0, 99)}" for _ in range(draw.randint(3, 60))]
        for _ in range(draw.randint(1, 14)):
            body = own + passage if g % 3 else own
            rows.append((len(rows), varied(draw, body, draw.choice([0, 0.02, 0.04, 0.08]))))
    rows += [(len(rows) + i, t) for i, (_, t) in enumerate(rows[:20])]
    expected = plain.classes(rows, 2, 80, 100)
    assert 20 < len({r[2] for r in expected}) < len(rows)
    assert run(spark, rows, size=2) == expected


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(plain.ODD_TEXTS)] + [(50, "word " * 300), (None, "one"), (50, "word " * 300), (60, "A b C D e" * 4000)]
    assert run(spark, rows, size=2) == plain.classes(rows, 2, 80, 100)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, " ")]) == [(1, 0, 1), (2, 0, 2)]


def test_parts_agree_as_often_as_sets_are_alike():
    """The share of equal left and right parts is close to similarity to the power of the width."""
    draw = np.random.default_rng(1)
    grams = draw.integers(0, 1 << 63, (400, 180), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    alike = []
    for own in grams:
        a, b = own[:160], np.concatenate([own[:140], own[160:]])  # 140 of 180
        sides = minhash.signatures([np.sort(a), np.sort(b)])
        alike.append((sides[0] == sides[1]).mean())
    assert np.mean(alike) == pytest.approx((140 / 180) ** minhash.WIDTH, abs=0.02)


def test_links_of_a_block():
    draw = random.Random(2)
    sets = [np.array(sorted(draw.sample(range(40), draw.randint(1, 40))), np.uint64) for _ in range(60)]
    sets += [s for s in sets[:5]]
    got = minhash.block_links(list(range(len(sets))), sets, list(range(len(sets))), 60, 100)
    root = dict(got)
    expected = {}
    for i in range(len(sets)):
        todo, seen = [i], {i}
        while todo:
            x = todo.pop()
            for j in range(len(sets)):
                both = len(np.intersect1d(sets[x], sets[j]))
                if j not in seen and 100 * both >= 60 * (len(sets[x]) + len(sets[j]) - both):
                    seen.add(j), todo.append(j)
        expected[i] = min(seen)
    assert {i: root.get(i, i) for i in range(len(sets))} == expected
