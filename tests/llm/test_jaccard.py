from __future__ import annotations

import random

import numpy as np
import pytest

from convlens.llm import components, jaccard
from tests.llm import plain


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def found(docs, *args):
    rows = jaccard.similar_classes(docs, *args).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in rows), key=str)


def family(count: int, length: int, edits: int, seed: int) -> list[str]:
    """Texts that differ from one in a few places, beside passages that unlike texts share."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(length)]
    texts = []
    for _ in range(count):
        own = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            own[rnd.randrange(length)] = f"e{rnd.randrange(10**6)}"
        texts.append(" ".join(own))
    return texts


def test_agrees_with_all_pairs(spark):
    rnd = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [t for k in range(4) for t in family(25, 40 + 30 * k, 4, k)]
    texts += [passage + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.choice([5, 8, 200]))) for _ in range(40)]
    rows = [(i * 7 % 1009, t) for i, t in enumerate([*texts, *plain.ODD_TEXTS, *texts[:5]])]
    docs = frame(spark, rows).repartition(5)
    for size, num, den in ((4, 85, 100), (5, 80, 100)):
        assert found(docs, size, num, den) == plain.classes(rows, size, num, den)


def test_small_tries_and_joined_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TRIE_NODES", 4)
    monkeypatch.setattr(jaccard, "LIST_BYTES", 0)
    monkeypatch.setattr(jaccard, "SEGMENT_BYTES", 4096)
    rows = list(enumerate(family(60, 80, 8, 9)))
    assert found(frame(spark, rows).repartition(3), 4, 85, 100) == plain.classes(rows, 4, 85, 100)


def test_ids_that_are_null_or_repeated(spark):
    text = "a long enough text with quite some words in it"
    rows = [(None, text), (5, text), (5, text), (3, text.upper()), (None, "alone here"), (5, None), (None, None)]
    assert found(frame(spark, rows), 4, 85, 100) == plain.classes(rows, 4, 85, 100)


def test_empty_table(spark):
    assert found(frame(spark, []), 4, 85, 100) == []


def test_trie_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    for _ in range(60):
        base = rng.choice(60, 25, replace=False)
        sets = [np.unique(np.where(rng.random(25) < 0.1, rng.integers(0, 60, 25), base)).astype(np.uint64) for _ in range(12)]
        sizes = [len(s) for s in sets]
        links = jaccard.trie_links(list(range(12)), sizes, sets, 80, 100)
        root = list(range(12))
        for a, b in links:
            root[a] = b
        plain_root = list(range(12))
        for a in range(12):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= 80 * (sizes[a] + sizes[b] - both):
                    old, new = plain_root[a], plain_root[b]
                    plain_root = [min(old, new) if r in (old, new) else r for r in plain_root]
        assert root == plain_root


def test_components_of_a_path_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (101, 100), (200, 200)]
    roots = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert roots == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


@pytest.mark.parametrize("seed", [1, 2])
def test_one_of_each_class_is_kept(spark, seed):
    texts = [*family(6, 50, 2, seed), "something else entirely in here", "", None]
    rows = [(9 - i, t, "x", i) for i, t in enumerate(texts)]
    rows += [(9, texts[0], "again", 0), (9, texts[0], "again", 0), (None, texts[1], "no id", 1), (None, "a text of its own without id", "no id", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, node int")  # names the operator uses inside
    kept = jaccard.keep_one(docs)
    assert kept.schema == docs.schema
    got = kept.collect()
    expected = plain.classes([(r[0], r[1]) for r in rows], 5, 80, 100)
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted({c for _, _, c in expected if c is not None})
    assert [r.text for r in got if r.doc_id is None] == ["a text of its own without id"]


def test_keep_one_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", "x", "y", "z"), (2, "a b c d e f", "x", "y", "z"), (2, "a b c d e f", "x", "y", "z"), (3, None, "x", "y", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text_hash string, th string, c0 string")
    got = jaccard.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [rows[0], rows[3]]
