from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from convlens.llm import queries, turns
from tests.llm import plain

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(spark, rows, tmp_path, monkeypatch):
    """op11 on literal rows, with columns that clash with the operator's own."""
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("k1", "block", "id", "n", "pos", "len")})
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_prefix_trie(spark, str(tmp_path))
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=str)


def test_query_on_the_small_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_prefix_trie(spark, sf)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain.trie_rows(plain.rebuilt(rows))


@pytest.mark.parametrize("span", [2, 4096])
def test_against_all_prefixes(spark, tmp_path, monkeypatch, span):
    """Long conversations in several rows and spans, copies, nulls, ties, repeated rows, gaps, conversations without turns."""
    monkeypatch.setattr(turns, "SPAN", span)
    draw = random.Random(3)
    words = ["a", "b", "", None, "é" * 3, "long " * 200]
    rows = []
    for c in [*range(0, 40), 55, 57, 1000, 1001]:
        size = 90 if c in (10, 12, 14) else draw.randint(1, 12)
        for t in range(size):
            same = c in (10, 12, 14) and t < 70 + c
            rows.append((c, t * 3 if c % 7 else None if t % 2 else t // 2, "user" if t % 2 else None, "a" if same or draw.random() < 0.6 else draw.choice(words)))
    rows += [r for r in rows if r[0] == 21] + [(None, 0, "user", "nobody's")]
    draw.shuffle(rows)
    expected = plain.trie_rows(plain.rebuilt(rows))
    assert any(r[1] > 64 for r in expected) and any(r[3] > 5 and r[1] > 2 for r in expected)
    assert trie(spark, rows, tmp_path, monkeypatch) == expected


def test_conversations_without_turns_end_at_the_root(spark, tmp_path, monkeypatch):
    """c with h beyond its own turns and no base."""
    rows = [(c, 0, "user", "only") for c in range(101, 105)]
    expected = plain.trie_rows(plain.rebuilt(rows))
    assert expected[0][3] == 4
    assert trie(spark, rows, tmp_path, monkeypatch) == expected


def test_no_conversations_give_no_nodes(spark, tmp_path, monkeypatch):
    assert trie(spark, [], tmp_path, monkeypatch) == []


def test_nodes_with_their_turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", "yes"), (2, 0, "user", "hi")]
    frame = spark.createDataFrame(rows, SCHEMA)
    nodes = turns.with_turns(turns.prefix_trie(turns.ordered(frame)).nodes, frame)
    assert sorted((r.depth, r.role, r.text, r.n_convs) for r in nodes.where("depth > 0").collect()) == [(1, "user", "hi", 2), (2, "bot", "yes", 1)]
