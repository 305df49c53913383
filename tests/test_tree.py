"""Segment trees against a plain recursion, and their invariants."""

from __future__ import annotations

import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from convlens.operators import tree
from convlens.operators.tree import TREE_FEATURES, SegmentTrees

START = datetime(2025, 1, 1)
SCHEMA = (
    "transaction_id string, custom_var_3 string, "
    + ", ".join(f"{f} string" for f in TREE_FEATURES)
    + ", revenue decimal(12,6), postback_timestamp timestamp_ntz"
)


def make(seed, sizes):
    """Random conversions whose revenue leans on two of the features."""
    rng = random.Random(seed)
    rows = []
    for var3, size in sizes.items():
        for _ in range(size):
            values = [f"{f[:2]}{rng.randrange(2 + i)}" for i, f in enumerate(TREE_FEATURES)]
            lean = 40 * (values[1] == "de1") - 30 * (values[5] in ("is0", "is4"))
            amount = Decimal(100 + lean + rng.randrange(60))
            rows.append((str(len(rows)), var3, *values, amount, START + timedelta(seconds=len(rows))))
    return rows


def recurse(rows, node=1, depth=0, minimum=10):
    """(node -> (n, h, feature, value)) of one campaign's tree; ``rows`` are (values, label)."""
    n, h = len(rows), sum(label for _, label in rows)
    best = None
    if depth < 4 and n >= 2 * minimum and 0 < h < n:
        for i, feature in enumerate(TREE_FEATURES):
            for cut in sorted({v[i] for v, _ in rows})[:-1]:
                left = [label for v, label in rows if v[i] <= cut]
                nl, hl = len(left), sum(left)
                if min(nl, n - nl) < minimum:
                    continue
                gain = 2 * h * (n - h) / n - 2 * hl * (nl - hl) / nl
                gain -= 2 * (h - hl) * (n - nl - h + hl) / (n - nl)
                rank = (-round(gain, 9), feature, cut)
                if gain > 1e-9 and (best is None or rank < best[0]):
                    best = (rank, i, cut)
    if best is None:
        return {node: (n, h, None, None)}
    _, i, cut = best
    nodes = {node: (n, h, TREE_FEATURES[i], cut)}
    nodes |= recurse([r for r in rows if r[0][i] <= cut], 2 * node, depth + 1)
    nodes |= recurse([r for r in rows if r[0][i] > cut], 2 * node + 1, depth + 1)
    return nodes


@pytest.fixture(scope="module")
def rows():
    return make(11, {"big": 600, "mid": 120, "small": 49})


@pytest.fixture(scope="module")
def grown(spark, rows):
    return SegmentTrees(spark.createDataFrame(rows, SCHEMA))


def test_same_splits_as_recursion(grown, rows):
    want = {}
    for var3 in ("big", "mid"):
        own = [r for r in rows if r[1] == var3]
        median = statistics.median([r[-2] for r in own])
        labelled = [(r[2:8], int(r[-2] > median)) for r in own]
        want |= {(var3, node): info for node, info in recurse(labelled).items()}
    got = {
        (r["var3"], r["node"]): (r["samples"], r["high_count"], r["feature"], r["split_value"])
        for r in grown.nodes().collect()
    }
    assert got == want


def test_children_sum_to_their_parent(grown):
    nodes = {(r["var3"], r["node"]): r for r in grown.nodes().collect()}
    for (var3, node), r in nodes.items():
        assert r["samples"] >= 10
        if not r["is_leaf"]:
            left, right = nodes[(var3, 2 * node)], nodes[(var3, 2 * node + 1)]
            assert left["samples"] + right["samples"] == r["samples"]
            assert left["high_count"] + right["high_count"] == r["high_count"]
            assert r["gain"] > 0


def test_importance_sums_to_one(grown):
    total = defaultdict(float)
    for r in grown.importance().collect():
        total[r["var3"]] += r["importance"]
    assert total == {"big": pytest.approx(1, abs=1e-5), "mid": pytest.approx(1, abs=1e-5)}
    assert grown.importance(top=3).count() == 6


def test_rules_describe_leaves(grown):
    leaves = {(r["var3"], r["samples"], r["high_count"]) for r in grown.leaf_counts().collect()}
    rules = grown.rules(keep=None).collect()
    assert rules
    for r in rules:
        assert (r["var3"], r["samples"], r["high_count"]) in leaves
        assert r["high_pct"] > 60 if r["type"] == "GOOD" else r["high_pct"] < 40
        assert r["low_count"] == r["samples"] - r["high_count"]
        assert 1 <= r["rule"].count(" IN (") <= 4


def test_equal_revenue_gives_a_root_and_no_rules(spark):
    rows = [(str(i), "v", *[f"x{i % 3}"] * 6, Decimal(5), START) for i in range(60)]
    one = SegmentTrees(spark.createDataFrame(rows, SCHEMA))
    (root,) = one.nodes().collect()
    assert (root["node"], root["samples"], root["is_leaf"]) == (1, 60, True)
    assert one.rules().count() == 0
    assert one.importance().agg(F.sum("importance")).first()[0] == 0


def test_rule_text_lists_three_values_of_the_campaign(spark):
    # The first five of eight values earn little; codes 0-4 go left, 5-7 right.
    rows = []
    for i in range(160):
        value = f"a{i % 8}"
        rows.append((str(i), "v", value, *["x"] * 5, Decimal(1 if value < "a5" else 9), START))
    got = {r["type"]: r["rule"] for r in SegmentTrees(spark.createDataFrame(rows, SCHEMA)).rules().collect()}
    assert got == {
        "GOOD": "country_code IN (a5, a6, a7)",
        "BAD": "country_code IN (a0, a1, a2...)",
    }


def test_hard_floor(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    assert {r[0] for r in tree.segment_cells(frame).select("var3").distinct().collect()} == {"big", "mid"}
    small = tree.segment_cells(frame, min_samples=1, var3="small")
    assert small.agg(F.sum("n")).first()[0] == 49
    few = spark.createDataFrame(rows[:29], SCHEMA)
    assert tree.segment_cells(few, min_samples=1).count() == 0


def test_cross_validation(spark, rows):
    got = {r["var3"]: r for r in tree.tree_cv_accuracy(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {"big", "mid"}
    assert all(r["folds"] == 5 for r in got.values())
    # The labels lean on the features, so a tree must beat guessing; it is the same every time.
    assert 0.6 < got["big"]["cv_accuracy"] <= 1


def test_labels_and_codes(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    labels = tree.high_revenue_label(frame).groupBy("var3").agg(F.avg("high_revenue").alias("a"))
    assert all(0.3 < r["a"] <= 0.5 for r in labels.collect())
    codes = defaultdict(list)
    for r in tree.label_encode(frame).collect():
        codes[(r["var3"], r["feature"])].append((r["code"], r["value"]))
    for pairs in codes.values():
        ordered = sorted(pairs)
        assert [c for c, _ in ordered] == list(range(len(pairs)))
        assert [v for _, v in ordered] == sorted(v for _, v in pairs)
