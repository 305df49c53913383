from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from convlens.llm import quality
from convlens.llm.queries import op9_quality_rules
from tests.llm import plain


def test_counts_of_documents_and_odd_texts(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts = [*docs, *((-1 - i, t) for i, t in enumerate(plain.ODD_TEXTS)), (-50, "a b c d e a b c d e"), (-51, "a a a a a a")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in quality.COUNTS) for r in quality.statistics(frame).collect()}
    for doc, text in texts:
        assert got[doc] == plain.quality_counts(text), text


#: Large enough for labels of both kinds to learn from and to hold back (some fifty bad ones).
LABELLED = "/root/testdata/sf0.01"


def test_query_rejects_the_bad_and_keeps_the_good(spark):
    sf = LABELLED
    got = {r.doc_id: r for r in op9_quality_rules(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null").collect()
    good = [got[r.doc_id].kept for r in labels if r.quality == 1 and r.doc_id in got and not got[r.doc_id].base_failed]
    bad = [got[r.doc_id].kept for r in labels if r.quality == 0 and r.doc_id in got]
    assert np.mean(good) > 0.97
    assert np.mean(bad) < 0.3
    for r in got.values():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rules_generalise_to_rows_they_have_not_seen():
    rng = np.random.default_rng(1)
    values = {name: rng.random(4000) for name in quality.RATIOS}
    bad = (values["symbol_share"] > 0.7) & (values["mean_word"] < 0.5) | (values["repeat_share"] > 0.95)
    rules = quality.learn({k: v[:2000] for k, v in values.items()}, bad[:2000], rng.random(2000))
    said = np.zeros(2000, bool)
    for rule in rules:
        said |= quality._covered(rule, {k: v[2000:] for k, v in values.items()})
    assert (said == bad[2000:]).mean() > 0.97
    assert len(rules) <= 4


def test_noise_gives_no_rules():
    rng = np.random.default_rng(2)
    values = {name: rng.random(600) for name in quality.RATIOS}
    assert quality.learn(values, rng.random(600) < 0.1, rng.random(600)) == []
    assert quality.learn(values, np.zeros(600, bool), rng.random(600)) == []
    nothing = {name: np.zeros(0) for name in quality.RATIOS}
    assert quality.learn(nothing, np.zeros(0, bool), np.zeros(0)) == []


def test_verdict_is_one_expression_that_agrees_with_the_rules(spark):
    rules = [(quality.Condition("symbol_share", True, 0.25),), (quality.Condition("n_words", False, 20.0), quality.Condition("mean_word", True, 6.5))]
    rows = [(30, 150, 10, 0, 0), (30, 150, 2, 0, 0), (15, 120, 0, 0, 0), (15, 60, 0, 0, 0), (5, 20, 0, 0, 0), (0, 0, 0, 0, 0)]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in quality.COUNTS))
    assert [r[0] for r in frame.select(quality.verdict(rules)).collect()] == [False, True, False, True, False, False]


def test_stage_keeps_rows_as_they_are(spark):
    text = "this is a perfectly ordinary sentence with more than ten words in it"
    rows = [(i, t, 1.5) for i, t in enumerate([*plain.ODD_TEXTS, text, text])] + [(None, text, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    expected = [r for r in rows if (c := plain.quality_counts(r[1]))[0] >= 10 and 100 * c[4] <= 20 * c[0]]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(expected, key=str)
    assert quality.keep_good(docs.where(F.lit(False)), labels).count() == 0


def test_labels_with_gaps(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 0), (2, None), (77, 0)], "doc_id long, quality int")
    assert quality.learned_rules(docs, labels) == []
    assert quality.judge(docs, labels).count() == 3
