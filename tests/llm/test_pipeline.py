from __future__ import annotations

import corpus_pipeline
from convlens.llm import quality
from convlens.llm.queries import tokenizer_path
from convlens.runtime import scratch
from tests.llm import plain


def test_stages_follow_each_other(spark, sf):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.schema.simpleString()
    before = {r.doc_id: r for r in docs.collect()}
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, f"test-{name}")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        results[name] = docs.collect()
        if name != "encoding":
            assert docs.schema.simpleString() == columns
            assert all(before[r.doc_id] == r for r in results[name])
    good = results["quality_rules"]
    judged = {r.doc_id: r.kept for r in quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert sorted(r.doc_id for r in good) == sorted(i for i, kept in judged.items() if kept)
    expected = plain.classes([(r.doc_id, r.text) for r in good], 5, 80, 100)
    assert sorted(r.doc_id for r in results["near_duplicates"]) == sorted({c for _, _, c in expected})
    uses = {}
    for r in results["source_mix"]:
        uses[r.doc_id] = uses.get(r.doc_id, 0) + 1
    assert max(uses.values()) <= 2 and set(uses) <= {r.doc_id for r in results["near_duplicates"]}
    coded = results["encoding"]
    assert sorted(r.doc_id for r in coded) == sorted(r.doc_id for r in results["source_mix"])
    for r in coded:
        assert list(r.ids) == library.encode(before[r.doc_id].text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run_returns_the_last_stage(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids"] and got.count() > 0


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = scratch(spark, "test-empty")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
