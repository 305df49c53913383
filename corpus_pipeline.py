"""A training corpus from ``documents``, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.llm import bpe, jaccard, mixing, quality
from convlens.llm.queries import MIX_LIMIT, MIX_SHARE, SOURCE_WEIGHTS, importable, tokenizer_path
from convlens.runtime import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rule or a learned rule rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return jaccard.keep_one(docs, size=5, num=80, den=100)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them: not at all, once or twice."""
    mixed = mixing.mix(docs, F.array("source"), SOURCE_WEIGHTS, MIX_SHARE, MIX_LIMIT)
    return mixing.repeated(mixed, docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document that is left, for training."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), tokenizer_path())
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("encoding", encoding),
]

#: SQL cannot express the learned rules, the join by similarity, the draw or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is written and read again as the next one's documents."""
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
