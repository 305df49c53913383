"""The operators as registered queries over their whole tables."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.llm import ann, bpe, clusters, html, jaccard, licenses, lm, minhash, mixing, oracle, quality, sharding, turns, urls
from convlens.runtime import cut

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of the URL filter.
URL_RULES = [
    urls.Rule("org/", urls.ALLOW),
    urls.Rule("example.org/es/", urls.BLOCK),
    urls.Rule("example.org/en/1", urls.BLOCK),
    urls.Rule("com/fr/", urls.ALLOW),
    urls.Rule("com/de/", urls.BLOCK),
]
#: Weights of the sources in code point order, repeating; words wanted; how often a source may be used.
SOURCE_WEIGHTS, MIX_SHARE, MIX_LIMIT = [5.0, 2.0, 1.0], 1.5, 2
#: Bytes of a shard.
SHARD_BYTES = oracle.SHARD_BYTES
#: Centroids and rounds of the clustering, and what is hashed with an id to choose the first centroids.
CENTROIDS, ROUNDS, SEED = 40, 5, 2


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver did, if it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed package of public vocabularies keeps a file."""
    return importlib.import_module("public_tokenizers").path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "digest", "license", F.array_join("notices", ",").alias("notices"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(_table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, F.array("source"), SOURCE_WEIGHTS, MIX_SHARE, MIX_LIMIT)
    sources = spark.createDataFrame(
        [(s, size, float(target)) for s, (size, target) in mixed.sources.items()], "name string, source_size long, target double"
    )
    rows = mixed.documents.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("name")))
    return rows.select(
        "doc_id", F.col("_mix_size").alias("size"), "source_size", "target",
        (F.col("_mix_size") * F.col("_mix_copies")).cast("long").alias("taken"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("n_bytes"))
    return sharding.shard(docs, "doc_id", F.col("n_bytes"), SHARD_BYTES).select(
        "doc_id", F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"), "shard", F.col("shard_depth").cast("long").alias("shard_depth"), "shard_bytes"
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_classes(_table(spark, sf_dir, "documents"), size=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = ann.nearest(vectors, F.pmod("id", F.lit(20)) == 0, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = turns.ordered(_table(spark, sf_dir, "conversations"))
    base, head = F.expr("conv_id - conv_id % 5"), F.expr("crc32(cast(cast(conv_id as string) as binary)) % 9")
    trie = turns.prefix_trie(*turns.spliced(places, base, head))
    rows = trie.nodes.join(turns.end_digests(trie.ends), ["k1", "k2"], "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(turns.NOTHING)).alias("ends_sha256"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    first = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    found, state = clusters.cluster(vectors, first, CENTROIDS, ROUNDS)
    found = cut(found)
    sums = {r.cluster: int(r.x) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}
    about = spark.createDataFrame(
        [(j, x, sum(sums.values()), clusters.centroid_digest(state.centroids[j])) for j, x in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(about), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=2, num=80, den=100)


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_url_filter": op2_url_filter,
    "op3_lm_scores": op3_lm_scores,
    "op4_source_mix": op4_source_mix,
    "op5_sharding": op5_sharding,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_html_text": op7_html_text,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_nearest": op10_nearest,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_centroids": op12_centroids,
    "op13_minhash_dedup": op13_minhash_dedup,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": oracle.license_scan(),
    "op5_sharding": oracle.sharding(),
    "op11_prefix_trie": oracle.prefix_trie(),
    "op12_centroids": oracle.centroids(CENTROIDS, ROUNDS, SEED),
}
