from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from convlens.llm import oracle, sharding
from convlens.llm.queries import op5_sharding
from tests.compare import differences, duck


def split(rows: list[tuple[int, int]], limit: int, depth: int = 0) -> dict[str, int]:
    """Shards of (hash, bytes) by halving what is too large."""
    total = sum(b for _, b in rows)
    if total <= limit or len(rows) == 1 or depth == sharding.KEY_BITS:
        return {format(rows[0][0], "060b")[:depth]: total} if rows else {}
    halves: list[list] = [[], []]
    for h, b in rows:
        halves[h >> (sharding.HASH_BITS - depth - 1) & 1].append((h, b))
    return split(halves[0], limit, depth + 1) | split(halves[1], limit, depth + 1)


def test_agrees_with_halving(spark):
    rows = [(f"k{i}", 1 + i * i % 97) for i in range(3000)]
    docs = spark.createDataFrame(rows, "key string, size long").repartition(3)
    hashed = [(int(hashlib.md5(k.encode()).hexdigest()[:10], 16) << 20, b) for k, b in rows]
    for limit in (50, 1000, 10**9):
        got = sharding.shard(docs, "key", F.col("size"), limit).collect()
        assert {r.shard: r.shard_bytes for r in got} == split(hashed, limit)
        assert all(r.shard_depth == len(r.shard) for r in got)


def test_a_key_with_a_third_of_all_rows_is_split(spark):
    rows = [("hot", 100)] * 500 + [(f"k{i}", 100) for i in range(1000)] + [(None, None), ("", 5000)]
    got = sharding.shard(spark.createDataFrame(rows, "key string, size long"), "key", F.col("size"), 1000).collect()
    assert len(got) == len(rows)
    sums: dict[str, list] = {}
    for r in got:
        sums.setdefault(r.shard, []).append(r)
    for own in sums.values():
        total = sum(r.size or 0 for r in own)
        assert {r.shard_bytes for r in own} == {total}
        assert total <= 1000 or len(own) == 1
    ordered = sorted(sums)
    assert all(not b.startswith(a) for a, b in zip(ordered, ordered[1:]))  # no shard is within another


def test_a_key_with_more_rows_than_the_hash_tells_apart(spark, monkeypatch):
    """With four bits for a row, the hash ends at sixteen buckets a key; the digest's further bits split them."""
    monkeypatch.setattr(sharding, "KEY_BITS", 56)
    rows = [("hot", 100)] * 2000 + [("warm", 50)] * 300 + [(f"k{i}", 10) for i in range(50)]
    docs = spark.createDataFrame(rows, "key string, size long").repartition(2)
    got = sharding.shard(docs, "key", F.col("size"), 600).collect()
    assert len(got) == len(rows) and max(r.shard_depth for r in got) > sharding.HASH_BITS
    assert all(r.shard_depth == len(r.shard) for r in got)
    sums: dict[str, int] = {}
    for r in got:
        sums[r.shard] = sums.get(r.shard, 0) + r.size
    assert max(sums.values()) <= 600 and all(sums[r.shard] == r.shard_bytes for r in got)
    ordered = sorted(sums)
    assert all(not b.startswith(a) for a, b in zip(ordered, ordered[1:]))


def test_query_agrees_with_sql_and_stays_native(spark, sf, monkeypatch):
    frame = op5_sharding(spark, sf)
    assert differences(frame, duck(sf).sql(oracle.sharding())) == []
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_small_limit_agrees_with_sql(spark, sf, monkeypatch):
    monkeypatch.setattr(oracle, "SHARD_BYTES", 9000)
    monkeypatch.setattr("convlens.llm.queries.SHARD_BYTES", 9000)
    assert differences(op5_sharding(spark, sf), duck(sf).sql(oracle.sharding())) == []


def test_empty_table_and_clashing_names(spark):
    docs = spark.createDataFrame([("a", 1, "x", 7)], "key string, bytes long, shard string, cell int")
    (row,) = sharding.shard(docs, "key", F.col("bytes"), 10).collect()
    assert (row.key, row.bytes, row.cell, row.shard, row.shard_depth, row.shard_bytes) == ("a", 1, 7, "", 0, 1)
    assert sharding.shard(docs.where("bytes > 1"), "key", F.col("bytes"), 10).count() == 0
