from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from convlens.llm import clusters, queries
from tests.llm import plain


def by_hash(i):
    return hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()


def test_query_on_the_small_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op12_centroids(spark, sf)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain.clustered(rows, by_hash, 40, 5, 64, 256)


def run(spark, rows, count, rounds, size, scale):
    frame = spark.createDataFrame(rows, "id long, vector array<double>").withColumns({c: F.lit(1) for c in ("cluster", "key", "n")}).repartition(5)
    order = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    found, state = clusters.cluster(frame, order, count, rounds, size, scale)
    return sorted(tuple(r) for r in found.select(F.coalesce("id", F.lit(-1)), "cluster", "distance").collect()), state


@pytest.mark.parametrize("scale", [4, 1 << 24])
def test_rounds_ties_and_copies(spark, scale):
    """Coarse grids tie often; a third of the rows are one vector; large components need exact products."""
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((9, 4)) * 2
    vectors = (centres[draw.integers(0, 9, 700)] + draw.standard_normal((700, 4)) * 0.6).round(1)
    vectors[::3] = vectors[0]
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    expected = plain.clustered(rows, by_hash, 12, 5, 4, scale)
    got, state = run(spark, rows, 12, 5, 4, scale)
    assert got == sorted(r[:3] for r in expected)
    pushed = [s.where("n is null").count() for s in state.segments]
    assert pushed[0] == 700 and sum(pushed[1:]) < 4 * 700  # the heaps spare vectors
    assert sum(state.counts) == 700


def test_only_expired_entries_are_read(spark):
    """Clusters far apart settle, and nothing is popped from then on; the range reaches the scan."""
    draw = np.random.default_rng(6)
    vectors = np.repeat(np.eye(4) * 100, 50, axis=0) + draw.standard_normal((200, 4))
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    got, state = run(spark, rows, 4, 5, 4, 256)
    assert got == sorted(r[:3] for r in plain.clustered(rows, by_hash, 4, 5, 4, 256))
    assert state.segments[-1].where("n is null").count() < 200
    plan = clusters._popped(state)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(key" in plan and "LessThanOrEqual(key" in plan


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -0.1]), (4, None), (5, [1.0]), (6, [1.0, None]),
        (7, [math.nan, 1.0]), (8, [math.inf, 1.0]), (9, []), (10, [0.0, 0.0]),
    ]
    got, state = run(spark, rows, 40, 5, 2, 10)
    assert got == sorted((-1 if r[0] is None else r[0], *r[1:3]) for r in plain.clustered(rows, by_hash, 40, 5, 2, 10))
    assert len(state.centroids) == 4


def test_no_vectors(spark):
    assert run(spark, [(1, [1.0])], 3, 2, 2, 10) == ([], None)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e30, 1.0])], 1, 1, 2, 256)
