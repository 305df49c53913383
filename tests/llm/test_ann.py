from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from convlens.llm import ann
from convlens.llm.queries import op10_nearest


def exact(ids, vectors, query, k):
    score = (vectors * vectors[query]).sum(1)
    order = [i for i in np.lexsort((ids, -score)) if i != query][:k]
    return [(int(ids[i]), score[i]) for i in order]


def answers(rows):
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(r[0], []).append((r[2], r[3]))
    return out


def clustered(count, seed=1, size=32):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, size)) * 0.6
    return centres[rng.integers(0, 12, count)] + rng.standard_normal((count, size)) * 0.3


def test_query_on_the_small_table_is_exact(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = answers(op10_nearest(spark, sf).collect())
    assert sorted(got) == sorted(ids[ids % 20 == 0].tolist())
    for query, found in got.items():
        expected = exact(ids, vectors, int(np.flatnonzero(ids == query)[0]), 20)
        assert [i for i, _ in found] == [i for i, _ in expected]
        assert [s for _, s in found] == pytest.approx([s for _, s in expected], abs=1e-12)


def test_recall_through_learned_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 200)
    monkeypatch.setattr(ann, "SAMPLE", 1024)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 256)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 16)
    vectors = clustered(4000)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>")
    router = ann.fit(frame)
    assert router.weights.shape[1] == 16 and router.visits < 16
    got = answers(ann.nearest(frame, F.pmod("id", F.lit(20)) == 0, 20, router).collect())
    ids = np.arange(len(vectors))
    hits = sum(len({i for i, _ in found} & {i for i, _ in exact(ids, vectors, q, 20)}) for q, found in got.items())
    assert len(got) == 200 and hits >= 0.9 * 20 * 200


def test_recall_through_parts_of_parts(spark, monkeypatch):
    """One router tells too few parts apart: every part is cut again by its own, and queries visit few of all parts."""
    for name, value in (("SAMPLE", 512), ("PART_ROWS", 60), ("OVERSIZE", 2), ("BLOCK_ROWS", 256), ("BLOCK_QUERIES", 64)):
        monkeypatch.setattr(ann, name, value)
    vectors = clustered(16000, 5)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>")
    seen = {}
    deepen = ann._deepened

    def watched(*args):
        seen["before"], (filed, sent, sizes) = args[0], deepen(*args)
        seen["sizes"], seen["sent"] = [r.own for r in sizes.collect()], sent.count()
        seen["work"] = sent.groupBy("part").count().join(sizes, "part").selectExpr("sum(count * own) AS n").first().n
        return filed, sent, sizes

    monkeypatch.setattr(ann, "_deepened", watched)
    is_query = F.pmod("id", F.lit(40)) == 0
    got = answers(ann.nearest(frame, is_query, 10).collect())
    assert seen["before"].select("part").distinct().count() <= 32 < len(seen["sizes"])
    assert sum(seen["sizes"]) == 16000 and max(seen["sizes"]) <= 500
    assert seen["work"] < 0.5 * 400 * 16000  # vectors compared, of all pairs of a query and a vector
    ids = np.arange(len(vectors))
    hits = sum(len({i for i, _ in found} & {i for i, _ in exact(ids, vectors, q, 10)}) for q, found in got.items())
    assert len(got) == 400 and hits >= 0.9 * 10 * 400


def test_parts_are_balanced_and_cut_few_edges():
    vectors = clustered(1024, 3)
    graph = ann.neighbours(vectors, 10)
    label = ann.balanced_parts(graph, 8)
    assert np.ptp(np.bincount(label)) <= 3
    assert (label[graph] == label[:, None]).mean() > 0.5


def test_ties_copies_and_odd_vectors(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(i, one) for i in range(200)] + [(200, two), (240, [0.5, 0.5, 0.0]), (240, [0.5, 0.5, 0.0])]
    rows += [(300, None), (320, [0.0, 0.0, 0.0]), (340, [1.0, None, 0.0]), (360, [float("nan"), 1.0, 0.0])]
    rows += [(380, [float("inf"), 1.0, 0.0]), (None, one), (400, [1.0, 0.0]), (420, [])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    got = answers(ann.nearest(frame, F.pmod("id", F.lit(20)) == 0, 5).collect())
    assert sorted(got) == [*range(0, 201, 20), 240]
    assert got[0] == [(i, 1.0) for i in range(1, 6)]
    assert got[100] == [(i, 1.0) for i in range(5)]
    assert got[240] == [(i, 0.5) for i in range(5)]
    assert got[200] == [(240, 0.5), (0, 0.0), (1, 0.0), (2, 0.0), (3, 0.0)]


def test_few_or_no_vectors(spark):
    schema = "id long, vector array<float>"
    assert ann.nearest(spark.createDataFrame([], schema), F.col("id") >= 0).count() == 0
    assert ann.nearest(spark.createDataFrame([(0, [1.0])], schema), F.col("id") >= 0).count() == 0
    got = ann.nearest(spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema), F.col("id") >= 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 2.0), (1, 1, 0, 2.0)]


def test_copies_do_not_loosen_the_search(spark):
    """95 % of the rows are copies of a few vectors: parts and visits are learned from the others all the same."""
    own, times = clustered(4000, seed=3), 25_000
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(own)], "id long, vector array<double>")
    copies = frame.where("id < 3").selectExpr(f"explode(sequence(4000 + id * {times}, 3999 + (id + 1) * {times})) AS id", "vector")
    queries = range(0, 4000, 40)
    got = answers(ann.nearest(frame.unionByName(copies), F.col("id").isin(list(queries)), 10).collect())
    distinct = np.concatenate([own, own[:3].repeat(11, axis=0)])
    ids = np.concatenate([np.arange(4000), *(np.arange(11) + 4000 + i * times for i in range(3))])
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in exact(ids, distinct, q, 10)}) for q in queries)
    assert found >= 0.9 * 10 * len(queries)
