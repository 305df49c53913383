"""Centroid clustering of integer vectors, exact, with heaps of bounds that say which vectors to look at.

Method: a vector is scanned against all centroids once; the gap between its nearest and its second
nearest distance says how far centroids may move before its cluster can change. A cluster keeps its
vectors in the order of ``gap + what the cluster had drifted when the vector was scanned``. In a round a
cluster's drift grows by its own centroid's step and the longest step of another one; the vectors
whose key the drift has passed are popped, scanned again and pushed with a new key. The others cannot
have changed, and are not looked at.

A heap is a set of written segments, one a round, each sorted by (cluster, key). Popping is a range
read of each cluster's keys between the drift of the last round and the present one; it reaches the
scan, which skips what lies outside. Segments are never rewritten: an entry below the last round's
drift has been popped before. Losing an executor costs no more than a task's part of the round.

Sums of clusters are kept by what popped vectors add and take away. All arithmetic on vectors and
centroids is in integers; only bounds are floating point, with a margin above their rounding.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.runtime import cut

#: Largest component; squared distances of 64 such components fit into a long.
LARGEST = 1 << 27
#: Products of components up to this one are exact in double precision, sums of 64 of them included.
SMALL = 1 << 23
#: Above the rounding of distances and drifts (distances stay below 2^31).
MARGIN = 1e-4
#: Vectors scanned at once.
ROWS = 8192

_ENTRY = "cluster int, key double, id long, vector array<int>, n long, sums array<long>"


@dataclass
class State:
    """The centroids so far, how far each cluster has drifted after each round, and the heaps' segments."""

    centroids: list[list[int]]
    sums: list[list[int]]
    counts: list[int]
    drift: list[list[float]]
    segments: list[DataFrame] = field(default_factory=list)


def usable(vector: Column, size: int) -> Column:
    """Exactly ``size`` components, none NULL, infinite or not a number."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == size) & ~odd, F.lit(False))


def quantised(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component; one beyond ``LARGEST`` is an error, not a wrong distance."""
    def whole(x: Column) -> Column:
        value = F.floor(x.cast("double") * scale)
        fits = F.abs(x.cast("double") * scale) <= LARGEST
        return F.when(fits, value).otherwise(F.raise_error(F.lit("a component is too large for exact distances"))).cast("int")

    return F.transform(vector, whole)


def _squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all vectors to all centroids, as integers."""
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if largest <= SMALL:
        a, b = vectors.astype(np.float64), centroids.astype(np.float64)
        cross = (a @ b.T).astype(np.int64)
        return (vectors * vectors).sum(1)[:, None] + (centroids * centroids).sum(1)[None, :] - 2 * cross
    found = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        gap = vectors - c
        found[:, j] = (gap * gap).sum(1)
    return found


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _vectors(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel().astype(np.int32)))


def _scanned(state: State, first: bool):
    """Popped entries scanned against all centroids: new entries, and a row of changed sums per cluster."""
    centroids, drift = state.centroids, state.drift[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.array(centroids, np.int64)
        size, offset = middle.shape[1], np.array(drift)
        sums, counts = np.zeros(middle.shape, np.int64), np.zeros(len(middle), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                vectors = _matrix(batch.column("vector"), size)
                far = _squares(vectors, middle)
                own = far.argmin(1)  # the first of equals is the smaller number
                near = np.sqrt(far[np.arange(len(far)), own].astype(np.float64))
                far[np.arange(len(far)), own] = np.iinfo(np.int64).max
                gap = np.sqrt(far.min(1).astype(np.float64)) - near if len(middle) > 1 else np.full(len(far), np.inf)
                before = None if first else batch.column("cluster").to_numpy()
                moved = np.arange(len(own)) if first else np.flatnonzero(before != own)
                for j in np.union1d(own[moved], [] if first else before[moved]).astype(int):
                    come, gone = moved[own[moved] == j], moved[:0] if first else moved[before[moved] == j]
                    sums[j] += vectors[come].sum(0) - vectors[gone].sum(0)
                    counts[j] += len(come) - len(gone)
                nothing = pa.nulls(len(own))
                yield pa.record_batch(
                    {
                        "cluster": own.astype(np.int32), "key": gap + offset[own], "id": batch.column("id"), "vector": _vectors(vectors),
                        "n": nothing.cast(pa.int64()), "sums": nothing.cast(pa.list_(pa.int64())),
                    }
                )
        changed = np.flatnonzero((counts != 0) | (sums != 0).any(1))
        none = pa.nulls(len(changed))
        yield pa.record_batch(
            {
                "cluster": changed.astype(np.int32), "key": none.cast(pa.float64()), "id": none.cast(pa.int64()),
                "vector": none.cast(pa.list_(pa.int32())), "n": counts[changed], "sums": pa.array(sums[changed].tolist(), pa.list_(pa.int64())),
            }
        )

    return run


def _bounded(segment: DataFrame, above: list[float] | None, upto: list[float] | None) -> DataFrame:
    """The entries of each cluster's keys in a range."""
    held = segment.where("key is not null")
    cases = []
    for j in range(len(above or upto)):
        case = F.col("cluster") == j
        if above is not None:
            case &= F.col("key") > above[j]
        if upto is not None:
            case &= F.col("key") <= upto[j]
        cases.append(case)
    while len(cases) > 1:
        cases = [cases[i] | cases[i + 1] if i + 1 < len(cases) else cases[i] for i in range(0, len(cases), 2)]
    return held.where(cases[0]).select("cluster", "id", "vector")


def _limits(state: State, round_: int) -> list[float]:
    return [d + MARGIN for d in state.drift[round_]]


def _popped(state: State) -> DataFrame:
    """The entries that the drift of the present round has passed, and that of the last has not."""
    now = len(state.drift) - 1
    parts = [
        _bounded(s, _limits(state, now - 1) if now - 1 > pushed else None, _limits(state, now)) for pushed, s in enumerate(state.segments)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _push(state: State, entries: DataFrame, first: bool) -> None:
    """Scan ``entries``, write them as a segment in heap order, and take what they change in the sums."""
    segment = cut(entries.mapInArrow(_scanned(state, first), _ENTRY).sortWithinPartitions("cluster", "key"))
    state.segments.append(segment)
    changed = segment.where("n is not null")
    total = (
        changed.select("cluster", F.posexplode("sums").alias("i", "x")).groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
        .unionByName(changed.groupBy("cluster").agg(F.sum("n").cast("decimal(38,0)").alias("x")).select("cluster", F.lit(-1).alias("i"), "x"))
    )
    for cluster, i, x in total.collect():  # a number for each cluster and component
        if i < 0:
            state.counts[cluster] += int(x)
        else:
            state.sums[cluster][i] += int(x)


def _moved(state: State) -> None:
    """The next centroids: the floor of each non-empty cluster's mean; and the drift up to them."""
    after = [[s // n for s in sums] if n else old for old, sums, n in zip(state.centroids, state.sums, state.counts, strict=True)]
    steps = [math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))) for x, y in zip(state.centroids, after, strict=True)]
    order = sorted(range(len(steps)), key=lambda j: -steps[j])
    most = [steps[order[1 if j == order[0] else 0]] if len(steps) > 1 else 0.0 for j in range(len(steps))]
    state.drift.append([d + s + m for d, s, m in zip(state.drift[-1], steps, most, strict=True)])
    state.centroids = after


def fit(vectors: DataFrame, start: list[list[int]], rounds: int) -> State:
    """``rounds`` of assigning and moving on ``vectors(id, vector)``; ``start``: the first centroids, at least one."""
    size = len(start[0])
    state = State(start, [[0] * size for _ in start], [0] * len(start), [[0.0] * len(start)])
    for r in range(rounds):
        _push(state, vectors if r == 0 else _popped(state), first=r == 0)
        _moved(state)
    return state


def _placed(state: State, scan: bool):
    """Each entry's cluster and squared distance; ``scan``: to all centroids, else to its own."""
    centroids = state.centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.array(centroids, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                vectors = _matrix(batch.column("vector"), middle.shape[1])
                if scan:
                    far = _squares(vectors, middle)
                    own = far.argmin(1)
                    distance = far[np.arange(len(far)), own]
                else:
                    own = batch.column("cluster").to_numpy()
                    gap = vectors - middle[own]
                    distance = (gap * gap).sum(1)
                yield pa.record_batch({"id": batch.column("id"), "cluster": own.astype(np.int32), "distance": distance})

    return run


def assigned(state: State, vectors: DataFrame) -> DataFrame:
    """``(id, cluster, distance)`` of every vector by the final centroids; only expired entries are scanned."""
    schema = "id long, cluster int, distance long"
    if not state.segments:
        return vectors.mapInArrow(_placed(state, True), schema)
    now = len(state.drift) - 1
    out = _popped(state).mapInArrow(_placed(state, True), schema)
    for segment in state.segments:
        out = out.unionByName(_bounded(segment, _limits(state, now), None).mapInArrow(_placed(state, False), schema))
    return out


def cluster(vectors: DataFrame, order: Column, count: int, rounds: int, size: int = 64, scale: int = 256) -> tuple[DataFrame, State | None]:
    """``(id, cluster, distance)`` of every usable row of ``vectors(id, vector)``, and the fitted state.

    Usable are vectors of ``size`` components, none NULL, infinite or not a number; others give no row.
    Components become ``floor(scale * x)``. The first centroids are the ``count`` usable vectors that come first by ``order``
    (ties by the vector); fewer vectors give fewer centroids. After ``rounds`` of assigning to the
    nearest centroid (ties: the smaller number) and moving each non-empty cluster's centroid to the
    floor of its mean, vectors are assigned once more. Repeated rows and equal vectors are rows of their
    own. No usable vector gives no rows and no state. Columns beside ``id`` and ``vector`` are not looked at.
    A component beyond 2^27 after scaling is an error.
    """
    kept = vectors.where(usable(F.col("vector"), size)).select(
        F.col("id").cast("long").alias("id"), quantised(F.col("vector"), scale).alias("vector")
    )
    start = [list(r.vector) for r in kept.orderBy(order, "vector").limit(count).collect()]
    if not start:
        return kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), None
    state = fit(kept, start, rounds)
    return assigned(state, kept), state


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
