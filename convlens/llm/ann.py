"""Approximate nearest neighbours by inner product, with learned partitions.

Method: a bounded sample of the vectors is joined into a neighbour graph, the graph is cut into parts
of equal size along few edges, and a small softmax classifier learns to tell the parts apart. Every
vector is filed under its most probable part; a query goes to its several most probable parts, where
all vectors are compared with it exactly. How many parts a query needs is read off the sample, whose
neighbours are known.

A sample of bounded size tells a bounded number of parts apart. A part that is still too large is cut
once more in the same way: tasks learn a router from a sample of that part alone, which files its vectors
under parts of the part and sends on the queries that came to it, level by level. A part so stays near
``PART_ROWS`` vectors however many there are.

Parts need not come out even: a part's vectors and queries are dealt into blocks of bounded size, and
every block of vectors meets every block of queries of its part. Equal vectors are searched once, and
of those that equal each other only the smallest ids can be among the nearest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.runtime import cut

#: Vectors that the parts are learned from, at most; which ones is decided by a hash of their id.
SAMPLE = 4096
#: Neighbours of a vector in the graph.
DEGREE = 10
#: Vectors that a part should hold; one router tells at most ``SAMPLE / 16`` parts apart.
PART_ROWS = 1500
#: Parts with more distinct vectors than so many times ``PART_ROWS`` get a router of their own.
OVERSIZE = 4
#: Share of the sample's neighbours that the visited parts must hold.
RECALL = 0.98
#: Vectors and queries that meet in one block.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024


def usable(vector: Column) -> Column:
    """Neither NULL nor zero nor with a component that is NULL, infinite or not a number."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbours(vectors: np.ndarray, count: int) -> np.ndarray:
    """The places of each vector's nearest others, block by block."""
    count = min(count, len(vectors) - 1)
    found = np.empty((len(vectors), max(count, 0)), np.int64)
    for i in range(0, len(vectors), 512):
        near = vectors[i : i + 512] @ vectors.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -np.inf
        found[i : i + 512] = np.argpartition(-near, max(count - 1, 0), axis=1)[:, :count]
    return found


def _halves(nodes: np.ndarray, graph: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of a subgraph along few edges: the order of the graph's slowest vibration, cut in
    the middle, then pairs of nodes that cut fewer edges on the other side are exchanged."""
    place = np.full(len(graph), -1)
    place[nodes] = np.arange(len(nodes))
    to = place[graph[nodes]]
    a, b = np.nonzero(to >= 0)
    ends = np.concatenate([np.stack([a, to[a, b]]), np.stack([to[a, b], a])], axis=1)
    degree = np.bincount(ends[0], minlength=len(nodes)) + 1e-9
    pull = lambda x: np.bincount(ends[0], x[ends[1]], minlength=len(nodes))
    x = rng.standard_normal(len(nodes))
    for _ in range(60):
        x = 0.5 * x + 0.5 * pull(x) / degree
        x -= (x * degree).sum() / degree.sum()
        x /= np.abs(x).max() + 1e-300
    side = np.zeros(len(nodes), bool)
    side[np.argsort(x, kind="stable")[len(nodes) // 2 :]] = True
    for _ in range(10):
        over = pull(side.astype(float))
        gain = np.where(side, degree - 2 * over, 2 * over - degree)  # edges saved by a change of side
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left = left[np.argsort(-gain[left], kind="stable")]
        right = right[np.argsort(-gain[right], kind="stable")]
        short = min(len(left), len(right), max(1, len(nodes) // 20))
        swap = np.flatnonzero(gain[left[:short]] + gain[right[:short]] > 1e-6)
        if not len(swap):
            break
        side[left[swap]], side[right[swap]] = True, False
    return nodes[~side], nodes[side]


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """A part for each node: halves of halves, so that parts differ by one node at most per level."""
    rng = np.random.default_rng(11)
    groups = [np.arange(len(graph))]
    while len(groups) < parts:
        groups = [half for g in groups for half in _halves(g, graph, rng)]
    label = np.empty(len(graph), np.int64)
    for i, g in enumerate(groups):
        label[g] = i
    return label


@dataclass
class Router:
    """The classifier: a vector's score for part ``j`` is ``vector @ weights[:, j] + bias[j]``."""

    weights: np.ndarray
    bias: np.ndarray
    visits: int

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """The parts of each vector, the most probable first."""
        return np.argsort(-(vectors @ self.weights + self.bias), axis=1, kind="stable")


def learn(vectors: np.ndarray, parts: int) -> Router:
    """Partition the neighbour graph of a sample and learn to route to its parts."""
    size = vectors.shape[1]
    if parts < 2:
        return Router(np.zeros((size, 1)), np.zeros(1), 1)
    graph = neighbours(vectors, DEGREE)
    label = balanced_parts(graph, parts)
    scale = 1 / np.sqrt((vectors**2).sum(1).mean())
    inputs = vectors * scale
    target = np.eye(parts)[label]
    weights, bias = np.zeros((size, parts)), np.zeros(parts)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    for step in range(1, 151):
        logits = inputs @ weights + bias
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        error = (chance - target) / len(inputs)
        for value, slope, k in ((weights, inputs.T @ error + 1e-5 * weights, 0), (bias, error.sum(0), 2)):
            moments[k] = 0.9 * moments[k] + 0.1 * slope
            moments[k + 1] = 0.99 * moments[k + 1] + 0.01 * slope**2
            value -= 0.2 * (moments[k] / (1 - 0.9**step)) / (np.sqrt(moments[k + 1] / (1 - 0.99**step)) + 1e-8)
    router = Router(weights * scale, bias, 1)
    order = router.order(vectors)
    rank = np.argsort(order, axis=1)  # when each part is visited
    home = order[:, 0]
    needed = np.sort(rank[np.repeat(np.arange(len(graph)), graph.shape[1]), home[graph].ravel()])
    router.visits = min(parts, int(needed[int(RECALL * (len(needed) - 1))]) + 1)
    return router


FILED = "part long, id long, vector binary, lead boolean"


def _routed(router: Router, visits: int, above: int, fan: int, vectors: np.ndarray, ids: pa.Array, lead: pa.Array) -> dict[str, pa.Array]:
    """Rows under their ``visits`` most probable parts of the part ``above``; a part's number holds its parents' in base ``fan``."""
    order = router.order(vectors)[:, :visits]
    rows = pa.array(np.repeat(np.arange(len(vectors)), order.shape[1]))
    return {
        "part": pa.array(above * fan + order.ravel(), pa.int64()),
        "id": ids.take(rows),
        "vector": pa.array([v.tobytes() for v in vectors], pa.binary()).take(rows),
        "lead": lead.take(rows),
    }


def _filed(router: Router, visits: int, fan: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                vectors = flat.reshape(batch.num_rows, -1)
                yield pa.record_batch(_routed(router, visits, 1, fan, vectors, batch.column("id"), batch.column("lead")))

    return run


def _vectors(table: pa.Table) -> np.ndarray:
    return np.stack([np.frombuffer(v) for v in table.column("vector").to_pylist()])


def _learned(part_rows: int):
    """The router of one part, from its sample, as a row."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        vectors = _vectors(table)
        router = learn(vectors, part_count(table.column("leads")[0].as_py(), len(vectors), part_rows))
        row = {"part": table.column("part")[0].as_py(), "weights": router.weights.tobytes(), "bias": router.bias.tobytes(), "visits": router.visits}
        return pa.Table.from_pylist([row], pa.schema({"part": pa.int64(), "weights": pa.binary(), "bias": pa.binary(), "visits": pa.int32()}))

    return run


def _refiled(fan: int, every_visit: bool):
    """Rows of one part under the parts that its own router tells apart."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left.select(["part", "id", "vector", "lead"])
        vectors, own = _vectors(left), right.to_pylist()[0]
        router = Router(np.frombuffer(own["weights"]).reshape(vectors.shape[1], -1), np.frombuffer(own["bias"]), own["visits"])
        columns = [left.column(name).combine_chunks() for name in ("id", "lead")]
        return pa.table(_routed(router, router.visits if every_visit else 1, own["part"], fan, vectors, *columns))

    return run


def _split(filed: DataFrame, routers: DataFrame, fan: int, every_visit: bool) -> DataFrame:
    """Rows of parts that have a router go one level down, in deals of bounded size; the others stay as they are."""
    deals = cut(
        filed.join(routers.select("part"), "part", "left_semi").groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("deals"))
    )
    left = filed.join(deals, "part").withColumn("deal", F.pmod(F.xxhash64("id"), F.col("deals")).cast("int")).drop("deals")
    right = routers.join(deals, "part").withColumn("deal", F.explode(F.expr("sequence(0, deals - 1)"))).drop("deals")
    down = left.groupBy("part", "deal").cogroup(right.groupBy("part", "deal")).applyInArrow(_refiled(fan, every_visit), FILED)
    return cut(filed.join(deals, "part", "left_anti").unionByName(down))


def _deepened(filed: DataFrame, sent: DataFrame, fan: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors, queries and ``(part, own)`` after parts that are too large were split, level by level. The levels end
    where a part's number would no longer fit a long; blocks keep even such a part in bounded pieces."""
    while True:
        sizes = cut(filed.groupBy("part").agg(F.count("*").alias("own"), F.count_if("lead").alias("leads")))
        large = cut(sizes.where((F.col("leads") > OVERSIZE * PART_ROWS) & (F.col("part") < 2**62 // fan)).select("part", "leads"))
        if not large.limit(1).count():
            return filed, sent, sizes.select("part", "own")
        order = Window.partitionBy("part").orderBy(F.xxhash64("id"), "id")
        sample = filed.where("lead").join(large, "part").withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= SAMPLE)
        routers = cut(sample.groupBy("part").applyInArrow(_learned(PART_ROWS), "part long, weights binary, bias binary, visits int"))
        filed, sent = _split(filed, routers, fan, False), _split(sent, routers, fan, True)


def _dealt(filed: DataFrame, blocks: DataFrame, own: str, limit: int, others: str, other_limit: int, by: str, across: str) -> DataFrame:
    """Rows in blocks of about ``limit``, once for each block of the other side; parts that lack the other side meet nothing."""
    placed = filed.join(blocks, "part").withColumn(by, F.pmod(F.xxhash64("id"), F.ceil(F.col(own) / limit)).cast("int"))
    times = F.sequence(F.lit(0), (F.ceil(F.col(others) / other_limit) - 1).cast("int"))
    return placed.withColumn(across, F.explode(times)).select("part", "id", "vector", by, across)


BEST = "query long, ids array<long>, scores array<double>"


def _best(k: int):
    """Each query's best of a block, by score and then by id, as one row."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "ids": [], "scores": []}
        if left.num_rows and right.num_rows:
            ids = right.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            vectors, queries = _vectors(right)[order], _vectors(left)
            near = queries @ vectors.T
            count = min(k, len(ids))
            least = np.partition(near, len(ids) - count, axis=1)[:, len(ids) - count]
            for query, own, row, edge in zip(left.column("id").to_pylist(), queries, near, least):
                at = np.flatnonzero(row >= edge - 1e-9 * max(1.0, abs(edge)))
                score = (vectors[at] * own).sum(axis=1)  # alike for equal vectors, wherever they stand
                best = np.lexsort((ids[at], -score))[:count]
                out["query"].append(query)
                out["ids"].append(ids[at[best]])
                out["scores"].append(score[best])
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
        return pa.table({name: pa.array(own, kind) for (name, own), kind in zip(out.items(), kinds)})

    return run


def _merged(k: int):
    """A query's best of all its blocks, which are few: its parts, times the blocks of a part."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("ids").combine_chunks().flatten().to_numpy()
        scores = table.column("scores").combine_chunks().flatten().to_numpy()
        best = np.lexsort((ids, -scores))[:k]
        return pa.table({"query": pa.array([table.column("query")[0].as_py()] * len(best), pa.int64()), "id": ids[best], "score": scores[best]})

    return run


def part_count(total: int, sampled: int, part_rows: int) -> int:
    """Parts, a power of two, for so many vectors: as many as make them hold ``part_rows``, or as the sample can tell apart."""
    parts = 1
    while parts * 2 * part_rows <= total * 1.5 and parts * 2 * 16 <= sampled:
        parts *= 2
    return parts


def fit(vectors: DataFrame) -> Router:
    """A router for ``vectors(id, vector)``, learned from at most ``SAMPLE`` of them on the driver."""
    total = vectors.count()
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    sample = np.array([r["vector"] for r in rows], np.float64)
    return learn(sample, part_count(total, len(rows), PART_ROWS)) if len(rows) else Router(np.zeros((1, 1)), np.zeros(1), 1)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, router: Router | None = None) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest found of each query among all other rows.

    ``vectors(id, vector)``; ``is_query`` is a condition on ``id``. Nearness is the inner product in
    double precision, ties go to the smaller id. Rows without an id, vectors that are not ``usable``
    and vectors that are not as long as most take no part; rows repeated with id and vector count
    once. No usable vectors give no rows. ``router``: by default learned from these vectors, equal ones
    taken once. Other columns are not looked at.
    """
    clean = vectors.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    clean = cut(clean.where("id is not null").where(usable(F.col("vector"))))
    length = clean.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    clean = clean.where(F.size("vector") == (length[0]["n"] if length else 0))
    first = Window.partitionBy("vector").orderBy("id")
    # Of equal vectors, only the k + 1 smallest ids can be among a query's k nearest besides itself.
    fronts = cut(clean.distinct().withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= k + 1))
    router = router or fit(fronts.where("rn = 1"))
    asks = cut(clean.where(is_query).distinct())
    speakers = asks.groupBy("vector").agg(F.min("id").alias("id"))
    fan = max(SAMPLE // 16, len(router.bias), 2)
    filed = cut(fronts.select("id", "vector", (F.col("rn") == 1).alias("lead")).mapInArrow(_filed(router, 1, fan), FILED))
    sent = cut(speakers.select("id", "vector", F.lit(True).alias("lead")).mapInArrow(_filed(router, router.visits, fan), FILED))
    filed, sent, sizes = _deepened(filed, sent, fan)
    blocks = cut(sizes.join(sent.groupBy("part").agg(F.count("*").alias("asked")), "part"))
    left = _dealt(sent, blocks, "asked", BLOCK_QUERIES, "own", BLOCK_ROWS, "q", "c")
    right = _dealt(filed, blocks, "own", BLOCK_ROWS, "asked", BLOCK_QUERIES, "c", "q")
    pairs = left.groupBy("part", "q", "c").cogroup(right.groupBy("part", "q", "c")).applyInArrow(_best(k + 1), BEST)
    found = pairs.groupBy("query").applyInArrow(_merged(k + 1), "query long, id long, score double")
    spoken = asks.join(speakers.withColumnRenamed("id", "query"), "vector").select(F.col("id").alias("query_id"), "query")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    every = spoken.join(found, "query").where("query_id <> id").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return every.select("query_id", "rank", "id", "score")
