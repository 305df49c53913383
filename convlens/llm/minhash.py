"""Near duplicates by MinHash with tensored banding: candidates from table keys, links from full sets.

Method: instead of one collection of minhashes for every table, there are two small ones. A text has
``PARTS`` left and ``PARTS`` right parts of ``WIDTH`` minhashes each, and a table's key is a left part with a right
part: ``PARTS ** 2`` tables from ``2 * PARTS * WIDTH`` minhashes. Two texts of similarity ``s`` meet in a table unless
they differ in all left or in all right parts, which has a probability below ``2 * (1 - s ** WIDTH) ** PARTS``: 7e-6
at 0.8, 4e-8 at 0.85. Pairs below that similarity meet seldom, and are told apart by their full sets.

How the work is spread:

1. Each text's shingle set gives its parts and a 128-bit name; equal sets are one node.
2. Left parts are counted first. Only nodes that share one are written to tables, with all right parts,
   so a text without any near copy costs ``PARTS`` rows and not ``PARTS ** 2``.
3. All nodes of a table's key join the group of the smallest. Nodes of a group meet in blocks of at most
   ``BLOCK`` nodes, which compare full sets; a larger group is dealt into blocks twice, its smallest node in each.
   Where it is not one component then, its nodes outside the largest component meet all its blocks. So
   every two nodes that share a key are compared, but for those in one component anyway.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.components import components
from convlens.llm.jaccard import shingle_sets
from convlens.llm.text import LOWER, chunks, distinct, mix, raw, translated, words
from convlens.runtime import cut

#: Minhashes of a part, and parts of either side.
WIDTH, PARTS = 4, 24
#: Nodes that are compared in one block.
BLOCK = 192
#: Up to this many bytes, the list of texts to read again is sent to all tasks; beyond it is joined.
LIST_BYTES = 32 << 20

_SIGNED = "doc_id long, th long, n int, node binary, left array<long>, right array<long>"
_SETS = "node binary, n int, grams binary"
#: An odd multiplier and an offset for each minhash.
_SEEDS = mix(np.arange(1, 2 * 2 * PARTS * WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TIMES, _PLUS = _SEEDS[::2] | np.uint64(1), _SEEDS[1::2]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The left and right parts of non-empty sets of 64-bit hashes, a row each."""
    grams = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    found = np.empty((len(sets), 2 * PARTS), np.uint64)
    turned = np.empty_like(grams)
    for part in range(2 * PARTS):
        value = np.full(len(sets), part, np.uint64)
        for i in range(part * WIDTH, (part + 1) * WIDTH):
            np.bitwise_xor(grams, _PLUS[i], out=turned)
            np.multiply(turned, _TIMES[i], out=turned)
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(turned, starts))
        found[:, part] = value
    return found


def _sets_of(chunk: pa.RecordBatch, size: int) -> list[np.ndarray]:
    data, bounds = raw(chunk.column("text"))
    return shingle_sets(words(translated(data, LOWER), bounds), size)


def _lists(values: np.ndarray, held: np.ndarray) -> pa.Array:
    """Rows of ``values`` as lists, NULL where nothing is ``held``."""
    offsets = np.concatenate([[0], np.cumsum(np.where(held, values.shape[1], 0))]).astype(np.int32)
    flat = pa.array(values.ravel().view(np.int64))
    return pa.ListArray.from_arrays(offsets, flat, mask=pa.array(~held))


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            sets = _sets_of(chunk, size)
            held = np.array([len(s) > 0 for s in sets], bool)
            parts = signatures([s for s in sets if len(s)]) if held.any() else np.empty((0, 2 * PARTS), np.uint64)
            yield pa.record_batch(
                {
                    "doc_id": chunk.column("doc_id"), "th": chunk.column("th"), "n": pa.array([len(s) for s in sets], pa.int32()),
                    "node": pa.array([xxhash.xxh128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    "left": _lists(np.ascontiguousarray(parts[:, :PARTS]), held), "right": _lists(np.ascontiguousarray(parts[:, PARTS:]), held),
                }
            )

    return run


def _written(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            sets = _sets_of(chunk, size)
            yield pa.record_batch(
                {
                    "node": pa.array([xxhash.xxh128_digest(s) for s in sets], pa.binary()), "n": pa.array([len(s) for s in sets], pa.int32()),
                    "grams": pa.array([s.tobytes() for s in sets], pa.binary()),
                }
            )

    return run


def block_links(ids: list[int], grams: list[np.ndarray], roots: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect what is similar among the given sets: a star for each component.

    Equal ``roots`` are known to be connected. Sizes bound a pair's similarity, so sets are met in the
    order of their size, and each only those that are not too large for it.
    """
    sizes = np.array([len(g) for g in grams])
    order = np.argsort(sizes, kind="stable")
    sizes, grams = sizes[order], [grams[i] for i in order]
    ids, roots = [ids[i] for i in order], [roots[i] for i in order]
    first_of: dict[int, int] = {}
    root = np.array([first_of.setdefault(r, i) for i, r in enumerate(roots)])
    every, starts = np.concatenate(grams), np.concatenate([[0], np.cumsum(sizes)])
    ordered = np.sort(every)
    shared = ordered[1:][ordered[1:] == ordered[:-1]]
    shared = shared[distinct(shared)]
    code = np.searchsorted(shared, every)  # grams of one set only get a code that is never marked
    code = np.where((code < len(shared)) & (shared[np.minimum(code, max(len(shared) - 1, 0))] == every), code, len(shared)) if len(shared) else np.zeros(len(every), np.int64)
    marked = np.zeros(len(shared) + 1, np.int64)
    for i in range(len(ids) - 1):
        last = int(np.searchsorted(sizes * num, sizes[i] * den, "right"))  # beyond it sets are too large
        if last <= i + 1 or (root[i + 1 : last] == root[i]).all():
            continue
        own = code[starts[i] : starts[i + 1]]
        marked[own] = 1
        marked[len(shared)] = 0
        overlap = np.add.reduceat(marked[code[starts[i + 1] : starts[last]]], starts[i + 1 : last] - starts[i + 1])
        marked[own] = 0
        for j in np.flatnonzero((num + den) * overlap >= num * (sizes[i] + sizes[i + 1 : last])) + i + 1:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
    least: dict[int, int] = {}
    for x, r in zip(ids, root.tolist(), strict=True):
        least[r] = min(least.get(r, x), x)
    return [(x, least[r]) for x, r in zip(ids, root.tolist(), strict=True) if least[r] != x]


def _links(blocks: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links found in each of the ``blocks(anchor, piece, nid, root)``."""

    def links(table: pa.Table) -> pa.Table:
        grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
        found = block_links(table.column("nid").to_pylist(), grams, table.column("root").to_pylist(), num, den)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return blocks.join(sets, "nid").groupBy("anchor", "piece").applyInArrow(links, "a long, b long")


def _keys(nodes: DataFrame) -> DataFrame:
    """``(key, nid)``: the tables' keys of the nodes that share a left part with another node."""
    parts = nodes.select("nid", F.posexplode("left").alias("i", "part"))
    often = parts.groupBy("i", "part").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    met = cut(parts.join(often, ["i", "part"]))
    tables = met.join(nodes.select("nid", "right"), "nid").select("nid", "i", "part", F.posexplode("right").alias("j", "other"))
    return tables.select(F.xxhash64("i", "part", "j", "other").alias("key"), "nid")


def _dealt(seed: int, pieces: str) -> Column:
    return F.pmod(F.xxhash64("nid", F.lit(seed)), F.col(pieces)).cast("int")


def _pieces(count: str) -> Column:
    return F.ceil(F.col(count) / BLOCK).cast("int")


def _first_blocks(groups: DataFrame) -> DataFrame:
    """Whole groups, and larger ones dealt twice by different hashes, with the smallest node in every block."""
    sizes = groups.groupBy("anchor").agg(F.count("*").alias("c")).withColumn("pieces", _pieces("c"))
    twice = F.array(_dealt(1, "pieces"), F.col("pieces") + _dealt(2, "pieces"))
    members = groups.join(sizes, "anchor").select(
        "anchor", F.explode(F.when(F.col("pieces") > 1, twice).otherwise(F.array(F.lit(0)))).alias("piece"), "nid"
    )
    count = F.when(F.col("pieces") > 1, 2 * F.col("pieces")).otherwise(1)
    anchors = sizes.select("anchor", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"), F.col("anchor").alias("nid"))
    return members.unionByName(anchors).withColumn("root", F.col("nid"))


def _other_blocks(groups: DataFrame, known: DataFrame) -> DataFrame:
    """Of larger groups that are not one component: the nodes outside the largest one, with each block of the group."""
    large = groups.groupBy("anchor").agg(F.count("*").alias("c")).where(f"c > {BLOCK}").select("anchor")
    members = groups.join(large, "anchor").unionByName(large.select("anchor", F.col("anchor").alias("nid")))
    placed = cut(
        members.join(known.withColumnRenamed("node", "nid"), "nid", "left").select("anchor", "nid", F.coalesce("root", "nid").alias("root"))
    )
    torn = (
        placed.groupBy("anchor", "root").agg(F.count("*").alias("c"))
        .groupBy("anchor")
        .agg(F.max_by("root", F.struct("c", "root")).alias("major"), F.sum("c").alias("all"), F.max("c").alias("most"))
        .where("most < all")
        .select("anchor", "major", _pieces("all").alias("pieces"), F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("parts"))
    )
    held = placed.join(torn, "anchor").withColumns({"piece": _dealt(1, "pieces"), "part": _dealt(3, "parts")})
    whole = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    minor = held.where("root <> major").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    block = (F.col("part").cast("long") * F.col("pieces") + F.col("piece")).alias("piece")
    return whole.unionByName(minor).select("anchor", block, "nid", "root").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row of ``docs(doc_id, text)``.

    Texts are lower-cased (A-Z) and cut into words; the set holds the distinct ``size``-word shingles, or
    the whole sequence if there are fewer words. Two texts link when ``den * intersection >= num * union``; the
    component's id is its smallest ``doc_id``, and ``kept`` marks the rows that have it.

    Whole texts are read, however long. A text that is NULL or has no words links with nothing and is its own component. A NULL ``doc_id`` is never a
    component's id unless no other is in it, and is not ``kept`` beside others. Repeated rows give a row each. An empty
    table gives no rows. Other columns are not looked at, whatever their names.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim = slim.withColumn("th", F.xxhash64("text"))
    signed = cut(slim.mapInArrow(_signed(size), _SIGNED))
    known = signed.where("node is not null")
    nodes = cut(known.select("node", "left", "right").dropDuplicates(["node"]).withColumn("nid", F.monotonically_increasing_id()))
    keys = cut(_keys(nodes).distinct())
    leaders = keys.groupBy("key").agg(F.min("nid").alias("anchor"), F.count("*").alias("c")).where("c > 1").drop("c")
    groups = cut(keys.join(leaders, "key").where("nid <> anchor").select("anchor", "nid").distinct())

    alive = groups.select("nid").unionByName(groups.select(F.col("anchor").alias("nid"))).distinct()
    named = cut(nodes.select("nid", "node").join(alive, "nid"))
    readers = cut(known.join(named, "node").groupBy("nid", "node").agg(F.min(F.struct("th", "doc_id")).alias("r")).select("r.th", "r.doc_id"))
    listed = F.broadcast(readers) if readers.count() * 16 <= LIST_BYTES else readers
    again = slim.alias("s").join(listed.alias("r"), F.expr("s.th = r.th and s.doc_id <=> r.doc_id"), "left_semi")
    sets = cut(again.mapInArrow(_written(size), _SETS).dropDuplicates(["node"]).join(named, "node").select("nid", "grams"))

    links = cut(_links(_first_blocks(groups), sets, num, den))
    others = cut(_other_blocks(groups, components(links)))
    final = components(links.unionByName(_links(others, sets, num, den)))

    least = known.groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = (
        least.join(named, "node", "left")
        .join(final.withColumnRenamed("node", "nid"), "nid", "left")
        .withColumn("class", F.coalesce(F.col("root").cast("string"), F.hex("node")))
    )
    labels = rooted.select("node", "class").join(rooted.groupBy("class").agg(F.min("least").alias("component_id")), "class")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.join(labels.select("node", "component_id"), "node", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )
