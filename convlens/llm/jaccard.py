"""N-gram Jaccard join: texts whose sets of word n-grams are nearly equal, and their classes.

Method: a prefix-tree join. Sets are written in one order of their n-grams and stored in a trie; a
probe walks the trie, carries the overlap of the shared path, and leaves a subtree as soon as what is
left of both sides cannot reach the overlap that the similarity asks for.

How the work is cut so that no set meets all others, and no link is lost:

1. **Counting.** Each task turns its texts into sets and sends every n-gram once per chunk of text to
   the segment of its hash. A segment finds the n-grams that occur in two or more texts. Linked sets
   share ``num/den`` of the larger one, so a text fewer of whose n-grams occur elsewhere has no
   partner; this drops texts that merely share a passage. Equal sets are one node from here on.
2. **Postings.** Of the nodes left, n-grams are ordered rare first. Two linked nodes share an n-gram
   among the first ``n - ceil(n * num/den) + 1`` of each (prefix filter).
3. **Tries.** All nodes that share a prefix n-gram join the group of the smallest one. A group that
   fits into one trie is joined whole. A larger one is dealt into pieces of bounded size, twice by
   different hashes, each piece with the group's smallest node.
4. **The rest.** Where a larger group is not in one component by then, its nodes outside the largest
   component meet all pieces of the group, in blocks. So every pair that shares a prefix n-gram meets
   in a trie, but for pairs that are in one component anyway.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.components import components
from convlens.llm.text import LOWER, Words, chunks, distinct, raw, translated, windows, words
from convlens.runtime import cut

#: Bytes of text that one counting segment stands for, which bounds what a task counts at once.
SEGMENT_BYTES = 12 << 20
#: Nodes that one trie holds.
TRIE_NODES = 256
#: Up to this many bytes, the list of texts to read again is sent to all tasks; beyond it is joined.
LIST_BYTES = 32 << 20
#: Owner of an n-gram that two texts of one chunk share.
SEVERAL = 0xFFFF

MARKED = "doc_id long, n int, shared int, node binary, th long"


def shingle_sets(found: Words, size: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; a shorter text's words are one n-gram."""
    hashes = found.hashes()
    runs = windows(hashes, size)
    sets = []
    for a, b in zip(found.starts[:-1].tolist(), found.starts[1:].tolist(), strict=True):
        if b - a >= size:
            ordered = np.sort(runs[a : b - size + 1])
            sets.append(ordered[distinct(ordered)])
        else:
            sets.append(windows(hashes[a:b], b - a) if b > a else hashes[:0])
    return sets


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _count_chunks(size: int, segments: int):
    """Per chunk of text: its distinct n-grams by segment, and one row about its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, chunk in enumerate(chunks(batches)):
            data, bounds = raw(chunk.column("text"))
            sets = shingle_sets(words(translated(data, LOWER), bounds), size)
            sizes = np.fromiter(map(len, sets), np.int32, len(sets))
            grams = np.concatenate(sets)
            order = np.argsort(grams)
            grams = grams[order]
            owners = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)[order]
            first = np.flatnonzero(distinct(grams))
            times = np.diff(np.append(first, len(grams)))
            several = times > 1
            shared = np.bincount(owners[np.repeat(several, times)], minlength=len(sets))
            block = part << 24 | number
            about = pa.record_batch(
                {
                    "doc_id": chunk.column("doc_id"),
                    "n": sizes,
                    "shared": shared.astype(np.int32),
                    "node": pa.array([xxhash.xxh128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    "th": chunk.column("th"),
                }
            )
            owner = np.where(several, SEVERAL, owners[first]).astype(np.uint64)
            sent = (grams[first] << np.uint64(16)) | owner
            segment = ((grams[first] >> np.uint64(40)) * np.uint64(segments)) >> np.uint64(24)
            cuts = np.append(np.flatnonzero(distinct(segment)), len(sent)) if len(sent) else np.zeros(1, int)
            yield pa.record_batch(
                {
                    "segment": pa.array([*segment[cuts[:-1]].tolist(), block % segments], pa.int32()),
                    "block": pa.array([block] * len(cuts), pa.int64()),
                    "grams": pa.array([*(sent[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])), None], pa.binary()),
                    "about": pa.array([*[None] * (len(cuts) - 1), _packed(about)], pa.binary()),
                }
            )

    return run


def _shared_of_segment(table: pa.Table) -> pa.Table:
    """The owners, by block, of the n-grams that several blocks of this segment hold."""
    blocks, owners, about = [], [], []
    place = table.column("block").to_numpy()
    grams = table.column("grams").to_pylist()
    for block, text in zip(place.tolist(), table.column("about").to_pylist()):
        if text is not None:
            blocks.append(block), owners.append(None), about.append(text)
    parts = [(b, np.frombuffer(g, np.uint64)) for b, g in zip(place.tolist(), grams) if g is not None]
    if parts:
        sent = np.concatenate([g for _, g in parts])
        order = np.argsort(sent)
        gram = sent[order] >> np.uint64(16)
        first = distinct(gram)
        start = np.flatnonzero(first)
        times = np.diff(np.append(start, len(gram)))
        hit = np.zeros(len(sent), bool)
        hit[order] = np.repeat(times > 1, times)
        at = 0
        for block, own in parts:
            owner = (own & np.uint64(0xFFFF)).astype(np.uint16)
            found = owner[hit[at : at + len(own)] & (owner != SEVERAL)]
            at += len(own)
            if len(found):
                blocks.append(block), owners.append(np.sort(found).tobytes()), about.append(None)
    return pa.table(
        {"block": pa.array(blocks, pa.int64()), "owners": pa.array(owners, pa.binary()), "about": pa.array(about, pa.binary())}
    )


def _texts_of_block(table: pa.Table) -> pa.Table:
    """The rows of one block, with the number of each text's n-grams that other texts hold too."""
    texts = next(x for x in table.column("about").to_pylist() if x is not None)
    about = pa.ipc.open_stream(texts).read_all()
    shared = about.column("shared").to_numpy().astype(np.int64)
    for owners in table.column("owners").to_pylist():
        if owners is not None:
            shared = shared + np.bincount(np.frombuffer(owners, np.uint16), minlength=len(shared))
    return about.set_column(2, "shared", pa.array(shared, pa.int32())).cast(
        pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("shared", pa.int32()), ("node", pa.binary()), ("th", pa.int64())])
    )


def _node_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            sets = shingle_sets(words(*_lowered(chunk)), size)
            yield pa.record_batch(
                {
                    "node": pa.array([xxhash.xxh128_digest(s) for s in sets], pa.binary()),
                    "n": pa.array([len(s) for s in sets], pa.int32()),
                    "grams": pa.array([s.tobytes() for s in sets], pa.binary()),
                }
            )

    return run


def _lowered(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = raw(chunk.column("text"))
    return translated(data, LOWER), bounds


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node and n-gram."""
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            grams = [np.frombuffer(g, np.int64) for g in part.column("grams").to_pylist()]
            sizes = [len(g) for g in grams]
            yield pa.record_batch(
                {
                    "nid": np.repeat(part.column("nid").to_numpy(), sizes),
                    "n": np.repeat(part.column("n").to_numpy(), sizes),
                    "gram": np.concatenate(grams),
                }
            )


class Trie:
    """A compressed trie of the sets of one group, in the order in which a walk meets its edges."""

    def __init__(self, sequences: list[np.ndarray], sizes: list[int]):
        """``sequences``: sorted ranks, in lexicographic order; ``sizes``: of the whole sets."""
        count = len(sequences)
        common = [0] * (count + 1)  # ranks that a sequence and the one before it begin with
        for i in range(1, count):
            a, b = sequences[i - 1], sequences[i]
            short = min(len(a), len(b))
            unlike = np.flatnonzero(a[:short] != b[:short])
            common[i] = int(unlike[0]) if len(unlike) else short
        self.parent, self.leaves, self.low, self.after, self.skip = [], [], [], [], []
        self.smallest, self.rest, pieces, last = [], [], [], []
        todo = [(0, count, 0, -1)] if count else []
        while todo:
            lo, hi, depth, parent = todo.pop()
            end = min(common[lo + 1 : hi], default=len(sequences[lo]))
            here = len(self.parent)
            self.parent.append(parent)
            self.low.append(lo)
            self.after.append(hi)
            self.leaves.append([i for i in range(lo, hi) if len(sequences[i]) == end])
            self.smallest.append(min(sizes[lo:hi]))
            self.rest.append(max(len(s) for s in sequences[lo:hi]) - end)
            pieces.append(sequences[lo][depth:end])
            last.append(sequences[lo][end - 1] if end else -1)
            begin = [lo, *(i for i in range(lo + 1, hi) if common[i] == end), hi]
            if len(sequences[lo]) == end:  # the sets that end here come first
                begin = begin[len(self.leaves[-1]) :]
            todo += [(a, b, end, here) for a, b in zip(begin[:-1], begin[1:])][::-1]
        self.skip = [0] * len(self.parent)
        for i in range(len(self.parent) - 1, -1, -1):
            self.skip[i] = max(self.skip[i], i + 1)
            if self.parent[i] >= 0:
                self.skip[self.parent[i]] = max(self.skip[self.parent[i]], self.skip[i])
        self.ranks = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        self.last = np.array(last, np.int64)

    def walk(self, probe: int, ranks: np.ndarray, size: int, held: np.ndarray, num: int, den: int) -> Iterator[int]:
        """The sequences after ``probe`` whose similarity to it is at least ``num/den``."""
        held[ranks] = 1
        before = np.concatenate([[0], np.cumsum(held[self.ranks], dtype=np.int64)])
        held[ranks] = 0
        gain = (before[self.bounds[1:]] - before[self.bounds[:-1]]).tolist()
        left = (len(ranks) - np.searchsorted(ranks, self.last, "right")).tolist()
        overlap = [0] * len(gain)
        i = 0
        while i < len(gain):
            here = gain[i] + (overlap[self.parent[i]] if i else 0)
            reach = here + min(left[i], self.rest[i])
            if self.after[i] <= probe + 1 or (num + den) * reach < num * (size + self.smallest[i]):
                i = self.skip[i]
                continue
            overlap[i] = here
            for leaf in self.leaves[i]:
                if leaf > probe:
                    yield leaf, here
            i += 1


def trie_links(
    ids: list[int], sizes: list[int], grams: list[np.ndarray], num: int, den: int, roots: list[int] | None = None
) -> list[tuple[int, int]]:
    """Links that connect what is similar among the given sets: a star for each component.

    ``roots``: what is known of their components; equal roots need no link.
    """
    every = np.concatenate(grams)
    ordered = np.sort(every)
    first = np.flatnonzero(distinct(ordered))
    times = np.diff(np.append(first, len(ordered)))
    kept, times = ordered[first][times > 1], times[times > 1]  # the others are in no overlap here
    rank = np.empty(len(kept), np.int64)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(kept))
    sequences = []
    for own in grams:
        at = np.searchsorted(kept, own)
        at = at[(at < len(kept)) & (kept[np.minimum(at, max(len(kept) - 1, 0))] == own)] if len(kept) else at[:0]
        sequences.append(np.sort(rank[at]))
    order = sorted(range(len(ids)), key=lambda i: sequences[i].astype(">u4").tobytes())
    sequences = [sequences[i] for i in order]
    ids, sizes = [ids[i] for i in order], [sizes[i] for i in order]
    known = ids if roots is None else [roots[i] for i in order]
    trie = Trie(sequences, sizes)
    held = np.zeros(max(len(kept), 1), np.int8)
    first_of: dict[int, int] = {}
    root = [first_of.setdefault(r, i) for i, r in enumerate(known)]
    parts = len(first_of)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, ranks in enumerate(sequences):
        if parts == 1:
            break
        for j, overlap in trie.walk(i, ranks, sizes[i], held, num, den):
            if (num + den) * overlap >= num * (sizes[i] + sizes[j]) and find(i) != find(j):
                root[find(j)] = find(i)
                parts -= 1
    least: dict[int, int] = {}
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, x), x)
    return [(x, least[find(i)]) for i, x in enumerate(ids) if least[find(i)] != x]


def _links(blocks: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links found by a trie for each of the ``blocks(anchor, piece, nid, root)``."""

    def links(table: pa.Table) -> pa.Table:
        ids, sizes, roots = (table.column(c).to_pylist() for c in ("nid", "n", "root"))
        grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
        found = trie_links(ids, sizes, grams, num, den, roots)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    held = blocks.join(sets, "nid").select("anchor", "piece", "nid", "root", "n", "grams")
    return held.groupBy("anchor", "piece").applyInArrow(links, "a long, b long")


def _pieces(count: str) -> Column:
    return F.ceil(F.col(count) / TRIE_NODES).cast("int")


def _dealt(seed: int, pieces: str) -> Column:
    return F.pmod(F.xxhash64("nid", F.lit(seed)), F.col(pieces)).cast("int")


def _first_blocks(groups: DataFrame) -> DataFrame:
    """Whole groups, and larger ones dealt twice, with the anchor in every piece."""
    sizes = groups.groupBy("anchor").agg(F.count("*").alias("c")).withColumn("pieces", _pieces("c"))
    deals = F.when(F.col("pieces") > 1, F.array(_dealt(1, "pieces"), F.col("pieces") + _dealt(2, "pieces")))
    members = groups.join(sizes, "anchor").select("anchor", F.explode(F.coalesce(deals, F.array(F.lit(0)))).alias("piece"), "nid")
    last = F.when(F.col("pieces") > 1, 2 * F.col("pieces") - 1).otherwise(0)
    anchors = sizes.select("anchor", F.explode(F.sequence(F.lit(0), last)).alias("piece"), F.col("anchor").alias("nid"))
    return members.unionByName(anchors).withColumn("root", F.col("nid"))


def _other_blocks(groups: DataFrame, known: DataFrame) -> DataFrame:
    """Of larger groups that are not in one component: the nodes outside the largest one, with each piece."""
    every = groups.unionByName(groups.select("anchor", F.col("anchor").alias("nid")).distinct())
    placed = every.join(known.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    torn = (
        placed.groupBy("anchor", "root").agg(F.count("*").alias("c"))
        .groupBy("anchor")
        .agg(F.max_by("root", F.struct("c", "root")).alias("major"), F.sum("c").alias("all"), F.max("c").alias("most"))
        .where(f"all > {TRIE_NODES} and most < all")
        .select("anchor", "major", _pieces("all").alias("pieces"), F.ceil((F.col("all") - F.col("most")) / TRIE_NODES).cast("int").alias("parts"))
    )
    held = placed.join(torn, "anchor").withColumns({"piece": _dealt(1, "pieces"), "part": _dealt(3, "parts")})
    whole = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    minor = held.where("root <> major").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    block = (F.col("part").cast("long") * F.col("pieces") + F.col("piece")).alias("piece")
    return whole.unionByName(minor).select("anchor", block, "nid", "root").distinct()


def similar_classes(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id, th)`` of every row of ``docs(doc_id, text)``.

    Texts are lower-cased (A-Z) and cut into words; the set holds the distinct ``size``-word
    shingles, or the whole sequence if there are fewer words. Two texts link when
    ``den * intersection >= num * union``; the component's id is its smallest ``doc_id``.

    A text that is NULL or has no words has an empty set, links with nothing and is its own
    component. ``th`` is ``xxhash64`` of the text. A NULL ``doc_id`` is never a component's id, unless no other is in it. Repeated rows
    give a row each. An empty table gives no rows. Other columns are not looked at.

    ``docs`` is read twice and should come from files or a written table: chunks are known by their
    place in the input.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(1, min(total // SEGMENT_BYTES, 1 << 23))
    slim = slim.withColumn("th", F.xxhash64("text"))
    marked = cut(
        slim.mapInArrow(_count_chunks(size, segments), "segment int, block long, grams binary, about binary")
        .groupBy("segment")
        .applyInArrow(_shared_of_segment, "block long, owners binary, about binary")
        .groupBy("block")
        .applyInArrow(_texts_of_block, MARKED)
    )
    alive = marked.where(F.expr(f"n > 0 and cast(shared as long) * {den} >= cast(n as long) * {num}"))
    readers = cut(alive.groupBy("node").agg(F.min(F.struct("th", "doc_id")).alias("r")).select("r.th", "r.doc_id"))
    if readers.count() * 16 <= LIST_BYTES:
        readers = F.broadcast(readers)
    again = slim.alias("s").join(readers.alias("r"), F.expr("s.th = r.th and s.doc_id <=> r.doc_id"), "left_semi")
    sets = cut(
        again.mapInArrow(_node_sets(size), "node binary, n int, grams binary")
        .dropDuplicates(["node"])
        .withColumn("nid", F.monotonically_increasing_id())
    )
    slim_sets = sets.select("nid", "n", "grams")
    grams = slim_sets.mapInArrow(_gram_rows, "nid long, n int, gram long")
    often = grams.groupBy("gram").agg(F.count("*").alias("times")).where("times > 1")
    need = f"cast(ceil(n * {num}L / {den}) as int)"
    postings = cut(
        grams.join(often, "gram")
        .groupBy("nid", "n")
        .agg(F.sort_array(F.collect_list(F.struct("times", "gram"))).alias("held"))
        .where(f"size(held) >= {need}")
        .select("nid", "n", F.explode(F.expr(f"slice(held, 1, size(held) - {need} + 1)")).alias("h"))
        .select("nid", "n", F.col("h.gram").alias("gram"))
    )
    leaders = postings.groupBy("gram").agg(F.min("nid").alias("anchor"), F.count("*").alias("c")).where("c > 1")
    groups = cut(postings.join(leaders, "gram").where("nid <> anchor").select("anchor", "nid").distinct())
    links = cut(_links(_first_blocks(groups), slim_sets, num, den))
    others = cut(_other_blocks(groups, components(links)))
    final = components(links.unionByName(_links(others, slim_sets, num, den)))

    ids = marked.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = (
        ids.join(sets.select("node", "nid"), "node", "left")
        .join(final.withColumnRenamed("node", "nid"), "nid", "left")
        .withColumn("class", F.coalesce(F.col("root").cast("string"), F.hex("node")))
    )
    named = rooted.select("node", "class").join(rooted.groupBy("class").agg(F.min("least").alias("component_id")), "class")
    return marked.join(named.select("node", "component_id"), "node", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "th",
    )


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class one row with the smallest ``doc_id``.

    All columns are kept as they are, whatever their names. Texts without words stay, and so do classes of which no row has
    a ``doc_id``. Of repeated rows one stays.
    """
    classes = cut(similar_classes(docs, size, num, den).where("n_shingles > 0 and component_id is not null"))
    first = (
        classes.where("doc_id = component_id")
        .groupBy("component_id")
        .agg(F.min("th").alias("first_th"))
    )
    rows = classes.join(first, "component_id")
    stays = F.expr("doc_id <=> component_id and th = first_th")
    gone = cut(rows.where(~stays).select("doc_id", "th").distinct())
    again = cut(rows.where(stays).groupBy("doc_id", "th").agg(F.count("*").alias("c")).where("c > 1").select("doc_id", "th"))
    small = (gone.count() + again.count()) * 16 <= LIST_BYTES
    listed = F.broadcast if small else (lambda frame: frame)
    own = [f"c{i}" for i in range(len(docs.columns))]
    key, text = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text"))
    known = docs.toDF(*own).withColumn("text_hash", F.xxhash64(F.col(text).cast("string"))).alias("d")
    same = F.expr(f"d.{key} <=> g.doc_id and d.text_hash = g.th")
    left = known.join(listed(gone).alias("g"), same, "left_anti").alias("d")
    once = left.join(listed(again).alias("g"), same, "left_anti")
    repeated = left.join(listed(again).alias("g"), same, "left_semi").dropDuplicates([key, "text_hash"])
    return once.unionByName(repeated).select(*own).toDF(*docs.columns)
