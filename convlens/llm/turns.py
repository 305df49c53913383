"""Prefix trie of conversations: every shared beginning once, with what is saved by storing it once.

Method: a conversation is a row of positional turn-id columns, and one ``GROUP BY ... ROLLUP(t1, ..., tK)``
aggregates all its prefixes together; ``grouping_id`` tells how deep a group is. A longer conversation
goes on in further rows of ``K`` columns, each keyed by the node at which the row before it ended, so
that a row costs the same wherever it lies.

How subtrees are summed without walking the trie:

* A conversation that is a node's smallest member is so in all deeper nodes of its own. So each
  conversation has one depth at which it becomes the smallest (``since``); above it, its turns are
  copies of other conversations' turns.
* The copies' bytes add up to what a subtree saves, and each leaf counts for its smallest member. Both
  are sums over a node's members, which a second ROLLUP takes.
* A node whose depth is its conversation's ``since`` is a branch: only branches look their parent up.

A node's name is the exclusive-or of two 64-bit hashes of (place, turn id) over its turns, so the names
of a conversation's rows are running values and need no rounds. Places are counted after a range
partitioning, and running values are carried between spans of rows: no conversation is in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.runtime import cut

#: Turn-id columns of a row, and rows of one conversation that one window runs over.
COLUMNS = 8
SPAN = 4096
#: SHA-256 of nothing.
NOTHING = hashlib.sha256(b"").hexdigest()


@dataclass
class Trie:
    """``nodes``: a row each, see `prefix_trie`; ``ends(k1, k2, conv_id)``: the node at which a conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def turn_id() -> Column:
    """A 128-bit name of ``role`` and ``text``; NULL counts as empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def ordered(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, id, n)``: each turn's place from 1, its turn id, and its text's UTF-8 bytes.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not looked at. Order is by ``turn``, NULL
    first, ties by turn id; repeated rows are turns each. Rows without a ``conv_id`` belong to no
    conversation and are left out. No rows give no rows.
    """
    slim = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        turn_id().alias("id"),
        F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("n"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "id"]
    lined = cut(
        slim.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "conv_id", "id", "n")
    )
    pieces = lined.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = pieces.select("conv_id", "part", (F.coalesce(F.sum("c").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return cut(lined.join(shift, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "id", "n"))


def lengths(places: DataFrame) -> DataFrame:
    """``(conv_id, len)`` of each conversation in ``places``."""
    return places.groupBy("conv_id").agg(F.count("*").alias("len"))


def _marks(pos: Column, turn: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at its place; the node's name is their exclusive-or over its turns."""
    return F.xxhash64(pos, turn), F.xxhash64(turn, pos)


def _xor(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


def _rows(places: DataFrame, sizes: DataFrame) -> DataFrame:
    """A row per conversation and ``COLUMNS`` turns: the node and the bytes before it, its own, its columns."""
    first, second = _marks(F.col("pos"), F.col("id"))
    whole = (
        places.withColumns({"block": F.floor((F.col("pos") - 1) / COLUMNS), "m1": first, "m2": second})
        .groupBy("conv_id", "block")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "id", "n"))).alias("held"),
            F.bit_xor("m1").alias("own1"), F.bit_xor("m2").alias("own2"), F.sum("n").alias("own_n"),
        )
        .join(sizes, "conv_id", "right")
        .select(
            "conv_id", "len", F.coalesce("block", F.lit(0)).cast("long").alias("block"), "held",
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("own1", "own2", "own_n")),
        )
        .withColumn("span", F.floor(F.col("block") / SPAN))
    )
    whole = cut(whole)
    sums = [("own1", "k1", F.bit_xor), ("own2", "k2", F.bit_xor), ("own_n", "before", F.sum)]
    spans = whole.where(F.col("len") > COLUMNS * SPAN).groupBy("conv_id", "span").agg(*(f(own).alias(own) for own, _, f in sums))
    by_span = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carry = spans.select("conv_id", "span", *(f(own).over(by_span).alias(f"carried_{own}") for own, _, f in sums))
    by_block = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    run = whole.join(carry, ["conv_id", "span"], "left").withColumns(
        {own: F.col(own) for own, _, _ in sums}
        | {f"run_{own}": F.coalesce(f(own).over(by_block), zero) for own, _, f in sums}
    )

    def prior(own: str, by_sum: bool) -> Column:
        here, carried = F.col(f"run_{own}"), F.coalesce(f"carried_{own}", zero)
        return here + carried if by_sum else here.bitwiseXOR(carried)

    return run.select(
        "conv_id", "len", "block", *(prior(own, f is F.sum).alias(name) for own, name, f in sums), "own1", "own2", "own_n",
        *(F.expr(f"get(held, {i})").dropFields("pos").alias(f"t{i + 1}") for i in range(COLUMNS)),
    )


def _rolled(rows: DataFrame, sums: str) -> DataFrame:
    """Aggregates of all prefixes: one ROLLUP over the positional columns, keyed by the node before them."""
    slots = [f"t{i + 1}" for i in range(COLUMNS)]
    listed = ", ".join(slots)
    grouped = rows.sparkSession.sql(
        f"""
        SELECT k1, k2, block, before, {listed}, {COLUMNS} - bit_count(grouping_id()) AS level, {sums}
        FROM {{rows}} GROUP BY k1, k2, block, before, ROLLUP({listed})
        """,
        rows=rows,
    )
    held = sum((F.when(F.col(t).isNotNull(), 1).otherwise(0) for t in slots), F.lit(0))
    real = grouped.where(F.when(F.col("level") == 0, F.col("block") == 0).otherwise(held == F.col("level")))
    marks = [_marks(F.col("block") * COLUMNS + F.lit(i + 1).cast("long"), F.col(f"{t}.id")) for i, t in enumerate(slots)]
    zero = F.lit(0).cast("long")
    names = {}
    for side in (0, 1):
        own = [F.when(F.col(t).isNotNull(), m[side]) for t, m in zip(slots, marks, strict=True)]
        names[side] = _xor([F.col(f"k{side + 1}"), *(F.coalesce(o, zero) for o in own)])
        names[side, "last"] = F.coalesce(*own[::-1], zero)
    last = F.coalesce(*(F.col(f"{t}.n") for t in slots[::-1]), zero)
    every = sum((F.coalesce(F.col(f"{t}.n"), zero) for t in slots), F.col("before"))
    kept = [c for c in grouped.columns if c not in {"k1", "k2", "block", "before", "level", *slots}]
    return real.select(
        names[0].alias("k1"), names[1].alias("k2"),
        names[0].bitwiseXOR(names[0, "last"]).alias("p1"), names[1].bitwiseXOR(names[1, "last"]).alias("p2"),
        (F.col("block") * COLUMNS + F.col("level")).cast("long").alias("depth"),
        F.coalesce(*(F.col(f"{t}.id") for t in slots[::-1])).alias("id"), last.alias("n"), (every - last).alias("before"), *kept,
    )


def prefix_trie(places: DataFrame, sizes: DataFrame | None = None) -> Trie:
    """The trie of the conversations in ``places(conv_id, pos, id, n)``, places from 1 without gaps.

    ``sizes(conv_id, len)`` names the conversations, those without turns included; by default those in
    ``places``. A node's row: ``k1, k2`` its name, ``depth``, ``id`` and ``n`` its last turn, ``conv_id`` its smallest
    member, ``parent_conv_id`` (NULL for the root), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens``, as the contract
    of the query has them. Conversations without turns are members of the root. No conversations give
    no nodes. Equal conversations share all nodes.
    """
    sizes = cut(lengths(places) if sizes is None else sizes)
    rows = cut(_rows(places, sizes))
    found = _rolled(rows, "min(conv_id) AS conv_id, max(len) AS longest")
    first = found.groupBy("conv_id").agg(
        F.min("depth").alias("since"), F.min("before").alias("first_before"),
        F.max(F.when(F.col("longest") == F.col("depth"), 1).otherwise(0)).alias("leaf"),
    )
    totals = rows.groupBy("conv_id").agg(F.max("len").alias("own_len"), F.max(F.col("before") + F.col("own_n")).alias("total"))
    facts = cut(
        totals.join(first, "conv_id", "left").select(
            "conv_id", "own_len", F.coalesce("since", F.col("own_len") + 1).alias("since"),
            F.coalesce("first_before", "total").alias("copied"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"),
        )
    )
    summed = _rolled(
        rows.join(facts.select("conv_id", "copied", "leaf"), "conv_id"),
        "min(conv_id) AS conv_id, count(*) AS n_convs, sum(copied) AS copies, sum(leaf) AS n_leaves",
    )
    nodes = cut(
        summed.join(facts.drop("leaf"), "conv_id").select(
            "k1", "k2", "p1", "p2", "depth", "id", "n", "conv_id", "n_convs", "n_leaves",
            (F.col("copies") - F.col("copied") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
            (F.col("own_len") > F.col("depth")).cast("long").alias("goes_on"), (F.col("since") == F.col("depth")).alias("branch"),
        )
    )
    branches = nodes.where("branch and depth > 0")
    none = F.lit(None).cast("long")
    kids = branches.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("kids")).withColumn("above", none)
    above = branches.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).join(
        nodes.select("k1", "k2", F.col("conv_id").alias("above")), ["k1", "k2"]
    )
    around = (
        kids.unionByName(above.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), none.alias("kids"), "above"))
        .groupBy("k1", "k2")
        .agg(F.max("kids").alias("kids"), F.max("above").alias("above"))
    )
    parent = F.when(F.col("depth") == 0, none).when(F.col("branch"), F.col("above")).otherwise(F.col("conv_id"))
    whole = nodes.join(around, ["k1", "k2"], "left").select(
        "k1", "k2", "depth", "id", "n", "conv_id", parent.alias("parent_conv_id"), "n_convs",
        (F.coalesce("kids", F.lit(0)) + F.col("goes_on")).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
    )
    last = rows.where(F.col("len") <= (F.col("block") + 1) * COLUMNS)
    ends = last.select(
        F.col("k1").bitwiseXOR(F.col("own1")).alias("k1"), F.col("k2").bitwiseXOR(F.col("own2")).alias("k2"), "conv_id"
    )
    return Trie(whole, ends)


def with_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the ``role`` and ``text`` of their last turn (NULL for the root)."""
    known = turns.select(turn_id().alias("id"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    return nodes.join(known.dropDuplicates(["id"]), "id", "left")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (k1, k2, conv_id) as runs of one node: their ids joined by commas."""
    for batch in batches:
        rows, start = list(zip(*(batch.column(i).to_pylist() for i in range(3)))), 0
        runs = []
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][:2] != rows[start][:2]:
                runs.append((*rows[start], ",".join(str(r[2]) for r in rows[start:i])))
                start = i
        yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "first", "ids"), r)) for r in runs], schema=_LISTED)


_LISTED = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_HASHED = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's runs, which come in order; only the digest's state is held."""
    now, state = None, None
    for batch in batches:
        done = []
        for k1, k2, _, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (k1, k2) == now:
                state.update(b",")
            else:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (k1, k2), hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(_HASHED.names, r)) for r in done], schema=_HASHED)
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(_HASHED.names, (*now, state.hexdigest())))], schema=_HASHED)


def end_digests(ends: DataFrame) -> DataFrame:
    """``(k1, k2, ends_sha256)``: SHA-256 of the decimal ids that end at a node, ascending, joined by commas.

    A digest is a chain, so one task must see all ids of a node. They are put in order and joined by
    all tasks first; what meets in one task is a stream of joined runs, of which it holds the state only.
    """
    order = ["k1", "k2", "conv_id"]
    runs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_listed, "k1 long, k2 long, first long, ids string")
    return runs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(_hashed, "k1 long, k2 long, ends_sha256 string")


def spliced(places: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``head`` turns are those of another one: ``(places, sizes)``.

    ``base`` and ``head`` are expressions on ``conv_id``; ``head`` is small, as each conversation reads so many
    turns of its base. A base with fewer turns gives all, one that does not exist none. A
    conversation's own turns after its first ``head`` follow.
    """
    sizes = lengths(places)
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    convs = cut(
        sizes.withColumns({"base": base.cast("long"), "head": head.cast("long")})
        .join(bases, "base", "left")
        .withColumn("taken", F.least("head", F.coalesce("base_len", F.lit(0))))
        .select("conv_id", "base", "head", "taken", (F.col("taken") + F.greatest(F.col("len") - F.col("head"), F.lit(0))).alias("len"))
    )
    own = places.join(convs.select("conv_id", "head", "taken"), "conv_id").where("pos > head")
    widest = convs.agg(F.max("taken")).first()[0] or 0
    heads = places.where(F.col("pos") <= widest).withColumnRenamed("conv_id", "base")
    lent = convs.select("conv_id", "base", "taken").join(heads, "base").where("pos <= taken")
    rebuilt = own.select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), "id", "n").unionByName(
        lent.select("conv_id", "pos", "id", "n")
    )
    return rebuilt, convs.select("conv_id", "len")
