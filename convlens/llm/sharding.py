"""Sharding by extendible hashing.

Method: rows go to buckets by the first bits of a hash of their key. A bucket that is larger than the
byte limit, and only such a one, is split on one more bit, until every bucket fits or is one row. The
directory has, for the hash bits looked at in a round, how deep the bucket of each value is.

The splits of a round are found at once: rows of oversized buckets are summed by ``STEP`` more bits,
and the smallest depth that fits is read off running sums over those cells, of which a bucket has at
most ``2 ** STEP``. Repeated keys share the first ``KEY_BITS``; the rest of the hash differs by row, so
that a key that holds a third of all rows is split like any other. Where the hash ends before a bucket
fits, another ``HASH_BITS`` of the row's digest follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.runtime import cut

#: Bits of a hash: 15 hexadecimal digits of a digest, of which so many are the key's.
HASH_BITS, KEY_BITS = 60, 40
#: Bits that one round looks at.
STEP = 10


def _bits(value: Column, count: int, first: int = 0) -> Column:
    """So many bits of a digest from the ``first`` on (multiples of 4), as a number."""
    return F.conv(F.substring(F.md5(value.cast("binary")), first // 4 + 1, count // 4), 16, 10).cast("long")


def hash_of(key: Column) -> tuple[Column, Column]:
    """The key's bits, then those of the row's place among the input; and what follows them in the digest of the place."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    row = F.concat(text, F.lit("/"), F.monotonically_increasing_id().cast("string"))
    own = HASH_BITS - KEY_BITS
    return F.shiftleft(_bits(text, KEY_BITS), own) + _bits(row, own), _bits(row, HASH_BITS, own)


def prefix(depth: int) -> list[Column]:
    """What rows share whose first ``depth`` bits are equal: beyond the hash, all of it and bits of the tail."""
    if depth <= HASH_BITS:
        return [F.shiftright("hash", HASH_BITS - depth)]
    return [F.shiftright("tail", 2 * HASH_BITS - depth), F.col("hash")]


CELL = ("cell", "head")


def directory(sized: DataFrame, limit: int) -> list[DataFrame]:
    """Per round, ``(cell, depth, shard_bytes)`` of ``sized(hash, tail, bytes)``: the bucket of all rows whose hash
    begins with ``cell`` is told apart by its first ``depth`` bits. Rows of cells that are not in a
    round's table are looked up in the next one's. Beyond the hash, a cell has the hash as its ``head``."""
    rounds: list[DataFrame] = []
    todo = sized
    for deep in range(STEP, 2 * HASH_BITS + 1, STEP):
        place = CELL[: len(prefix(deep))]
        cells = todo.groupBy(*[c.alias(name) for c, name in zip(prefix(deep), place)]).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
        for depth in range(deep - STEP, deep + 1):
            bucket = Window.partitionBy(*place[1:], F.shiftright("cell", STEP), F.shiftright("cell", deep - depth))
            cells = cells.withColumns({f"b{depth}": F.sum("bytes").over(bucket), f"r{depth}": F.sum("rows").over(bucket)})
        fits = [(d, (F.col(f"b{d}") <= limit) | (F.col(f"r{d}") == 1)) for d in range(deep - STEP, deep + 1)]
        if deep == 2 * HASH_BITS:
            fits.append((deep, F.lit(True)))
        size = F.coalesce(*[F.when(ok, F.col(f"b{d}")) for d, ok in fits])
        depth = F.coalesce(*[F.when(ok, F.lit(d)) for d, ok in fits])
        found = cut(cells.select(*place, depth.alias("depth"), size.alias("shard_bytes")))
        rounds.append(found.where("depth is not null"))
        over = found.where("depth is null").select(*[F.col(name).alias(f"over_{name}") for name in place])
        if not over.limit(1).count():
            break
        todo = todo.join(over, [c == F.col(f"over_{name}") for c, name in zip(prefix(deep), place)], "left_semi")
    return rounds


def shard(docs: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """``docs`` with ``shard`` (the bits that its bucket is told apart by, as text), ``shard_depth`` and
    ``shard_bytes``, such that no shard has more than ``limit`` bytes unless it is one row.

    ``size``: bytes of a row (NULL counts as 0). A NULL key is an empty one. Rows with one key are split
    if they do not fit together. All rows in one shard give the empty text. An empty table gives an
    empty one. Columns of the added names are replaced, others are kept.

    ``docs`` is read once for each round and should come from files or a written table: repeated keys
    are told apart by their place in the input.
    """
    kept = [c for c in docs.columns if c not in ("shard", "shard_depth", "shard_bytes")]
    head, tail = hash_of(F.col(f"`{key}`"))
    placed = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)],
        head.alias("hash"),
        tail.alias("tail"),
        F.coalesce(size, F.lit(0)).cast("long").alias("bytes"),
    )
    rounds = directory(placed.select("hash", "tail", "bytes"), limit)
    depth, total = [], []
    for i, found in enumerate(rounds):
        shared = prefix(STEP * (i + 1))
        names = {f"{name}{i}": name for name in CELL[: len(shared)]}
        entry = found.select(*[F.col(old).alias(new) for new, old in names.items()], F.col("depth").alias(f"depth{i}"), F.col("shard_bytes").alias(f"size{i}"))
        placed = placed.join(entry, [c == F.col(name) for c, name in zip(shared, names)], "left")
        depth.append(F.col(f"depth{i}"))
        total.append(F.col(f"size{i}"))
    words = ["hash", "tail"][: 1 + (STEP * len(rounds) > HASH_BITS)]
    bits = F.concat(*[F.lpad(F.conv(F.col(word).cast("string"), 10, 2), HASH_BITS, "0") for word in words])
    deep = F.coalesce(*depth)
    return placed.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
        F.substring(bits, F.lit(1), deep).alias("shard"),
        deep.alias("shard_depth"),
        F.coalesce(*total).alias("shard_bytes"),
    )
