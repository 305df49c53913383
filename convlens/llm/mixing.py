"""Mixing sources to target weights, also where documents belong to several sources.

Method: a min-cost flow. Documents are aggregated by membership pattern (the set of sources they
belong to). The flow sends words from patterns to source quotas; the first use of a pattern's words
is free and each further use costs more than all cheaper ones together, so that repetition is spread
as evenly as the quotas allow. The flow says how often each pattern's words are used; documents are
then drawn by a seeded hash until that many words are taken.

Drawing is distributed: within a pattern, documents of like size (by powers of two) are one stratum,
and the border between drawn and not drawn hashes is found by histograms of hash prefixes, each
looking only into the border cell of the one before. No group is ever ordered or gathered, and the
strata settle one after the other, large documents first. What is still missing or too much is a sum of
few documents: of those with hashes next to the borders, a bounded number, the uses are changed whose
sum comes nearest. A source of a few dozen documents is drawn as near to its target as any draw can be.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.llm.text import WORD
from convlens.runtime import cut

#: Different membership patterns that a flow may have; more are an error, not cut off.
PATTERNS = 5_000
#: Hash bits that one histogram decides, and how many histograms there are.
BITS, ROUNDS = 12, 3
#: Documents next to a pattern's borders whose uses may change, about so many; and sums kept of them.
NEAR, SUMS = 64, 1 << 18


def word_count(text: str = "text") -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def code_point_order(names: list[str | None]) -> list[str | None]:
    return sorted(names, key=lambda s: (s is None, s or ""))


def capped_targets(sizes: dict[str | None, int], weights: dict[str | None, float], share: float, limit: float) -> dict[str | None, float]:
    """``share`` of all sizes by weight; above ``limit`` times its size a source stops there, and the
    excess is shared again by weight among the others until none is above."""
    total = share * sum(sizes.values())
    targets, free = {}, [s for s in code_point_order(list(sizes))]
    while free:
        weight = sum(weights[s] for s in free)
        over = [s for s in free if total * weights[s] / weight > limit * sizes[s]]
        if not over:
            return targets | {s: total * weights[s] / weight for s in free}
        for s in over:
            targets[s] = limit * sizes[s]
            total -= targets[s]
        free = [s for s in free if s not in over]
    return targets


def min_cost_flow(arcs: list[tuple[int, int, float, float]], nodes: int, source: int, sink: int) -> list[float]:
    """The flow on each arc ``(from, to, capacity, cost)``, by successive shortest paths."""
    out: list[list[int]] = [[] for _ in range(nodes)]
    to, left, cost = [], [], []
    for a, b, capacity, price in arcs:
        for x, y, room, charge in ((a, b, capacity, price), (b, a, 0.0, -price)):
            out[x].append(len(to))
            to.append(y), left.append(room), cost.append(charge)
    least = 1e-6
    while True:
        best, by, queued = {source: 0.0}, {}, {source}
        queue = deque([source])
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in out[x]:
                if left[e] > least and best[x] + cost[e] < best.get(to[e], float("inf")) - 1e-9:
                    best[to[e]], by[to[e]] = best[x] + cost[e], e
                    if to[e] not in queued:
                        queued.add(to[e])
                        queue.append(to[e])
        if sink not in best:
            return [capacity - left[2 * i] for i, (_, _, capacity, _) in enumerate(arcs)]
        path, x = [], sink
        while x != source:
            path.append(by[x])
            x = to[by[x] ^ 1]
        amount = min(left[e] for e in path)
        for e in path:
            left[e] -= amount
            left[e ^ 1] += amount


def route(patterns: list[tuple[tuple[str | None, ...], int]], targets: dict[str | None, float], repeats: int) -> dict[tuple, dict[str | None, float]]:
    """Words that each pattern ``(sources, words)`` gives to each of its sources."""
    names = code_point_order(list(targets))
    at = {s: 2 + i for i, s in enumerate(names)}
    arcs, given = [], []
    for i, (members, size) in enumerate(patterns):
        node = 2 + len(names) + i
        for use in range(repeats):
            arcs.append((0, node, float(size), float(use * (use + 1))))
        for s in members:
            given.append((len(arcs), members, s))
            arcs.append((node, at[s], float(size * repeats), 0.0))
    arcs += [(at[s], 1, targets[s], 0.0) for s in names]
    flow = min_cost_flow(arcs, 2 + len(names) + len(patterns), 0, 1)
    routed: dict[tuple, dict[str | None, float]] = {}
    for arc, members, s in given:
        routed.setdefault(members, {})[s] = flow[arc]
    return routed


@dataclass
class Mix:
    """``sources``: each source's size and target; ``routed``: the flow, by pattern and source;
    ``documents``: the rows with ``_mix_members``, ``_mix_size`` and ``_mix_copies``."""

    sources: dict[str | None, tuple[int, float]]
    routed: dict[tuple, dict[str | None, float]]
    documents: DataFrame


def _prepared(docs: DataFrame, members: Column, size: Column, seed: int) -> DataFrame:
    """``docs`` as columns c0, c1, ... and what decides about a row, under names with ``_mix``."""
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 64 - BITS * ROUNDS)
    return docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
        F.array_sort(F.array_distinct(members)).alias("_mix_members"),
        size.alias("_mix_size"),
        order.alias("_mix_hash"),
    ).withColumn("_mix_stratum", F.floor(F.log2(F.greatest("_mix_size", F.lit(1)))).cast("int"))


@dataclass
class Cell:
    """Where a stratum's border lies so far: in the cell with this hash prefix, which holds ``words``,
    ``below`` words lie under it, and ``goal`` of ``all`` are wanted. ``border`` is set once it is
    decided."""

    all: int
    goal: float
    prefix: int = 0
    below: int = 0
    words: int = 0
    border: int | None = None


Key = tuple[int, int]
Place = tuple[int, int, int]


def _search(slim: DataFrame, cells: dict[Key, Cell]) -> None:
    """Narrows each stratum down to the cell that its goal falls into: each round adds up the sizes by
    the next hash bits within the cells found so far."""
    spark = slim.sparkSession
    for cell in cells.values():
        cell.prefix, cell.below, cell.words, cell.border = 0, 0, cell.all, None
    for number in range(1, ROUNDS + 1):
        shift = BITS * (ROUNDS - number)
        open_cells = [(p, s, c.prefix, float(c.goal - c.below)) for (p, s), c in cells.items() if c.border is None]
        here = _table(spark, open_cells, pattern=pa.int32(), stratum=pa.int32(), prefix=pa.int64(), goal=pa.float64())
        border = (
            slim.withColumn("prefix", F.shiftright("hash", shift + BITS))
            .join(F.broadcast(here), ["pattern", "stratum", "prefix"])
            .groupBy("pattern", "stratum", "goal", F.shiftright("hash", shift).alias("cell"))
            .agg(F.sum("size").alias("words"))
            .withColumn("upto", F.expr("sum(words) over (partition by pattern, stratum order by cell)"))
            .where("upto > goal")
            .groupBy("pattern", "stratum")
            .agg(F.min_by(F.struct("cell", "upto", "words"), "cell").alias("b"))
            .select("pattern", "stratum", "b.*")
        )
        found = {(r["pattern"], r["stratum"]): r for r in border.collect()}
        for key, cell in cells.items():
            if cell.border is None and key in found:
                r = found[key]
                cell.prefix, cell.below, cell.words = r["cell"], cell.below + r["upto"] - r["words"], r["words"]
            elif cell.border is None:  # all that is left of the cell is wanted
                cell.border, cell.below, cell.words = (cell.prefix + 1) << (shift + BITS), cell.below + cell.words, 0


def _decide(cells: dict[Key, Cell]) -> tuple[dict[Key, int], dict[int, int]]:
    """Each stratum's border, and the words taken from each pattern. Strata settle from large documents
    to small ones: the border cell is taken if that brings the words so far nearer to the goals."""
    borders, taken, short = {}, {}, {}
    for (p, s), cell in sorted(cells.items(), key=lambda x: (x[0][0], -x[0][1])):
        short[p] = short.get(p, 0.0) + cell.goal - cell.below
        over = cell.border is None and abs(short[p] - cell.words) < abs(short[p])
        short[p] -= cell.words if over else 0
        taken[p] = taken.get(p, 0) + cell.below + (cell.words if over else 0)
        borders[p, s] = cell.border if cell.border is not None else cell.prefix + int(over)
    return borders, taken


def nearest_sum(target: float, items: list[list[int]]) -> list[int]:
    """An option for each item, so that the options' sum comes near ``target``; each item's first option is 0.

    Sums of the items so far are kept, each reached once, and of very many the nearest ones. It ends
    where no sum of whole numbers can be nearer.
    """
    sums, steps = np.zeros(1, np.int64), []
    best = abs(target - round(target)) + 1e-9
    for options in items:
        if np.abs(sums - target).min() <= best:
            break
        every = np.concatenate([sums + o for o in options])
        _, first = np.unique(every, return_index=True)  # of equal sums the earliest option
        if len(first) > SUMS:
            first = first[np.argpartition(np.abs(every[first] - target), SUMS)[:SUMS]]
        steps.append(np.divmod(first, len(sums)))
        sums = every[first]
    at, chosen = int(np.abs(sums - target).argmin()), []
    for option, before in reversed(steps):
        chosen.append(int(option[at]))
        at = int(before[at])
    return chosen[::-1] + [0] * (len(items) - len(chosen))


def settled(short: float, near: list[tuple[Place, int, int]], base: int, limit: int) -> dict[Place, int]:
    """Changes of uses, by place, whose words come nearest to ``short``; ``near``: ``(place, words, uses)``.

    Uses change between ``base`` and one more; to other numbers up to ``limit`` only where that comes nearer.
    """
    near = sorted(near, key=lambda x: (abs(x[1] - abs(short)), x[0]))
    best, missed = {}, abs(short)
    for low, high in ((base, min(base + 1, limit)), (0, limit)):
        uses = [sorted(range(low, high + 1), key=lambda u, own=own: (abs(u - own), u)) for _, _, own in near]
        picked = nearest_sum(short, [[(u - own) * words for u in us] for us, (_, words, own) in zip(uses, near, strict=True)])
        changes = {place: us[i] - own for i, us, (place, _, own) in zip(picked, uses, near, strict=True) if us[i] != own}
        words = {place: words for place, words, _ in near}
        miss = abs(short - sum(n * words[place] for place, n in changes.items()))
        if miss < missed - 1e-6:
            best, missed = changes, miss
    return best


def _table(spark: SparkSession, rows: list[tuple], **types: pa.DataType) -> DataFrame:
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return spark.createDataFrame(pa.table({n: pa.array(list(c), t) for (n, t), c in zip(types.items(), columns, strict=True)}))


def _near(slim: DataFrame, strata: list[tuple[int, int, int, int]]) -> list[tuple[Place, int]]:
    """``((pattern, stratum, hash), words)`` of the hashes next to the borders, from ``(pattern, stratum, low, high)``."""
    band = _table(slim.sparkSession, strata, pattern=pa.int32(), stratum=pa.int32(), low=pa.int64(), high=pa.int64())
    inside = slim.join(F.broadcast(band), ["pattern", "stratum"]).where("hash >= low and hash < high")
    found = inside.groupBy("pattern", "stratum", "hash").agg(F.sum("size").alias("words")).collect()
    return [((r["pattern"], r["stratum"], r["hash"]), r["words"]) for r in found]


def _borders(slim: DataFrame, wanted: dict[int, float], limit: int) -> tuple[list[tuple[int, int, int, int]], dict[Place, int]]:
    """``(pattern, stratum, copies, border)``: rows with a hash below the border are used once more; and
    changes of that for single hashes.

    ``slim(pattern, stratum, size, hash)``; ``wanted``: how many times a pattern's words are used.
    """
    totals = slim.groupBy("pattern", "stratum").agg(F.sum("size").alias("all"), F.count("*").alias("n")).collect()
    copies = {p: int(wanted[p] + 1e-9) for p in wanted}
    cells: dict[Key, Cell] = {}
    goals, count, strata = dict.fromkeys(wanted, 0.0), {}, dict.fromkeys(wanted, 0)
    for r in totals:
        p, key = r["pattern"], (r["pattern"], r["stratum"])
        cells[key] = Cell(r["all"], max(0.0, wanted[p] - copies[p]) * r["all"])
        goals[p] += cells[key].goal
        count[key], strata[p] = r["n"], strata[p] + 1
    _search(slim, cells)
    borders, taken = _decide(cells)
    whole = 1 << BITS * ROUNDS
    bands = []
    for (p, s), border in sorted(borders.items()):
        if abs(goals[p] - taken[p]) > 0.5:
            width = whole * max(2, NEAR // strata[p]) // count[p, s] // 2 + 1
            low = max(0, min(border, whole) - width)
            bands.append((p, s, low, max(border + width, low + 2 * width)))
    near: dict[int, list[tuple[Place, int, int]]] = {}
    for place, words in _near(slim, bands) if bands else []:
        p, s, own = place
        near.setdefault(p, []).append((place, words, copies[p] + (own < borders[p, s])))
    changed: dict[Place, int] = {}
    for p, own in near.items():
        changed |= settled(goals[p] - taken[p], own, copies[p], limit)
    return [(p, s, copies[p], border) for (p, s), border in borders.items()], changed


def mix(docs: DataFrame, members: Column, weights: list[float] | dict[str | None, float], share: float = 1.5, limit: int = 2, seed: int = 7) -> Mix:
    """Choose how often each row of ``docs(doc_id, text, ...)`` is used.

    ``members``: the sources of a row, as an array. ``weights``: by source, or a list that repeats
    over the sources in code point order, NULL last. All sizes are words. A source that is short of
    words stops at ``limit`` times its size.

    Rows without words are used 0 times. Repeated rows (same id and text) are drawn alike. An empty
    table gives an empty one. Only one row for each source, pattern and size class reaches the driver.
    """
    ready = _prepared(docs, members, word_count(), seed)
    spark = docs.sparkSession
    slim = cut(ready.select("_mix_members", "_mix_stratum", "_mix_size", "_mix_hash"))
    patterns = slim.groupBy("_mix_members").agg(F.sum("_mix_size").alias("size")).limit(PATTERNS + 1).collect()
    if len(patterns) > PATTERNS:
        raise ValueError(f"more than {PATTERNS} membership patterns")
    known = sorted(((tuple(r["_mix_members"]), r["size"]) for r in patterns), key=lambda x: [(s is None, s or "") for s in x[0]])
    sizes: dict[str | None, int] = {}
    for sources, size in known:
        for s in sources:
            sizes[s] = sizes.get(s, 0) + size
    if not isinstance(weights, dict):
        weights = {s: weights[i % len(weights)] for i, s in enumerate(code_point_order(list(sizes)))}
    targets = capped_targets(sizes, weights, share, limit)
    routed = route(known, targets, limit)
    wanted = {i: sum(routed.get(m, {}).values()) / n if n else 0.0 for i, (m, n) in enumerate(known)}
    names = pa.list_(pa.string())
    numbers = F.broadcast(_table(spark, [(i, list(m)) for i, (m, _) in enumerate(known)], pattern=pa.int32(), _mix_members=names))
    numbered = cut(
        slim.where("_mix_size > 0").join(numbers, "_mix_members")
        .select("pattern", F.col("_mix_stratum").alias("stratum"), F.col("_mix_size").alias("size"), F.col("_mix_hash").alias("hash"))
    )
    decided, changed = _borders(numbered, wanted, limit)
    where = {"_mix_members": names, "_mix_stratum": pa.int32()}
    table = _table(spark, [(list(known[p][0]), s, c, b) for p, s, c, b in decided], **where, _mix_base=pa.int32(), _mix_border=pa.int64())
    single = _table(spark, [(list(known[p][0]), s, h, n) for (p, s, h), n in changed.items()], **where, _mix_hash=pa.int64(), _mix_change=pa.int32())
    drawn = F.col("_mix_base") + (F.col("_mix_hash") < F.col("_mix_border")).cast("int") + F.coalesce("_mix_change", F.lit(0))
    used = F.when(F.col("_mix_size") > 0, drawn).otherwise(0)
    chosen = (
        ready.join(F.broadcast(table), [*where], "left").join(F.broadcast(single), [*where, "_mix_hash"], "left")
        .withColumn("_mix_copies", F.coalesce(used, F.lit(0)))
    )
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    chosen = chosen.select(*kept, "_mix_members", "_mix_size", "_mix_copies")
    return Mix({s: (sizes[s], targets[s]) for s in sizes}, routed, chosen)


def repeated(mixed: Mix, columns: list[str]) -> DataFrame:
    """The mixed rows themselves, each as often as it is used, with the given columns of the input."""
    every = mixed.documents.where("_mix_copies > 0")
    return every.withColumn("_mix_use", F.explode(F.sequence(F.lit(1), "_mix_copies"))).select(*[F.col(f"`{c}`") for c in columns])
