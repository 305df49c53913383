"""Language-model scores from a log-frequency Bloom filter.

Method: words and word pairs of the training texts are counted over all of them. A count ``c`` is
quantised to the level ``1 + floor(log(c) / log(BASE))``, and for an n-gram of level ``q`` the pairs
(n-gram, 1) ... (n-gram, q) are put into a Bloom filter. A count is read back by asking for level 1,
2, ... until an answer is no; the filter can overstate a count but never loses one. Smoothed
probabilities are made of counts read that way:

    p(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | h) = (c(h w) + PRIOR * p(w)) / (c(h) + PRIOR)

The filter is made of segments by n-gram hash, each built in one task from a bounded number of
n-grams, so it grows with the corpus. Up to ``FILTER_BYTES`` it is sent to all workers; beyond that the
n-grams' hashes travel to the segments and their counts come back, with the same answers. They travel
once: the n-grams that a block of text has in training are those that it asks for, but for the ones
of held-out texts, which are sent with a count of 0; the task that builds a segment answers at once.

Exact word counts, for the base score, do not come from the filter: each chunk of text sends its
distinct words to be joined with the counts, together with the texts they occur in. Beyond
``FILTER_BYTES`` they come back with the answers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.text import LOWER, Words, chunks, distinct, give_back, mix, raw, small_batches, translated, words
from convlens.runtime import cut, shuffles_removed

#: Ratio of neighbouring count levels, and the levels that a 64-bit count can need.
BASE = 1.5
LEVELS = 112
#: Bits of the filter for each (n-gram, level) in it, and the bits that are set for one.
BITS_PER_ENTRY, PROBES = 8, 5
#: Weight of the word's own probability against the counts after its context.
PRIOR = 8.0
#: Pairs that occur once are in the filter too; raise it to keep fewer.
MIN_COUNT = 1
#: Bytes of training text that one segment stands for.
SEGMENT_BYTES = 16 << 20
#: N-grams that are looked up at once.
ASKED = 1 << 16
#: Bytes of filter that are sent to every worker, at most; one is built for that from so many times the text, at most.
FILTER_BYTES, TEXT_TIMES = 128 << 20, 8
#: Bytes of text whose n-grams travel to the segments together, and the low bytes of an n-gram's distance from the
#: one before it that are sent as they are.
BLOCK_BYTES, PLAIN_BYTES = 8 << 20, 5
ALPHA = 0.1

STEP = np.uint64(0x9E3779B97F4A7C15)
END_HASH = np.uint64(0xD1B54A32D192ED03)
START_HASH = np.uint64(0x8CB92BA72F3D8DD7)


def held_out(doc_id: Column) -> Column:
    """Every tenth document, by a checksum of its id; a NULL id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def _levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def _expected(level: np.ndarray) -> np.ndarray:
    """The mean of the counts that have a level; 0 for none."""
    table = np.zeros(LEVELS + 1)
    for q in range(1, LEVELS + 1):
        low, high = np.ceil(BASE ** (q - 1) - 1e-6), np.ceil(BASE**q - 1e-6) - 1
        table[q] = (low + max(low, high)) / 2
    return table[level]


def with_ends(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and where each text's tokens begin."""
    starts = found.starts + np.arange(len(found.starts))
    hashes = np.empty(starts[-1], np.uint64)
    ends = starts[1:] - 1
    inner = np.ones(len(hashes), bool)
    inner[ends] = False
    hashes[inner] = found.hashes()
    hashes[ends] = END_HASH
    return hashes, starts


def pair_hashes(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each token with the one before it; a text's first follows its start."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts[:-1]] = START_HASH
    return mix(mix(before + STEP) + tokens)


def _segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(segments)) >> np.uint64(24)


def _places(hashes: np.ndarray, level: np.ndarray | int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bits of (n-gram, level): double hashing within a segment of so many bits."""
    first = mix(hashes + STEP * np.asarray(level, np.uint64))
    second = mix(first) | np.uint64(1)
    for i in range(PROBES):
        yield (first + np.uint64(i) * second) % np.asarray(bits, np.uint64)


def build_segment(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter of these n-grams, as bytes."""
    level = _levels(counts)
    bits = max(64, int(level.sum()) * BITS_PER_ENTRY)
    field = np.zeros(bits, bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        for place in _places(hashes[level >= q], q, bits):
            field[place] = True
    return np.packbits(field, bitorder="little")


class Filter:
    """Segments one after the other, with the bits where each begins."""

    def __init__(self, sizes: list[int], field: bytes):
        """``sizes``: bytes of each segment; ``field``: all of them in a row."""
        held = np.array(sizes, np.uint64)
        self.segments = len(sizes)
        self.bits = held * np.uint64(8)
        self.begin = (np.cumsum(held) - held) * np.uint64(8)
        self.field = np.frombuffer(field, np.uint8)

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """The count of each n-gram."""
        return _expected(self.levels(hashes))

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The level of each n-gram, by asking for one after the other until one is missing."""
        parts = [self._asked(hashes[i : i + ASKED]) for i in range(0, len(hashes), ASKED)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _asked(self, hashes: np.ndarray) -> np.ndarray:
        level = np.zeros(len(hashes), np.int64)
        segment = _segment(hashes, self.segments).astype(np.int64)
        there = np.flatnonzero(self.bits[segment] > 0)
        q = 0
        while len(there) and q < LEVELS:
            q += 1
            bits, begin = self.bits[segment[there]], self.begin[segment[there]]
            for i, place in enumerate(_places(hashes[there], q, bits)):
                if i == 0:
                    yes = np.ones(len(there), bool)
                at = place + begin
                yes &= (self.field[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            there = there[yes]
            level[there] = q
        return level


def _counted(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(tokens)
    first = np.flatnonzero(distinct(ordered))
    return ordered[first], np.diff(np.append(first, len(ordered)))


def _ngram_rows(segments: int):
    """Per chunk of training text and segment, its words and pairs, each with its count in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            data, bounds = raw(chunk.column("text"))
            tokens, starts = with_ends(words(translated(data, LOWER), bounds))
            starting = np.full(chunk.num_rows, START_HASH)  # the context of first words
            rows = {"segment": [], "kind": [], "grams": [], "times": []}
            for kind, own in enumerate((tokens, pair_hashes(tokens, starts), starting)):
                grams, times = _counted(own)
                for segment, a, b in _cuts(grams, segments):
                    rows["segment"].append(segment)
                    rows["kind"].append(kind)
                    rows["grams"].append(grams[a:b].tobytes())
                    rows["times"].append(_small(times[a:b]))
            yield pa.record_batch(rows, schema=GRAM_ROWS)

    return run


GRAM_ROWS = pa.schema([("segment", pa.int64()), ("kind", pa.int32()), ("grams", pa.binary()), ("times", pa.binary())])


def _cuts(grams: np.ndarray, segments: int) -> list[tuple[int, int, int]]:
    """The segments that sorted n-grams fall into, and from where to where each has them."""
    owner = _segment(grams, segments)
    begin = np.flatnonzero(distinct(owner)) if len(owner) else np.zeros(0, np.int64)
    return list(zip(owner[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(grams)]))


def _small(times: np.ndarray) -> bytes:
    """Counts as bytes, those over 254 as 255 and eight bytes at the end."""
    large = times > 254
    return np.where(large, 255, times).astype(np.uint8).tobytes() + times[large].astype(np.int64).tobytes()


def _large(packed: bytes, count: int) -> np.ndarray:
    times = np.frombuffer(packed, np.uint8, count).astype(np.int64)
    times[times == 255] = np.frombuffer(packed, np.int64, offset=count) if len(packed) > count else 0
    return times


def _summed(grams: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts from those of several chunks."""
    every, weight = np.concatenate(grams), np.concatenate(times)
    order = np.argsort(every)
    every = every[order]
    first = np.flatnonzero(distinct(every))
    return every[first], np.add.reduceat(weight[order], first) if len(first) else weight


def _segment_filter(table: pa.Table) -> pa.Table:
    """One segment's filter, with how many tokens and distinct words it stands for."""
    kind = np.array(table.column("kind").to_pylist())
    grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
    times = [_large(t, len(g)) for t, g in zip(table.column("times").to_pylist(), grams)]
    pick = lambda xs, k: [x for x, own in zip(xs, kind) if own == k] or [xs[0][:0]]
    parts = [_summed(pick(grams, k), pick(times, k)) for k in range(3)]
    every = np.concatenate([g for g, _ in parts])
    total = np.concatenate([t for _, t in parts]).astype(np.int64)
    often = (total >= MIN_COUNT) | (np.arange(len(total)) < len(parts[0][0]))
    return pa.table(
        {
            "segment": table.column("segment").slice(0, 1),
            "field": pa.array([build_segment(every[often], total[often]).tobytes()], pa.binary()),
            "tokens": pa.array([int(parts[0][1].sum())], pa.int64()),
            "kinds": pa.array([len(parts[0][0])], pa.int64()),
        }
    )


def _mixed(alone: np.ndarray, pair: np.ndarray, before: np.ndarray, starts: np.ndarray, total: float, kinds: float) -> np.ndarray:
    """log10 of each text's probability from the counts of its tokens, pairs and contexts."""
    chance = (alone + ALPHA) / (total + ALPHA * (kinds + 1))
    logs = np.log10((np.minimum(pair, before) + PRIOR * chance) / (before + PRIOR))
    return np.add.reduceat(logs, starts[:-1]) if len(logs) else logs


def _contexts(alone: np.ndarray, begins: float, starts: np.ndarray) -> np.ndarray:
    before = np.empty(len(alone))
    before[1:] = alone[:-1]
    before[starts[:-1]] = begins
    return before


CHUNK_ROWS = pa.schema(
    [("segment", pa.int64()), ("block", pa.int64()), ("kind", pa.int32())]
    + [(c, pa.binary()) for c in ("grams", "times", "texts", "owners", "uses", "about")]
)
#: Kinds of the rows about a chunk: its words and its texts.
WORDS, ABOUT = range(2)


def _chunk_rows(segments: int, model: Filter, total: float, kinds: float):
    """Per chunk: its words by segment, with training counts and the texts they are in; its texts with their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, chunk in enumerate(chunks(batches)):
            data, bounds = raw(chunk.column("text"))
            tokens, starts = with_ends(words(translated(data, LOWER), bounds))
            block = part << 24 | number
            rows: list[dict] = []
            distinct_words, place = np.unique(tokens, return_inverse=True)
            count = chunk.num_rows
            keys = np.sort(place * count + np.repeat(np.arange(count), np.diff(starts)))
            first = np.flatnonzero(distinct(keys))
            use = np.diff(np.append(first, len(keys)))
            word, owner = np.divmod(keys[first], count)
            trains = ~chunk.column("held_out").to_numpy(zero_copy_only=False)
            trained = np.bincount(word, weights=use * trains[owner], minlength=len(distinct_words)).astype(np.int64)
            texts = np.bincount(word, minlength=len(distinct_words))
            ends = np.concatenate([[0], np.cumsum(texts)])
            for segment, a, b in _cuts(distinct_words, segments):
                rows.append(
                    {
                        "segment": segment, "block": block, "kind": WORDS,
                        "grams": distinct_words[a:b].tobytes(), "times": _small(trained[a:b]), "texts": _small(texts[a:b]),
                        "owners": owner[ends[a] : ends[b]].astype(np.uint16).tobytes(), "uses": _small(use[ends[a] : ends[b]]),
                    }
                )
            about = {"doc_id": chunk.column("doc_id"), "held_out": chunk.column("held_out"), "n_tokens": np.diff(starts)}
            pairs = pair_hashes(tokens, starts)
            alone = model.counts(np.append(distinct_words, START_HASH))
            every = alone[place]
            before = _contexts(every, alone[-1], starts)
            about["score"] = _mixed(every, model.counts(pairs), before, starts, total, kinds)
            rows.append({"segment": block % segments, "block": block, "kind": ABOUT, "about": _packed(pa.record_batch(about))})
            yield pa.RecordBatch.from_pylist(rows, CHUNK_ROWS)

    return run


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


BLOCK_ROWS = pa.schema(
    [("block", pa.int64()), ("kind", pa.int32()), ("texts", pa.binary()), ("logs", pa.binary())]
    + [("known", pa.binary()), ("about", pa.binary())]
)
BLOCK_DDL = "block long, kind int, texts binary, logs binary, known binary, about binary"


def _word_sums(table: pa.Table) -> pa.Table:
    """Exact training counts of a segment's words, and by block what they add to its texts."""
    rows = table.to_pylist()
    words_of = [r for r in rows if r["kind"] == WORDS]
    out = [{"block": r["block"], "kind": ABOUT, "about": r["about"]} for r in rows if r["kind"] == ABOUT]
    if words_of:
        grams = [np.frombuffer(r["grams"], np.uint64) for r in words_of]
        every, count = _summed(grams, [_large(r["times"], len(g)) for r, g in zip(words_of, grams)])
        logs = np.log10(count + ALPHA)
        for r, own in zip(words_of, grams):
            at = np.repeat(np.searchsorted(every, own), _large(r["texts"], len(own)))
            owner = np.frombuffer(r["owners"], np.uint16)
            use = _large(r["uses"], len(owner))
            texts, place = np.unique(owner, return_inverse=True)
            total = np.bincount(place, use * logs[at])
            known = np.bincount(place, use * (count[at] > 0)).astype(np.int64)
            out.append(
                {"block": r["block"], "kind": WORDS, "texts": texts.tobytes(), "logs": total.tobytes(), "known": _small(known)}
            )
    return pa.Table.from_pylist(out, BLOCK_ROWS)


def _scored_texts(total: float, kinds: float):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        about = pa.ipc.open_stream(next(r["about"] for r in rows if r["kind"] == ABOUT)).read_all()
        count = about.num_rows
        tokens = about.column("n_tokens").to_numpy()
        logs, known = np.zeros(count), np.zeros(count, np.int64)
        for r in sorted((r for r in rows if r["kind"] == WORDS), key=lambda r: r["logs"]):
            texts = np.frombuffer(r["texts"], np.uint16)
            logs[texts] += np.frombuffer(r["logs"], np.float64)
            known[texts] += _large(r["known"], len(texts))
        return _results(about, tokens, known, logs, about.column("score").to_numpy(), total, kinds)

    return run


def _results(
    about: pa.Table | pa.RecordBatch, tokens: np.ndarray, known: np.ndarray, logs: np.ndarray, score: np.ndarray, total: float, kinds: float
) -> pa.Table:
    """``logs``: the sum of the logarithms of each text's smoothed word counts."""
    return pa.table(
        {
            "doc_id": about.column("doc_id"),
            "held_out": about.column("held_out"),
            "n_tokens": pa.array(tokens, pa.int64()),
            "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array([int(total)] * about.num_rows, pa.int64()),
            "base_score": logs - tokens * np.log10(total + ALPHA * (kinds + 1)),
            "score": score,
        }
    )


def _block_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block of texts: its chunks, packed."""
    part = TaskContext.get().partitionId()

    def packed(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            for chunk in held:
                writer.write_batch(chunk)
        return pa.record_batch({"block": [part << 24 | number], "about": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    number, size, held = 0, 0, []
    for chunk in chunks(batches):
        own = int(raw(chunk.column("text"))[1][-1])
        if held and size + own > BLOCK_BYTES:
            yield packed(number, held)
            number, size, held = number + 1, 0, []
        size, held = size + own, [*held, chunk]
    if held:
        yield packed(number, held)


def _tokens(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = raw(chunk.column("text"))
    return with_ends(words(translated(data, LOWER), bounds))


def _placed(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, and the place of each n-gram among them."""
    every, place = np.unique(grams, return_inverse=True)
    return every, place.astype(np.uint32)


def _squeezed(grams: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted n-grams and their counts. N-grams are kept as distances, whose low bytes do not get smaller."""
    gaps = np.diff(grams, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    rest = zlib.compress(gaps[:, PLAIN_BYTES:].T.tobytes() + _small(times), 1)
    return len(grams).to_bytes(4, "little") + gaps[:, :PLAIN_BYTES].tobytes() + rest


def _unsqueezed(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    count, high = int.from_bytes(packed[:4], "little"), 8 - PLAIN_BYTES
    gaps = np.empty((count, 8), np.uint8)
    gaps[:, :PLAIN_BYTES] = np.frombuffer(packed, np.uint8, count * PLAIN_BYTES, 4).reshape(count, PLAIN_BYTES)
    rest = zlib.decompress(packed[4 + count * PLAIN_BYTES :])
    gaps[:, PLAIN_BYTES:] = np.frombuffer(rest, np.uint8, count * high).reshape(high, count).T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64), _large(rest[count * high :], count)


def _block_rows(segments: int):
    """Per block and segment: its words and its pairs, each with its count in the block's training texts, which is 0
    for those of held-out texts only; and in one segment the number of training texts, as the count of their start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, about in ((b, a) for batch in batches for b, a in zip(*(c.to_pylist() for c in batch.columns))):
            own: list[list] = [[], []]
            begins = 0
            for chunk in pa.ipc.open_stream(about):
                tokens, starts = _tokens(chunk)
                trains = ~chunk.column("held_out").to_numpy(zero_copy_only=False)
                begins += int(trains.sum())
                weight = np.repeat(trains, np.diff(starts)).astype(np.int64)
                for held, grams in zip(own, (tokens, pair_hashes(tokens, starts))):
                    held.append(_summed([grams], [weight]))
            every = [_summed(*zip(*own.pop(0))) for _ in range(2)]
            cuts = [{segment: (a, b) for segment, a, b in _cuts(grams, segments)} for grams, _ in every]
            home = int(_segment(np.array([START_HASH]), segments)[0])
            rows = []
            for segment in sorted({*cuts[0], *cuts[1], home}):
                packed = []
                for (grams, times), at in zip(every, cuts):
                    a, b = at.get(segment, (0, 0))
                    packed.append(_squeezed(grams[a:b], times[a:b]))
                rows.append((segment, block, *packed, begins if segment == home else None))
            del every
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), ASKED_ROWS.types)], schema=ASKED_ROWS)
            del rows
            give_back()

    return run


ASKED_ROWS = pa.schema(
    [("segment", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("pairs", pa.binary()), ("begins", pa.int64())]
)
ASKED_DDL = "segment long, block long, words binary, pairs binary, begins long"
ANSWER_ROWS = pa.schema(
    [("block", pa.int64()), ("segment", pa.int64()), ("words", pa.binary()), ("times", pa.binary()), ("pairs", pa.binary())]
    + [("begins", pa.int32()), ("tokens", pa.int64()), ("kinds", pa.int64())]
)
ANSWER_DDL = "block long, segment long, words binary, times binary, pairs binary, begins int, tokens long, kinds long"


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of several lists, their summed counts, and the place of each list's n-grams among them."""
    every, weight = (np.concatenate(own) for own in zip(*parts))
    order = np.argsort(every)
    every = every[order]
    new = distinct(every)
    place = np.empty(len(every), np.uint32)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return every[first], np.add.reduceat(weight[order], first) if len(first) else weight, place


def _answered(table: pa.Table) -> pa.Table:
    """One segment's filter is built, and its levels of the n-grams that blocks ask for are returned, with the words'
    exact counts. The first row has how many tokens and distinct words the segment stands for."""
    blocks, segment = table.column("block").to_pylist(), table.column("segment")[0].as_py()
    grams, total, place, ends = [], [], [], []
    for kind in ("words", "pairs"):
        parts = [_unsqueezed(own) for own in table.column(kind).to_pylist()]
        ends.append(np.cumsum([len(g) for g, _ in parts])[:-1])
        for held, own in zip((grams, total, place), _merged(parts)):
            held.append(own)
        del parts
    starting = [b for b in table.column("begins").to_pylist() if b is not None]
    grams.append(np.full(min(len(starting), 1), START_HASH))
    total.append(np.array([sum(starting)][: len(starting)], np.int64))
    every, often = np.concatenate(grams), [t >= least for t, least in zip(total, (1, max(1, MIN_COUNT), max(1, MIN_COUNT)))]
    seen = np.concatenate(often)
    field = build_segment(every[seen], np.concatenate(total)[seen])
    levels = Filter([len(field)], field.tobytes()).levels(every).astype(np.uint8)
    of_words, of_pairs, of_start = np.split(levels, np.cumsum([len(g) for g in grams])[:-1])
    answers = [(of_words[p], total[0][p]) for p in np.split(place[0], ends[0])]
    asks = [b is not None for b in table.column("begins").to_pylist()]
    out = {
        "block": blocks,
        "segment": [segment] * len(blocks),
        "words": [zlib.compress(level.tobytes(), 1) for level, _ in answers],
        "times": [zlib.compress(_small(times), 1) for _, times in answers],
        "pairs": [zlib.compress(of_pairs[p].tobytes(), 1) for p in np.split(place[1], ends[1])],
        "begins": [int(of_start[0]) if own else None for own in asks],
        "tokens": [int(total[0].sum())] + [None] * (len(blocks) - 1),
        "kinds": [int(often[0].sum())] + [None] * (len(blocks) - 1),
    }
    del grams, total, place, answers, every
    give_back()
    return pa.table(out, schema=ANSWER_ROWS)


def _scored_blocks(total: float, kinds: float):
    """The texts of a block, scored by what the segments have answered."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["segment", "words", "times", "pairs", "begins"]).filter(table.column("segment").is_valid())
        rows = sorted(rows.to_pylist(), key=lambda r: r["segment"])
        of_words, times, of_pairs = ([zlib.decompress(r[c]) for r in rows] for c in ("words", "times", "pairs"))
        exact = np.concatenate([_large(t, len(level)) for t, level in zip(times, of_words)])
        alone, pair = (_expected(np.frombuffer(b"".join(own), np.uint8)) for own in (of_words, of_pairs))
        begins = float(_expected(np.array([r["begins"] for r in rows if r["begins"] is not None]))[0])
        logs, known = np.log10(exact + ALPHA), (exact > 0).astype(np.int64)
        found = []
        for chunk in pa.ipc.open_stream(table.column("about").drop_null()[0].as_py()):
            tokens, starts = _tokens(chunk)
            own = [_placed(grams) for grams in (tokens, pair_hashes(tokens, starts))]
            found.append((chunk.select(["doc_id", "held_out"]), starts, own))
            del tokens
        every = [_counted(np.concatenate([own[kind][0] for _, _, own in found]))[0] for kind in range(2)]
        out = []
        while found:
            chunk, starts, own = found.pop(0)
            at, pair_at = (np.searchsorted(grams, some)[back] for grams, (some, back) in zip(every, own))
            score = _mixed(alone[at], pair[pair_at], _contexts(alone[at], begins, starts), starts, total, kinds)
            sums = [np.add.reduceat(values[at], starts[:-1]) for values in (known, logs)]
            out.append(_results(chunk, np.diff(starts), *sums, score, total, kinds))
        give_back()
        return pa.concat_tables(out)

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text)`` by what the rows that are not held out teach.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (with the end), ``n_known`` (tokens that occur in
    training), ``train_tokens``, ``base_score`` (log10 probability by smoothed word frequency) and
    ``score`` (by the filter). NULL and empty texts are one token, their end. Repeated rows are
    counted and scored each. An empty table gives no rows; if all rows are held out, all counts are 0.
    Words are told apart by 64-bit hashes.

    ``docs`` is read three times and should come from files or a written table. The filter is sent to the
    workers if it has ``filter_bytes`` at most, and the text ``TEXT_TIMES`` times as many; else its segments answer.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim = slim.withColumn("held_out", held_out(F.col("doc_id")))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(1, min(size // SEGMENT_BYTES, 1 << 23))
    if size > TEXT_TIMES * filter_bytes:
        return _answered_scores(slim, segments)
    with shuffles_removed(spark):
        learned = cut(
            slim.where("not held_out")
            .mapInArrow(_ngram_rows(segments), "segment long, kind int, grams binary, times binary")
            .groupBy("segment")
            .applyInArrow(_segment_filter, "segment long, field binary, tokens long, kinds long")
        )
    total, kinds, held = learned.agg(F.sum("tokens"), F.sum("kinds"), F.sum(F.octet_length("field"))).first()
    total, kinds = float(total or 0), float(kinds or 0)
    if (held or 0) > filter_bytes:
        return _answered_scores(slim, segments)
    fields = {r["segment"]: r["field"] for r in learned.select("segment", "field").collect()}
    sizes = [len(fields.get(s, b"")) for s in range(segments)]
    sent = spark.sparkContext.broadcast(b"".join(fields.get(s, b"") for s in range(segments)))
    del fields

    def with_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _chunk_rows(segments, Filter(sizes, sent.value), total, kinds)(batches)

    schema = "segment long, block long, kind int, grams binary, times binary, texts binary, owners binary, uses binary, about binary"
    sums = slim.mapInArrow(with_filter, schema).groupBy("segment").applyInArrow(_word_sums, BLOCK_DDL)
    return sums.groupBy("block").applyInArrow(_scored_texts(total, kinds), SCORED)


def _answered_scores(slim: DataFrame, segments: int) -> DataFrame:
    """The scores where the filter is too large to be sent: blocks' n-grams go to its segments, and levels come back.

    The blocks are written, so that what is answered and what is scored are the same texts however often the
    input is read."""
    small_batches(slim.sparkSession)
    blocks = cut(slim.mapInArrow(_block_texts, "block long, about binary"))
    with shuffles_removed(slim.sparkSession):
        answers = cut(blocks.mapInArrow(_block_rows(segments), ASKED_DDL).groupBy("segment").applyInArrow(_answered, ANSWER_DDL))
    total, kinds = (float(v or 0) for v in answers.agg(F.sum("tokens"), F.sum("kinds")).first())
    every = answers.drop("tokens", "kinds").unionByName(blocks, allowMissingColumns=True)
    return every.groupBy("block").applyInArrow(_scored_blocks(total, kinds), SCORED)
