"""Words of whole texts as arrays, shared by the operators that run Arrow batches.

A word is a longest run of bytes other than space and the bytes 9 to 13; in UTF-8 these bytes occur
as themselves only, so cutting bytes and cutting code points give the same words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: The words of all operators, as a pattern that Java, Python and DuckDB read alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that are taken apart at once; bounds a task's memory, not what is read.
CHUNK_BYTES = 4 << 20
CHUNK_ROWS = 32_000

#: Spark's limit of what a batch of rows holds on its way to Python, and what it is lowered to.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

_WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: Byte tables: A-Z in lower case; whether a byte is white space; a byte's weight in its word's hash
#: (white space none, the byte 255 does not occur in UTF-8).
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACE = bytes(b in _WHITE for b in range(256))
SOLID = bytes(0 if b in _WHITE else min(b + 1, 255) for b in range(256))
#: Weights of the places of a word's bytes.
POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))
#: Bytes whose hashes are computed at once.
PIECE = 1 << 19


def translated(data: np.ndarray, table: bytes) -> np.ndarray:
    """``data`` with each byte looked up in a table."""
    return np.frombuffer(data.tobytes().translate(table), np.uint8)


@dataclass
class Words:
    """The words of several texts, in order: word ``j`` is ``data[begin[j]:end[j]]``, and text ``i``
    has the words ``starts[i]`` to ``starts[i + 1]``."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    starts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: its bytes as the coefficients of a polynomial, scattered."""
        found = np.empty(len(self.begin), np.uint64)
        steps = np.searchsorted(self.begin, np.arange(0, len(self.data) + PIECE, PIECE))
        for a, b in zip(steps[:-1], steps[1:]):
            if a < b:
                first = self.begin[a]
                begin = self.begin[a:b] - first
                data = translated(self.data[first : self.end[b - 1]], SOLID)
                place = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
                total = np.add.reduceat(data * POWERS[place & (len(POWERS) - 1)], begin)
                found[a:b] = mix(total + (self.end[a:b] - self.begin[a:b]).astype(np.uint64))
        return found

    def dictionary(self) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The distinct words, and the place of each word among them."""
        size = self.end - self.begin
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        solid = self.data[translated(self.data, SPACE) == 0]
        array = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(solid)]
        ).dictionary_encode()
        return array.dictionary, array.indices.to_numpy()


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and where each begins; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray) -> Words:
    """The words of the texts that lie in ``data`` between the ``bounds``."""
    solid = translated(data, SPACE) == 0
    edges = bounds[1:-1][bounds[1:-1] < len(data)]  # where a text begins or the one before it ends
    opens, shuts = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    opens[edges] = solid[edges]
    shuts[:-1] &= ~solid[1:]
    shuts[edges[edges > 0] - 1] = solid[edges[edges > 0] - 1]
    begin = np.flatnonzero(opens)
    return Words(data, begin, np.flatnonzero(shuts) + 1, np.searchsorted(begin, bounds))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``CHUNK_BYTES`` of text; a longer text is a piece by itself."""
    for batch in batches:
        _, bounds = raw(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(bounds, bounds[first] + CHUNK_BYTES, "right")) - 1
            last = min(max(last, first + 1), first + CHUNK_ROWS, batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def mix(value: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values: the finishing steps of a public-domain generator (splitmix64)."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def distinct(ordered: np.ndarray) -> np.ndarray:
    """Marks the first of equal neighbours."""
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return first


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbours, by the place of its first; runs may cross texts."""
    count = max(0, len(hashes) - size + 1)
    value = np.full(count, size, np.uint64)
    for i in range(size):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count])
    return value


def small_batches(spark: SparkSession) -> None:
    """Lets rows travel to Python in batches of at most ``BATCH_BYTES``; a longer row is a batch by itself.

    This lowers a setting of the session, and never raises it. It changes no result: what is bounded
    is the memory on both sides, of which a batch takes several times its size.
    """
    own = spark.conf.get(BATCH_SETTING)
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own)) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Return what this Python process has freed, but not given back, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
