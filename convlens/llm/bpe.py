"""BPE encoding and decoding, by a walk through the trie of distinct words.

Method: a byte-level BPE encoding of a string is known from its *last token*: it is the token ``t``
that ends the string, follows the encoding of what stands before it, and does not merge with it.
So each state of a trie of words needs one token only. The distinct words of a batch are walked depth
first (in sorted order, which visits the trie's nodes without building it): the states of the prefix
that a word shares with the one before it are kept, and only the rest is computed. A word's ids are
read off its states from the end.

Whether two neighbouring tokens stay apart is decided from the merges that made them: their pieces at
the seam are followed in the order in which merges happen, and the pair is impossible if two pieces
at the seam would merge with each other before one of them is used up.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.text import give_back, small_batches

#: Fixed value: how the byte-level vocabularies cut a text into words, for Java's regular expressions
#: (``(?U)`` makes white space mean all of Unicode's).
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct words whose encodings a task keeps between batches; then it starts anew.
KEPT_WORDS = 150_000
#: Pairs of tokens that a task remembers, likewise.
KEPT_PAIRS = 300_000
#: Rank of what uses up a whole token: nothing.
NEVER = 1 << 60
#: Words of texts that are put together at once.
CHUNK_WORDS = 250_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file: printable bytes for
    themselves, the others by the letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file, and the last-token walk over words."""

    def __init__(self, text: str):
        file = json.loads(text)
        letters = byte_letters()
        self.specials = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {i: s.encode() for s, i in self.specials.items()}
        self.id_of: dict[bytes, int] = {}
        for token, number in file["model"]["vocab"].items():
            if token not in self.specials:
                own = bytes(letters[c] for c in token)
                self.bytes_of[number] = own
                self.id_of[own] = number
        #: For a pair of tokens, the rank of its merge; for a token, the rank and halves it is made of.
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for number, merge in enumerate(file["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right = (self.id_of[bytes(letters[c] for c in x)] for x in (a, b))
            whole = self.id_of[self.bytes_of[left] + self.bytes_of[right]]
            self.rank[left, right] = number
            if whole not in self.made:
                self.made[whole] = (number, left, right)
        self.rights: dict[int, list[tuple[int, int]]] = {}
        self.lefts: dict[int, list[tuple[int, int]]] = {}
        #: For a pair of tokens, as one number, whether they can be neighbours.
        self.apart: dict[int, bool] = {}
        self.known: dict[bytes, bytes] = {}
        #: Tokens that their own bytes are encoded as; no other can be in an encoding.
        whole: dict[int, bool] = {}
        for token, (_, left, right) in sorted(self.made.items(), key=lambda x: x[1][0]):
            whole[token] = whole.get(left, True) and whole.get(right, True) and self._apart(left, right, True)
        #: A trie of those tokens from their last byte to their first: the node that follows another by
        #: a byte, and the token that a node's bytes are, or -1.
        self.back: dict[int, int] = {}
        self.token_at = [-1]
        for own, token in self.id_of.items():
            if whole.get(token, True):
                node = 0
                for byte in reversed(own):
                    node = self.back.setdefault(node << 8 | byte, len(self.token_at))
                    if node == len(self.token_at):
                        self.token_at.append(-1)
                self.token_at[node] = token

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one edge of a token, smallest first, each with the rank that uses it up."""
        kept = self.rights if side == 2 else self.lefts
        spine = kept.get(token)
        if spine is None:
            spine = [(token, NEVER)]
            if token in self.made:
                rank, half = self.made[token][0], self.made[token][side]
                inner = self._spine(half, side)
                spine = [*inner[:-1], (half, rank), *spine]
            kept[token] = spine
        return spine

    def _apart(self, left: int, right: int, until_whole: bool = False) -> bool:
        """Whether nothing at the seam of two tokens merges, not counting the two as wholes if so asked."""
        a, b = self._spine(left, 2), self._spine(right, 1)
        i = j = 0
        (x, used_x), (y, used_y) = a[0], b[0]
        rank = self.rank
        while True:
            last = used_x == used_y == NEVER
            if until_whole and last:
                return True
            merge = rank.get((x, y))
            # Merges of one rank run from left to right, so the left piece is used up first.
            if merge is not None and merge < used_x and merge <= used_y:
                return False
            if last:
                return True
            if used_x <= used_y:
                i += 1
                x, used_x = a[i]
            else:
                j += 1
                y, used_y = b[j]

    def walk(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """The ids of distinct words, depth first through their trie.

        A state per prefix of the word at hand: the token that its encoding ends with, and its length.
        """
        back, token_at, apart = self.back.get, self.token_at, self.apart
        before, states = b"", [(-1, 0)]
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                node, begin, fits = 0, end, []
                while begin:
                    node = back(node << 8 | word[begin - 1])
                    if node is None:
                        break
                    begin -= 1
                    if token_at[node] >= 0:
                        fits.append(begin)
                        fits.append(token_at[node])
                while fits:
                    token = fits.pop()
                    begin = fits.pop()
                    if begin:
                        left = states[begin][0]
                        stays = apart.get(left << 32 | token)
                        if stays is None:
                            stays = apart[left << 32 | token] = self._apart(left, token)
                        if not stays:
                            continue
                    states.append((token, end - begin))
                    break
                else:
                    raise ValueError(f"the vocabulary has no token for byte {word[end - 1]}")
            before, at, ids = word, len(word), []
            while at:
                token, size = states[at]
                ids.append(token)
                at -= size
            yield word, ids[::-1]

    def encodings(self, words: list[bytes]) -> list[bytes]:
        """Per distinct word its ids, as 32-bit numbers in a row."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = words
        if len(self.apart) > KEPT_PAIRS:
            self.apart.clear()
        for word, ids in self.walk(new):
            self.known[word] = np.array(ids, np.int32).tobytes()
        return [self.known[w] for w in words]

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens in a row, and where each id's bytes begin."""
        count = max(self.bytes_of) + 1
        parts = [self.bytes_of.get(i, b"") for i in range(count)]
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


@lru_cache(maxsize=4)
def vocabulary(text: str) -> Vocabulary:
    """One per process and file, so that a task goes on with what the one before it has computed."""
    return Vocabulary(text)


def _gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``values[begin[i] : begin[i] + size[i]]``, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begin - (ends - size), size) + np.arange(total)]


def _with(batch: pa.RecordBatch, drop: str, name: str, values: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(drop)
    if drop == name:
        return batch.set_column(at, name, values)
    return batch.append_column(name, values) if at < 0 else batch.remove_column(at).append_column(name, values)


def _encoded(batches: Iterator[pa.RecordBatch], own: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Puts ``ids`` in the place of ``words``."""
    special = {s.encode(): np.array([i], np.int32).tobytes() for s, i in own.specials.items()}
    for batch in batches:
        ends = np.cumsum(np.diff(batch.column("words").offsets.to_numpy()))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + CHUNK_WORDS, "right")))
            piece = batch.slice(first, last - first)
            coded = piece.column("words").flatten().cast(pa.binary()).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            plain = iter(own.encodings([w for w in distinct if w not in special]))
            ids = [special[w] if w in special else next(plain) for w in distinct]
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            begin = np.cumsum(sizes) - sizes
            code = coded.indices.to_numpy()
            flat = _gathered(np.frombuffer(b"".join(ids), np.int32), begin[code], sizes[code])
            counts = np.concatenate([[0], np.cumsum(sizes[code])])
            bounds = counts[np.concatenate([[0], ends[first:last] - done])]
            yield _with(piece, "words", "ids", pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)))
            first = last


def _decoded(batches: Iterator[pa.RecordBatch], own: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Appends ``decoded`` to the rows with ``ids``; bytes that are not UTF-8 become U+FFFD."""
    letters, begin = own.table
    for batch in batches:
        ids = batch.column("ids")
        flat = ids.flatten().to_numpy()
        counts = np.diff(ids.offsets.to_numpy())
        sizes = begin[flat + 1] - begin[flat]
        text = _gathered(letters, begin[flat], sizes).tobytes()
        before = np.concatenate([[0], np.cumsum(sizes)])
        bounds = before[np.concatenate([[0], np.cumsum(counts)])].tolist()
        texts = [text[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:])]
        yield batch.append_column("decoded", pa.array(texts, pa.string()))


def text_words(specials: list[str], text: str = "text") -> Column:
    """The words of a text as the vocabulary cuts them; special tokens are words of their own."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    cut = lambda c: F.regexp_extract_all(c, F.lit(PATTERN), F.lit(0))
    if not specials:
        return cut(whole)
    any_special = "|".join(java_literal(s) for s in specials)
    parts = F.split(whole, f"(?<={any_special})|(?={any_special})")
    split = F.flatten(F.transform(parts, lambda p: F.when(p.isin(specials), F.array(p)).otherwise(cut(p))))
    found = F.lit(False)
    for s in specials:
        found = found | F.contains(whole, F.lit(s))
    return F.when(found, split).otherwise(cut(whole))


def java_literal(text: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def encode(docs: DataFrame, tokenizer: str, decode_too: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int) in the place of ``text``, and ``decoded`` if asked for.

    ``tokenizer``: path of a byte-level BPE file, read on the driver and sent to the tasks; its size
    bounds what is sent. Ids are those of the file's own library without added special tokens at the
    ends; a special token's string in a text is that token. Rows meet no shuffle.

    NULL and empty texts have no ids; long texts are encoded whole, the longer ones in a batch by themselves. Repeated rows are
    encoded each, an empty table gives an empty one. Columns called as the new ones are replaced, others are kept, whatever their names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())
    new = ["ids", *(["decoded"] if decode_too else [])]
    rest = [c for c in docs.columns if c != "text" and c not in new]
    own = [f"c{i}" for i in range(len(rest))]
    found = text_words(list(vocabulary(sent.value).specials))
    kept = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(rest, own, strict=True)], found.alias("words"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "words"]
    schema = ", ".join([*fields, "ids array<int>", *(["decoded string"] if decode_too else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what other stages' tasks left in this process
        coder = vocabulary(sent.value)
        coded = _encoded(batches, coder)
        yield from _decoded(coded, coder) if decode_too else coded

    return kept.mapInArrow(run, schema).toDF(*rest, *new)


def decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """``coded`` with the text of its ``ids`` as ``decoded``."""
    with open(tokenizer, encoding="utf-8") as file:
        sent = coded.sparkSession.sparkContext.broadcast(file.read())
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema), "decoded string"])
    return coded.mapInArrow(lambda batches: _decoded(batches, vocabulary(sent.value)), schema)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row of ``docs(doc_id, text)``."""
    coded = encode(docs.select("doc_id", "text"), tokenizer, decode_too=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
