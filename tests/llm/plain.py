"""The operators once more, plainly, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter
from functools import cache

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Texts at the edges of what a column may hold.
ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r",
    "one",
    "One  two\tthree",
    "a b c d",
    "A b C d",
    "no break   spaces\x85 count as letters",
    "café 漢字 \U0001f389 <|endoftext|> tail",
    "x" * 5000,
    "word " * 300,
    "line one is here\nline one is here\n\nline one is here\n",
    "# * $ % & | < >",
]


def words(text: str | None, lower: bool = True) -> list[str]:
    return WORD.findall((text or "").translate(ASCII_LOWER) if lower else text or "")


def shingles(text: str | None, size: int) -> frozenset:
    found = words(text)
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def classes(rows: list[tuple[int | None, str | None]], size: int, num: int, den: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of each row, sorted."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            root[find(b)] = find(a)
    out = []
    for i, (doc, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(own, default=None) if sets[i] else doc))
    return sorted(out, key=str)


def base_scores(rows: list[tuple[int, str | None]]) -> dict[int, tuple]:
    counts: Counter = Counter()
    for doc, text in rows:
        if zlib.crc32(str(doc).encode()) % 10:
            counts.update([*words(text), ""])
    total, kinds = sum(counts.values()), len(counts)
    out = {}
    for doc, text in rows:
        tokens = [*words(text), ""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
        out[doc] = (zlib.crc32(str(doc).encode()) % 10 == 0, len(tokens), sum(counts[w] > 0 for w in tokens), total, base)
    return out


def pair_scores(rows: list[tuple[int, str | None]], ratio: float, prior: float) -> dict[int, float]:
    """log10 of each text's probability by words and pairs, from counts that are exact but for their levels."""

    def level(count: int) -> int:
        q = 1
        while ratio**q <= count:
            q += 1
        return q

    @cache
    def read(count: int) -> float:
        alike = [c for c in range(count // 2, 2 * count + 2) if c and level(c) == level(count)] if count else [0]
        return sum(alike) / len(alike)

    counts: Counter = Counter()
    pairs: Counter = Counter()
    texts = 0
    for doc, text in rows:
        if zlib.crc32(str(doc).encode()) % 10:
            tokens = [*words(text), ""]
            counts.update(tokens)
            pairs.update(zip([None, *tokens], tokens))
            texts += 1
    total, kinds = sum(counts.values()), len(counts)
    out = {}
    for doc, text in rows:
        tokens, score = [*words(text), ""], 0.0
        for before, word in zip([None, *tokens], tokens):
            alone = (read(counts[word]) + 0.1) / (total + 0.1 * (kinds + 1))
            context = read(texts if before is None else counts[before])
            score += math.log10((min(read(pairs[before, word]), context) + prior * alone) / (context + prior))
        out[doc] = score
    return out


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    found = words(text, lower=False)
    runs = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    inside = {j for i in range(len(found) - 4) if runs[tuple(found[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(inside)


def url_parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(ASCII_LOWER), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    """Rows (conv_id, turn, role, text) as conversations, each with the head of another one."""
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, name, (role, text)))
    lined = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in lined.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = lined.get(c - c % 5, [])[:h] + ts[h:]
    return out


def trie_rows(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """The rows of op11, by walking all prefixes."""
    members: dict[tuple, list[int]] = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids: dict[tuple, list[tuple]] = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in below)
        ends = sorted(c for c in members[node] if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        above = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), above, len(members[node]), len(below), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def clustered(rows: list[tuple], order, count: int, rounds: int, size: int, scale: int) -> list[tuple]:
    """(id, cluster, distance, cluster_inertia, inertia, digest) by assigning every vector in every round."""
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    middle = [v for _, v in sorted(kept, key=lambda r: (order(r[0]), r[1]))[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        middle = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(middle)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    own: Counter = Counter()
    for _, j, d in found:
        own[j] += d
    digest = {j: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for j, c in enumerate(middle)}
    return sorted(((i, j, d, own[j], sum(own.values()), digest[j]) for i, j, d in found), key=str)
