"""Quality rules: an ordered list of threshold conjunctions, learned by sequential covering.

Method: statistics of each document are compared with labels. A rule that rejects grows one
threshold condition at a time on two thirds of the labelled rows, by the gain in information about
the rejected class, and is pruned on the last third; rows it covers are set aside and the next rule
is learned, until a rule is no better than chance on the rows held back. The list is handed out as
one Spark conditional expression, so that judging documents is a projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.text import SPACE, chunks, mix, raw, translated, windows, words

SYMBOLS = bytes(b in b"#*$%&|<>" for b in range(256))
#: Bytes that begin a code point of a word.
LETTERS = bytes(not SPACE[b] and b & 0xC0 != 0x80 for b in range(256))
#: Length of the windows whose repetition counts.
WINDOW = 5
#: Labelled rows that the rules are learned from, at most; which ones is decided by a hash.
LABELLED_ROWS = 20_000
#: A rule must be right about this share of the held-back rows it covers.
PRECISION = 0.8
#: Conditions that one rule may have, and rules that a list may have.
CONDITIONS, RULES = 4, 16
#: Thresholds that are tried per statistic: so many quantiles of the rows not yet covered.
THRESHOLDS = 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What rules are made of, from the counts; a text without words has 0.
RATIOS = {
    "n_words": "double(n_words)",
    "mean_word": "if(n_words > 0, word_chars / n_words, 0D)",
    "symbol_share": "if(n_words > 0, n_symbols / n_words, 0D)",
    "dup_line_share": "if(n_words > 0, n_dup_lines / n_words, 0D)",
    "repeat_share": "if(n_words > 0, n_repeat_words / n_words, 0D)",
}


def _repeated_words(hashes: np.ndarray, owners: np.ndarray, count: int) -> np.ndarray:
    """Per text, the words in windows that its text holds twice or more."""
    if len(hashes) < WINDOW:
        return np.zeros(count, np.int64)
    runs = windows(hashes, WINDOW)
    inside = owners[: len(runs)] == owners[WINDOW - 1 :]
    keys = mix(runs + (owners[: len(runs)].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(inside)
    order = np.argsort(keys[at])
    ordered = keys[at][order]
    same = np.zeros(len(ordered), bool)
    equal = ordered[1:] == ordered[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    steps = np.zeros(len(hashes) + 1, np.int64)
    twice = at[order[same]]
    steps[twice] += 1
    steps[twice + WINDOW] -= 1
    return np.bincount(owners[np.cumsum(steps[:-1]) > 0], minlength=count)


def _repeated_lines(texts: list[str | None]) -> list[int]:
    found = []
    for text in texts:
        seen: set[str] = set()
        again = 0
        for line in (text or "").split("\n"):
            if line in seen:
                again += 1
            elif line.strip(" \t\n\r\x0b\x0c"):
                seen.add(line)
        found.append(again)
    return found


def _per_text(weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.zeros(len(weights) + 1, np.int32 if len(weights) < 1 << 31 else np.int64)
    np.cumsum(weights, out=before[1:])
    return before[bounds[1:]] - before[bounds[:-1]]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        data, bounds = raw(chunk.column("text"))
        found = words(data, bounds)
        count = chunk.num_rows
        yield pa.record_batch(
            {
                "doc_id": chunk.column("doc_id"),
                "th": chunk.column("th"),
                "n_words": pa.array(found.counts, pa.int64()),
                "word_chars": pa.array(_per_text(translated(data, LETTERS), bounds), pa.int64()),
                "n_symbols": pa.array(_per_text(translated(data, SYMBOLS), bounds), pa.int64()),
                "n_dup_lines": pa.array(_repeated_lines(chunk.column("text").to_pylist()), pa.int64()),
                "n_repeat_words": pa.array(_repeated_words(found.hashes(), found.owners, count), pa.int64()),
            }
        )


def statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, <COUNTS>)`` of every row; NULL text counts as empty, ``th`` hashes the text."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim = slim.withColumn("th", F.xxhash64("text"))
    return slim.mapInArrow(_statistics, "doc_id long, th long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    """The fixed rule: too few words, or over a fifth of them in repeated windows."""
    return F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def covers(self, values: dict[str, np.ndarray]) -> np.ndarray:
        own = values[self.statistic]
        return own >= self.threshold if self.at_least else own < self.threshold

    def sql(self) -> str:
        return f"{RATIOS[self.statistic]} {'>=' if self.at_least else '<'} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    every = np.ones(len(next(iter(values.values()))), bool)
    for condition in rule:
        every &= condition.covers(values)
    return every


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Adds the condition with the largest gain until no good row is covered or nothing gains."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < CONDITIONS and (bad & inside).any() and (~bad & inside).any():
        p, n = int((bad & inside).sum()), int((~bad & inside).sum())
        now = np.log2(p / (p + n))
        best, gain = None, 1e-9
        for name, own in values.items():
            cuts = np.unique(np.quantile(own[inside], np.linspace(0, 1, THRESHOLDS), method="nearest"))
            for threshold in cuts.tolist():
                for at_least in (True, False):
                    option = Condition(name, at_least, threshold)
                    kept = inside & option.covers(values)
                    p2, n2 = int((bad & kept).sum()), int((~bad & kept).sum())
                    if p2 and n2 + p2 < p + n:
                        here = p2 * (np.log2(p2 / (p2 + n2)) - now)
                        if here > gain:
                            best, gain = option, here
        if best is None:
            break
        rule += (best,)
        inside &= best.covers(values)
    return rule


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    inside = _covered(rule, values)
    p, n = int((bad & inside).sum()), int((~bad & inside).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(values: dict[str, np.ndarray], bad: np.ndarray, draw: np.ndarray) -> list[Rule]:
    """The decision list. ``draw``: a number in [0, 1) for each row that says where the row is used."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < RULES and (bad & left).sum() >= 3:
        grows, prunes = left & (draw < 2 / 3), left & (draw >= 2 / 3)
        pick = lambda rows: {k: v[rows] for k, v in values.items()}
        rule = _grow(pick(grows), bad[grows])
        held, held_bad = pick(prunes), bad[prunes]
        while len(rule) > 1:
            shorter = max((rule[:i] for i in range(1, len(rule))), key=lambda r: _worth(r, held, held_bad))
            if _worth(shorter, held, held_bad) < _worth(rule, held, held_bad):
                break
            rule = shorter
        inside = _covered(rule, held)
        if not rule or not inside.any() or held_bad[inside].mean() < PRECISION:
            break
        rules.append(rule)
        left &= ~_covered(rule, values)
    return rules


def learned_rules(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules that reject what ``labels(doc_id, quality)`` calls bad (quality 0).

    Learned from the statistics of at most ``LABELLED_ROWS`` labelled documents, chosen by a hash of
    their id; only these rows reach the driver. Rows without a label take no part, and of several
    labels the lowest counts. Labels of one kind only give no rules.
    """
    marks = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(LABELLED_ROWS)
    )
    ratios = [F.expr(sql).alias(name) for name, sql in RATIOS.items()]
    draw = (F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(3000)) / 3000).alias("draw")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = (
        statistics(slim.join(F.broadcast(marks), "doc_id", "left_semi"))
        .join(F.broadcast(marks), "doc_id")
        .where(~base_failed())
        .groupBy("doc_id").agg(F.min_by(F.struct("quality", *COUNTS), "th").alias("r"))
        .select("doc_id", "r.*")
        .select("doc_id", "quality", draw, *ratios)
        .toPandas()
        .sort_values("doc_id")
    )
    values = {name: rows[name].to_numpy(np.float64) for name in RATIOS}
    return learn(values, rows["quality"].to_numpy() == 0, rows["draw"].to_numpy(np.float64))


def verdict(rules: list[Rule]) -> Column:
    """Whether a row with the columns ``COUNTS`` is kept: the first rule that covers it rejects."""
    decided = F.when(base_failed(), False)
    for rule in rules:
        decided = decided.when(F.expr(" and ".join(c.sql() for c in rule)), False)
    return decided.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, <COUNTS>, base_failed, kept)`` of every row of ``docs(doc_id, text)``.

    A NULL text counts as empty, and so fails; repeated rows give a row each; an empty table gives
    none. The labelled rows are read first, then all rows once.
    """
    marked = {"base_failed": base_failed(), "kept": verdict(learned_rules(docs, labels))}
    return statistics(docs).withColumns(marked).drop("th")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The statistics are appended by row and used up, so rows meet no join: texts that are repeated are
    each judged, and a NULL text goes for having no words.
    """
    rules = learned_rules(docs, labels)
    names = [f"c{i}" for i in range(len(docs.columns))]
    position = docs.columns.index("text")
    plain = docs.toDF(*names)
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema), *(f"{c} long" for c in COUNTS)])

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, names[position]):
            text = chunk.column(position).cast(pa.string())
            slim = pa.record_batch({"doc_id": pa.nulls(len(text), pa.int64()), "th": pa.nulls(len(text), pa.int64()), "text": text})
            counts = pa.Table.from_batches(_statistics(iter([slim]))).combine_chunks()
            own = [counts.column(c).combine_chunks() for c in COUNTS]
            yield pa.RecordBatch.from_arrays([*chunk.columns, *own], names=[*names, *COUNTS])

    judged = plain.mapInArrow(append, schema).where(verdict(rules)).select(*names)
    return judged.toDF(*docs.columns)
