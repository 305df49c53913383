"""Exact grouped median that never gathers a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _holds_middle() -> Column:
    """Whether rows counted up to ``_upto`` hold one of the middle ranks, which count from 0."""
    return (F.col("_upto") > _low()) & (F.col("_upto") - F.col("_n") <= _high())


def _low() -> Column:
    return F.expr("(_total - 1) div 2")


def _high() -> Column:
    return F.expr("_total div 2")


def _within(
    pieces: DataFrame, starts: DataFrame, keys: list[str], outer: str, inner: str
) -> DataFrame:
    """Running counts of the ``inner`` pieces of those ``outer`` pieces that ``starts`` names.

    A start has the rows before its piece as ``_n`` and the group's ``_total``. It sorts first, for its
    ``inner`` is NULL, and so begins the count; pieces without one get no total and fall out.
    """
    piece = Window.partitionBy(*keys, outer)
    upto = piece.orderBy(F.asc_nulls_first(inner)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        pieces.unionByName(starts, allowMissingColumns=True)
        .select(
            *keys,
            inner,
            "_n",
            F.max("_total").over(piece).alias("_total"),
            F.sum("_n").over(upto).alias("_upto"),
        )
        .filter(F.col(inner).isNotNull() & _holds_middle())
    )


def _starts(middle: DataFrame, keys: list[str], piece: str) -> DataFrame:
    return middle.select(*keys, piece, (F.col("_upto") - F.col("_n")).alias("_n"), "_total")


def grouped_median(
    frame: DataFrame, keys: list[str], value: str, weight: str | None = None
) -> DataFrame:
    """Median and row count of a ``decimal(18,6)`` column per ``keys`` (which must not be NULL).

    The built-in exact percentile merges every distinct value of a group in one task. Here the
    values are first counted per (keys, value), with map-side combine, and the middle is found in
    three narrowing steps: over blocks of a million units, over the units of the blocks that hold the
    middle ranks, and over the values of those units. ``decimal(18,6)`` has at most a million blocks
    of either sign, a million units per block and a million values per unit, so no window ever orders
    more than about two million pre-counted rows, however many rows a group has.

    ``weight`` names a column of row counts when ``frame`` is already counted.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = (
        frame.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(n.alias("_n"))
        .withColumn("_unit", F.floor("_value").cast("bigint"))
        .withColumn("_block", F.expr("_unit div 1000000"))
    )
    units = counts.groupBy(*keys, "_block", "_unit").agg(F.sum("_n").alias("_n"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    upto = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = (
        units.groupBy(*keys, "_block")
        .agg(F.sum("_n").alias("_n"))
        .withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(group)})
        .filter(_holds_middle())
    )
    middle = _within(units, _starts(blocks, keys, "_block"), keys, "_block", "_unit")
    values = counts.select(*keys, "_unit", "_value", "_n")
    last, first = F.col("_upto") - 1, F.col("_upto") - F.col("_n")
    covered = F.least(last, _high()) - F.greatest(first, _low()) + 1
    return (
        _within(values, _starts(middle, keys, "_unit"), keys, "_unit", "_value")
        .groupBy(*keys, "_total")
        .agg(
            (F.sum(F.col("_value") * covered) / F.sum(covered))
            .cast("decimal(24,7)")
            .cast("double")
            .alias("median")
        )
        .withColumnRenamed("_total", "n")
    )
