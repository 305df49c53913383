"""As-of join: the latest strictly earlier row of another frame, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions.expr import minute_start

UNTIMED_PIECES = 64
#: What lies between "strictly earlier" and "now".
TICK = "interval '0.000001' second"


def asof_last(
    rows: DataFrame,
    others: DataFrame,
    *,
    by: str,
    at: str,
    other_at: str,
    value: str,
    bucket=minute_start,
) -> DataFrame:
    """Add ``other_at`` and ``value`` of the latest ``others`` row with ``other_at < at``.

    Equal times resolve to the largest ``value``; rows without a match, or without a time, get NULLs.
    """
    keep = [c for c in rows.columns if c != by]
    asking = rows.select(
        F.col(by).alias("_key"), F.col(at).alias("_at"), F.lit(True).alias("_asks"), *keep
    )
    seen = others.select(
        F.col(by).alias("_key"),
        F.col(other_at).alias("_at"),
        F.lit(False).alias("_asks"),
        F.struct(F.col(other_at).alias("at"), F.col(value).alias("value")).alias("_seen"),
    )
    timeline = asking.unionByName(seen, allowMissingColumns=True)
    return _matched(timeline, by, keep, other_at, value, bucket)


def asof_last_within(
    rows: DataFrame,
    *,
    by: str,
    at: str,
    asks: Column,
    seen: Column,
    other_at: str,
    value: str,
    id_of_seen: str,
    bucket=minute_start,
) -> DataFrame:
    """:func:`asof_last` where both sides are rows of one frame.

    The rows for which ``asks`` holds get the time and ``id_of_seen`` of the latest strictly earlier row
    for which ``seen`` holds, as ``other_at`` and ``value``. A row may be both. Rows stay single and
    keep their columns as they are: one scan for the answers, a narrow one for the summary.
    """
    keep = [c for c in rows.columns if c != by]
    last = F.struct(F.col(at).alias("at"), F.col(id_of_seen).alias("value"))
    timeline = rows.filter(asks | seen).select(
        F.col(by).alias("_key"),
        F.col(at).alias("_at"),
        F.coalesce(asks, F.lit(False)).alias("_asks"),
        F.when(seen & F.col(at).isNotNull(), last).alias("_seen"),
        *keep,
    )
    return _matched(timeline, by, keep, other_at, value, bucket)


def _matched(
    timeline: DataFrame, by: str, keep: list[str], other_at: str, value: str, bucket
) -> DataFrame:
    """The askers of a timeline with their matches.

    One key may own a large share of all rows, so the timeline is cut into (key, bucket) pieces
    and a window never orders a whole key. What a bucket must know about the past is one "carry"
    row: the last match of all earlier buckets, found on a summary that holds a single row per
    (key, bucket). That makes three shuffles, none of which gathers a key's rows in one task.
    The latest match is the largest (time, value) among what is strictly earlier.
    Askers without a time match nothing; they are spread over pieces of their own.
    """
    untimed = F.col("_at").isNull()
    spread = F.when(untimed, F.pmod(F.monotonically_increasing_id(), F.lit(UNTIMED_PIECES)))
    timeline = timeline.filter(~untimed | F.col("_asks")).withColumns(
        {"_bucket": bucket("_at"), "_spread": spread}
    )

    # Rows of both sides take part, so that every bucket that will be asked gets a carry row.
    earlier = (
        Window.partitionBy("_key")
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        timeline.filter(~untimed)
        .groupBy("_key", "_bucket")
        .agg(F.max("_seen").alias("_newest"))
        .select(
            "_key",
            "_bucket",
            (F.col("_bucket") - F.expr(TICK)).alias("_at"),
            F.lit(False).alias("_asks"),
            F.last("_newest", ignorenulls=True).over(earlier).alias("_seen"),
        )
        .filter(F.col("_seen").isNotNull())
    )
    match = F.expr(
        "max(_seen) OVER (PARTITION BY _key, _bucket, _spread ORDER BY _at "
        f"RANGE BETWEEN UNBOUNDED PRECEDING AND {TICK.upper()} PRECEDING)"
    )
    return (
        timeline.unionByName(carry, allowMissingColumns=True)
        .withColumn("_match", match)
        .filter("_asks")
        .select(
            F.col("_key").alias(by),
            *keep,
            F.col("_match.at").alias(other_at),
            F.col("_match.value").alias(value),
        )
    )
