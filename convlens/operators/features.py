"""Point-in-time features for model training."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions.expr import dow, minute_number, trailing, ts_lit


def with_activity(
    visits: DataFrame, *, short_hours: int = 1, long_hours: int = 24
) -> DataFrame:
    """Each visit with its campaign's activity before it.

    ``campaign_visits_1h`` counts the campaign's visits in the open interval (t - 1 h, t), and
    ``campaign_cr_24h`` is their conversion rate over (t - 24 h, t), NULL if there are none.

    A range window per campaign would put a dominant campaign in one task. The timeline is cut
    into (campaign, minute) pieces instead, and a piece holds all that its visits need:

    * a carry row with the totals of the preceding 60 (or 1440) whole minutes, from a summary of
      one row per campaign and minute;
    * the visits themselves, counting +1 for those after them;
    * narrow copies of the visits one hour (one day) older, moved to the moment they leave the
      interval, where they count -1: the carry row still includes them.

    Running sums of these signed counts are the answers, so one shuffle of the visits and of two
    narrow copies does it, without a join. The visits are scanned once for these and once for the
    summary.
    """
    none = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    hit = F.when(F.col("is_conversion"), one).otherwise(none)
    at = F.col("visit_timestamp")
    timed = visits.withColumns({"_minute": minute_number(at), "_at": at, "_hit": hit})

    # A visit has left when it is exactly as old as the interval; the sums below take what is
    # strictly earlier, hence the microsecond.
    tick = F.expr("interval '0.000001' second")
    wide = [f for f in visits.schema.fields if f.name != "campaign_id"]

    def entry(minute, moment, short, long, hits, own: bool):
        """A signed count at a moment; only the visit itself carries its other columns."""
        return F.struct(
            *[(F.col(f.name) if own else F.lit(None).cast(f.dataType)).alias(f.name) for f in wide],
            minute.alias("_minute"),
            moment.alias("_at"),
            short.alias("_short"),
            long.alias("_long"),
            hits.alias("_hit"),
            F.lit(own).alias("_own"),
        )

    def leaving(hours: int, short, long, hits):
        left = F.col("_at") + F.make_dt_interval(F.lit(0), F.lit(hours)) - tick
        return entry(F.col("_minute") + 60 * hours, left, short, long, hits, False)

    counted = timed.select(
        "campaign_id",
        F.inline(
            F.array(
                entry(F.col("_minute"), F.col("_at"), one, one, F.col("_hit"), True),
                leaving(short_hours, -one, none, none),
                leaving(long_hours, none, -one, -F.col("_hit")),
            )
        ),
    )

    def preceding(hours: int):
        return Window.partitionBy("campaign_id").orderBy("_minute").rangeBetween(-60 * hours, -1)

    carry = (
        timed.groupBy("campaign_id", "_minute")
        .agg(
            F.count(F.lit(1)).alias("_n"), F.sum("_hit").alias("_hits"), F.min("_at").alias("_at")
        )
        .select(
            "campaign_id",
            "_minute",
            (F.col("_at") - F.expr("interval '1' minute")).alias("_at"),
            F.coalesce(F.sum("_n").over(preceding(short_hours)), none).alias("_short"),
            F.coalesce(F.sum("_n").over(preceding(long_hours)), none).alias("_long"),
            F.coalesce(F.sum("_hits").over(preceding(long_hours)), none).alias("_hit"),
        )
    )

    def before(measure: str):
        """Sum of what is strictly earlier in the piece; simultaneous visits do not count."""
        return F.expr(
            f"sum({measure}) OVER (PARTITION BY campaign_id, _minute ORDER BY _at "
            "RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL '0.000001' SECOND PRECEDING)"
        )

    return (
        counted.unionByName(carry, allowMissingColumns=True)
        .withColumns(
            {
                "campaign_visits_1h": before("_short"),
                "_n": before("_long"),
                "_hits": before("_hit"),
            }
        )
        .filter(F.col("_own"))
        .withColumn(
            "campaign_cr_24h",
            F.col("_hits").cast("double") / F.nullif(F.col("_n").cast("double"), F.lit(0.0)),
        )
        .select(*visits.columns, "campaign_visits_1h", "campaign_cr_24h")
    )


def ml_features(
    visits: DataFrame, as_of: datetime, *, days: int = 30, short_hours: int = 1, long_hours: int = 24
) -> DataFrame:
    """Time, category and campaign-history features per visit, with the conversion label.

    The visits described are those of the last ``days``; their history reaches ``long_hours``
    further back, so that much more is scanned and no more.
    """
    history = visits.filter(
        (F.col("visit_timestamp") > ts_lit(as_of - timedelta(days=days, hours=long_hours)))
        & (F.col("visit_timestamp") <= ts_lit(as_of))
    ).select(
        "visit_id",
        "campaign_id",
        "visit_timestamp",
        "country_code",
        "device",
        "os",
        "browser",
        "connection_type",
        "is_conversion",
    )
    active = with_activity(history, short_hours=short_hours, long_hours=long_hours)
    return active.filter(trailing("visit_timestamp", as_of, days=days)).select(
        "visit_id",
        "campaign_id",
        F.hour("visit_timestamp").alias("hour"),
        dow("visit_timestamp").alias("day_of_week"),
        F.dayofmonth("visit_timestamp").alias("day_of_month"),
        "country_code",
        "device",
        "os",
        "browser",
        "connection_type",
        "campaign_visits_1h",
        "campaign_cr_24h",
        "is_conversion",
    )
