"""Reports that bring visits and conversions together on the click id."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.functions.expr import money, or_unknown, pct, seconds_between, trailing


def visit_conversions(live_visits: DataFrame, conversions: DataFrame) -> DataFrame:
    """Every visit beside each of its conversions (one row per conversion, or one without).

    A left join may only be split on its left, so a click that owns much of the conversions would be
    one task. The matching rows come from an inner join, which can be split on either side, and the
    others from an anti join with the distinct clicks.
    """
    optional = ["custom_var_1", "custom_var_2"]
    visit = live_visits.select(
        "click_id",
        "visit_timestamp",
        "campaign_id",
        "campaign_name",
        "country_code",
        "device",
        "os",
        "browser",
        "isp",
        *[
            F.col(c) if c in live_visits.columns else F.lit(None).cast("string").alias(c)
            for c in optional
        ],
    )
    conversion = conversions.select(
        "click_id",
        F.col("postback_timestamp").alias("conversion_timestamp"),
        "revenue",
        "payout",
        "offer_name",
        "transaction_id",
    )
    matched = visit.join(conversion, "click_id").withColumn("converted", F.lit(True))
    clicks = conversion.select("click_id").distinct()
    others = visit.join(clicks, "click_id", "left_anti").withColumn("converted", F.lit(False))
    return matched.unionByName(others, allowMissingColumns=True)


def _conversion_rates(
    live_visits: DataFrame, conversions: DataFrame, dims: list, min_visits: int
) -> DataFrame:
    """Visits, converted clicks, revenue and rate by ``dims``.

    ``click_id`` is unique among visits, and conversions are brought down to one row per click
    before the join; the distinct counts of the report are then plain counts, the join key is
    unique on both sides, and no row is expanded.
    """
    # A click whose conversions all lack a revenue has still converted, hence the flag.
    converted = (
        conversions.groupBy("click_id")
        .agg(F.sum("revenue").alias("_revenue"))
        .withColumn("_converted", F.lit(True))
    )
    matched = live_visits.join(converted, "click_id", "left")
    return (
        matched.groupBy(*dims)
        .agg(
            F.count(F.lit(1)).alias("visits"),
            F.count("_converted").alias("conversions"),
            money(F.coalesce(F.sum("_revenue"), F.lit(0).cast("decimal(38,6)"))).alias("revenue"),
        )
        .filter(F.col("visits") > min_visits)
        .withColumn("cr", pct("conversions", "visits"))
    )


def daily_campaign_performance(
    live_visits: DataFrame, conversions: DataFrame, as_of: datetime, *, days: int = 30
) -> DataFrame:
    day = F.col("visit_timestamp").cast("date").alias("date")
    recent = live_visits.filter(trailing("visit_timestamp", as_of, days=days)).withColumn(
        "date", day
    )
    return _conversion_rates(
        recent, conversions, ["date", "campaign_id", "campaign_name"], 0
    ).orderBy(F.desc("date"), F.desc("revenue"), "campaign_id")


def country_cr(
    live_visits: DataFrame,
    conversions: DataFrame,
    as_of: datetime,
    *,
    days: int = 7,
    min_visits: int = 10,
) -> DataFrame:
    recent = live_visits.filter(trailing("visit_timestamp", as_of, days=days))
    return _conversion_rates(recent, conversions, ["country_code"], min_visits).orderBy(
        F.desc("revenue"), "country_code"
    )


def device_os_cr(
    live_visits: DataFrame,
    conversions: DataFrame,
    as_of: datetime,
    *,
    days: int = 7,
    min_visits: int = 10,
) -> DataFrame:
    recent = live_visits.filter(trailing("visit_timestamp", as_of, days=days))
    return _conversion_rates(recent, conversions, ["device", "os"], min_visits).orderBy(
        F.desc("revenue"), "device", "os"
    )


def flag_converted(live_visits: DataFrame, conversions: DataFrame) -> DataFrame:
    """Every visit once, with ``converted`` telling whether its click has any conversion."""
    clicks = conversions.select("click_id").distinct().withColumn("converted", F.lit(True))
    return live_visits.join(clicks, "click_id", "left").withColumn(
        "converted", F.coalesce("converted", F.lit(False))
    )


def low_conversion_segments(
    live_visits: DataFrame, conversions: DataFrame, *, min_visits: int = 20
) -> DataFrame:
    """Campaign variable x country x device segments, lowest conversion rate first."""
    return (
        flag_converted(live_visits, conversions)
        .groupBy(
            or_unknown("custom_var_3").alias("var3"),
            or_unknown("country_code").alias("country"),
            or_unknown("device").alias("device"),
        )
        .agg(
            F.count(F.lit(1)).alias("visits"),
            F.count_if("converted").alias("converted"),
        )
        .filter(F.col("visits") >= min_visits)
        .withColumn(
            "conv_rate", F.col("converted").cast("double") / F.col("visits").cast("double") * 100
        )
        .orderBy("conv_rate", "var3", "country", "device")
    )


def referential_check(conversions: DataFrame, live_visits: DataFrame) -> DataFrame:
    """Conversions whose click is not among the visits."""
    return conversions.join(live_visits.select("click_id"), "click_id", "left_anti")


# Upper ends in seconds and labels of the time-to-convert buckets.
TIME_BUCKETS = [
    (60, "< 1 min"),
    (300, "1-5 min"),
    (900, "5-15 min"),
    (3600, "15-60 min"),
    (86400, "1-24 hours"),
]
LAST_BUCKET = "> 24 hours"


def conversion_timing(conversions: DataFrame, as_of: datetime, *, days: int = 30) -> DataFrame:
    """How long visitors take to convert, per campaign."""
    seconds = seconds_between("visit_timestamp", "postback_timestamp")
    bucket = F.when(seconds < TIME_BUCKETS[0][0], TIME_BUCKETS[0][1])
    for upper, label in TIME_BUCKETS[1:]:
        bucket = bucket.when(seconds < upper, label)
    return (
        conversions.filter(trailing("postback_timestamp", as_of, days=days))
        .filter(F.col("visit_timestamp").isNotNull())
        .groupBy("campaign_name", bucket.otherwise(LAST_BUCKET).alias("time_bucket"))
        .agg(
            F.count(F.lit(1)).alias("conversions"), money(F.sum("revenue")).alias("revenue")
        )
        .orderBy("campaign_name", F.desc("conversions"), "time_bucket")
    )
