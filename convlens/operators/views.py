"""Rollups and trend reports over the wide ``visits`` frame.

Each report is one scan with the time bound in the parquet filter, one hash aggregation with
map-side combine (so a dominant campaign or country costs one partial row per task) and, where the
report is ranked, a final sort or top-k over the grouped result. ``cr`` is conversions per visit
except where the docstring says per click.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.functions.expr import (
    dow,
    hour_start,
    mean,
    money,
    pct,
    ratio,
    rounded,
    trailing,
    ts_lit,
    week_start,
    weekday_name,
)

def _visits() -> Column:
    return F.count(F.lit(1))


def _clicks() -> Column:
    return F.count_if("is_click")


def _conversions() -> Column:
    return F.count_if("is_conversion")


def hourly_rollup(visits: DataFrame, since: datetime, until: datetime | None = None) -> DataFrame:
    """Hour x campaign x country x device totals for ``ts >= since`` (and ``ts <= until``).

    The key is (hour, campaign_id, country, device); a campaign renamed inside an hour keeps one
    row under its latest name. ``cr`` is per click. Money stays decimal: this is a stored table
    that gets merged again.
    """
    kept = F.col("visit_timestamp") >= ts_lit(since)
    if until is not None:
        kept = kept & (F.col("visit_timestamp") <= ts_lit(until))
    by_name = (
        visits.filter(kept)
        .withColumn("hour_timestamp", hour_start("visit_timestamp"))
        .groupBy("hour_timestamp", "campaign_id", "country_code", "device", "campaign_name")
        .agg(
            F.max("visit_timestamp").alias("_last"),
            _visits().alias("visits"),
            _clicks().alias("clicks"),
            _conversions().alias("conversions"),
            F.sum("revenue").alias("revenue"),
            F.sum("cost").alias("cost"),
            F.sum("profit").alias("profit"),
        )
    )
    return finish_rollup(
        by_name.groupBy("hour_timestamp", "campaign_id", "country_code", "device").agg(
            F.max_by("campaign_name", F.struct("_last", "campaign_name")).alias("campaign_name"),
            *[F.sum(c).alias(c) for c in ("visits", "clicks", "conversions")],
            *[
                F.sum(c).cast("decimal(28,6)").alias(c)
                for c in ("revenue", "cost", "profit")
            ],
        )
    )


def finish_rollup(totals: DataFrame) -> DataFrame:
    """Add the rollup's rates to its totals, in the stored column order."""
    return totals.select(
        "hour_timestamp",
        "campaign_id",
        "campaign_name",
        "country_code",
        "device",
        "visits",
        "clicks",
        "conversions",
        "revenue",
        "cost",
        "profit",
        pct("clicks", "visits").alias("ctr"),
        pct("conversions", "clicks").alias("cr"),
        ratio("revenue", "clicks", 4).alias("epc"),
    )


def daily_summary(visits: DataFrame, as_of: datetime, *, days: int = 30) -> DataFrame:
    """Day x campaign x country totals; ``cr`` is per click."""
    return (
        visits.filter(trailing("visit_timestamp", as_of, days=days))
        .groupBy(
            F.col("visit_timestamp").cast("date").alias("date"), "campaign_name", "country_code"
        )
        .agg(
            _visits().alias("visits"),
            _clicks().alias("clicks"),
            _conversions().alias("conversions"),
            money(F.sum("revenue")).alias("revenue"),
            money(F.sum("cost")).alias("cost"),
            money(F.sum("profit")).alias("profit"),
        )
        .withColumn("cr", pct("conversions", "clicks"))
        .orderBy(F.desc("date"), F.desc("revenue"), "campaign_name", "country_code")
    )


def hourly_patterns(
    visits: DataFrame, as_of: datetime, *, days: int = 30, min_samples: int = 10
) -> DataFrame:
    """Revenue mean and sample deviation per hour of day, weekday, campaign and country."""
    return (
        visits.filter(trailing("visit_timestamp", as_of, days=days))
        .groupBy(
            F.hour("visit_timestamp").alias("hour_of_day"),
            dow("visit_timestamp").alias("day_of_week"),
            "campaign_name",
            "country_code",
        )
        .agg(
            mean(F.sum("revenue"), _visits()).alias("avg_revenue"),
            rounded(F.stddev_samp(F.col("revenue").cast("double")), 6).alias("stddev_revenue"),
            _visits().alias("sample_count"),
        )
        .filter(F.col("sample_count") > min_samples)
    )


def realtime_cr(
    visits: DataFrame, as_of: datetime, *, recent_hours: int = 1, hours: int = 24, min_visits: int = 50
) -> DataFrame:
    """Visits and conversion rate of the last hour beside the last day."""
    recent = trailing("visit_timestamp", as_of, hours=recent_hours)
    return (
        visits.filter(trailing("visit_timestamp", as_of, hours=hours))
        .groupBy("campaign_name", "country_code")
        .agg(
            F.count_if(recent).alias("visits_1h"),
            F.count_if(recent & F.col("is_conversion")).alias("conv_1h"),
            _visits().alias("visits_24h"),
            _conversions().alias("conv_24h"),
        )
        .filter(F.col("visits_24h") > min_visits)
        .withColumn("cr_1h", pct("conv_1h", "visits_1h"))
        .withColumn("cr_24h", pct("conv_24h", "visits_24h"))
        .orderBy(F.desc("visits_24h"), "campaign_name", "country_code")
    )


def best_hours(
    visits: DataFrame, as_of: datetime, *, days: int = 30, min_visits: int = 100, limit: int = 20
) -> DataFrame:
    """Best (weekday, hour) cells by revenue."""
    return (
        visits.filter(trailing("visit_timestamp", as_of, days=days))
        .groupBy(
            weekday_name("visit_timestamp").alias("day_of_week"),
            F.hour("visit_timestamp").alias("hour"),
        )
        .agg(
            _visits().alias("visits"),
            _conversions().alias("conversions"),
            money(F.sum("revenue")).alias("revenue"),
        )
        .filter(F.col("visits") > min_visits)
        .withColumn("cr", pct("conversions", "visits"))
        .orderBy(F.desc("revenue"), "day_of_week", "hour")
        .limit(limit)
    )


def hourly_heatmap(visits: DataFrame, as_of: datetime, *, days: int = 30) -> DataFrame:
    """Revenue per (weekday, hour), one row per cell."""
    return (
        visits.filter(trailing("visit_timestamp", as_of, days=days))
        .groupBy(
            dow("visit_timestamp").alias("day_of_week"), F.hour("visit_timestamp").alias("hour")
        )
        .agg(
            money(F.sum("revenue")).alias("total_revenue"),
            mean(F.sum("revenue"), _visits()).alias("avg_revenue"),
            _visits().alias("visits"),
        )
    )


def hourly_heatmap_grid(visits: DataFrame, as_of: datetime, *, days: int = 30) -> DataFrame:
    """The heatmap as a grid: one row per weekday, one revenue column per hour."""
    # The hours are listed, so the pivot needs no extra pass to find its columns.
    return (
        hourly_heatmap(visits, as_of, days=days)
        .groupBy("day_of_week")
        .pivot("hour", list(range(24)))
        .agg(F.max("total_revenue"))
        .toDF("day_of_week", *[f"h{hour:02d}" for hour in range(24)])
    )


def country_trends(
    visits: DataFrame, as_of: datetime, *, days: int = 30, min_visits: int = 100
) -> DataFrame:
    """Totals per country and the change of this ISO week's revenue against last week's.

    Weekly subtotals would only be summed again, so the two weeks are conditional sums.
    """
    this_week = week_start(ts_lit(as_of))
    week = week_start("visit_timestamp")
    current = F.sum(F.when(week == this_week, F.col("revenue")))
    previous = F.sum(F.when(week == F.date_sub(this_week, 7), F.col("revenue")))
    zero = F.lit(0).cast("decimal(28,6)")
    return (
        visits.filter(trailing("visit_timestamp", as_of, days=days))
        .groupBy("country_code")
        .agg(
            F.sum("revenue").alias("total_revenue"),
            _visits().alias("total_visits"),
            _conversions().alias("total_conversions"),
            F.coalesce(current, zero).alias("_current"),
            F.coalesce(previous, zero).alias("_previous"),
        )
        .filter(F.col("total_visits") > min_visits)
        .select(
            "country_code",
            money("total_revenue").alias("total_revenue"),
            "total_visits",
            "total_conversions",
            pct("total_conversions", "total_visits").alias("cr"),
            pct(F.col("_current") - F.col("_previous"), "_previous", 1).alias("wow_change_pct"),
        )
        .orderBy(F.desc("total_revenue"), "country_code")
    )


def emerging_countries(
    visits: DataFrame,
    as_of: datetime,
    *,
    days: int = 7,
    growth: float = 1.5,
    limit: int = 20,
) -> DataFrame:
    """Countries whose last ``days`` earned more than ``growth`` times the days before."""
    boundary = ts_lit(as_of) - F.make_dt_interval(F.lit(days))
    ts = F.col("visit_timestamp")
    zero = F.lit(0).cast("decimal(28,6)")
    recent = F.sum(F.when(ts > boundary, F.col("revenue")))
    # The older half includes its upper end; its lower end is the scan bound.
    previous = F.sum(F.when(ts <= boundary, F.col("revenue")))
    return (
        visits.filter(trailing("visit_timestamp", as_of, days=2 * days))
        .groupBy("country_code")
        .agg(
            F.coalesce(recent, zero).alias("recent"), F.coalesce(previous, zero).alias("previous")
        )
        .filter(F.col("previous") > 0)
        .filter(money("recent") > money("previous") * growth)
        .select(
            "country_code",
            money("recent").alias("recent_revenue"),
            money("previous").alias("previous_revenue"),
            pct(F.col("recent") - F.col("previous"), "previous", 1).alias("growth_pct"),
        )
        .orderBy(F.desc("growth_pct"), "country_code")
        .limit(limit)
    )


def campaign_momentum(
    visits: DataFrame,
    as_of: datetime,
    *,
    days: int = 7,
    min_revenue: float = 100,
    growing: float = 1.2,
    declining: float = 0.8,
) -> DataFrame:
    """Revenue of the last ``days`` against the days before, per campaign.

    A whole calendar day belongs to the recent half when its midnight is later than
    ``as_of - days``, so the split is by date and not by moment.
    """
    midnight = F.col("visit_timestamp").cast("date").cast("timestamp_ntz")
    is_recent = midnight > (ts_lit(as_of) - F.make_dt_interval(F.lit(days)))
    zero = F.lit(0).cast("decimal(28,6)")
    recent, previous = F.col("_recent"), F.col("_previous")
    return (
        visits.filter(trailing("visit_timestamp", as_of, days=2 * days))
        .groupBy("campaign_id", "campaign_name")
        .agg(
            F.coalesce(F.sum(F.when(is_recent, F.col("revenue"))), zero).alias("_recent"),
            F.coalesce(F.sum(F.when(~is_recent, F.col("revenue"))), zero).alias("_previous"),
            F.coalesce(F.sum(F.when(is_recent, F.col("profit"))), zero).alias("_profit"),
        )
        .filter(money(recent + previous) > min_revenue)
        .select(
            "campaign_name",
            money(F.round(recent, 2)).alias("recent_7d_revenue"),
            money(F.round(previous, 2)).alias("previous_7d_revenue"),
            pct(recent - previous, previous, 1).alias("revenue_change_pct"),
            money(F.round(F.col("_profit"), 2)).alias("recent_7d_profit"),
            F.when(money(recent) > money(previous) * growing, "GROWING")
            .when(money(recent) < money(previous) * declining, "DECLINING")
            .otherwise("STABLE")
            .alias("momentum"),
        )
        .orderBy(F.desc("recent_7d_revenue"), "campaign_name")
    )


def campaign_saturation(
    visits: DataFrame,
    as_of: datetime,
    *,
    days: int = 30,
    min_days: int = 7,
    threshold_per_second: float = 0.0001,
) -> DataFrame:
    """Linear trend of daily earnings per visit.

    The label compares the slope per second, while the column shows the slope per day; pass a
    ``threshold_per_second`` of ``x / 86400`` to label by a daily change of ``x``. The regression
    runs on day numbers, which gives the slope per day without large epoch values.
    """
    day = F.col("visit_timestamp").cast("date")
    daily = (
        visits.filter(trailing("visit_timestamp", as_of, days=days))
        .groupBy("campaign_id", "campaign_name", day.alias("date"))
        .agg(mean(F.sum("revenue"), _visits()).alias("epv"))
    )
    slope = F.col("_slope")
    return (
        daily.groupBy("campaign_id", "campaign_name")
        .agg(
            F.count(F.lit(1)).alias("_days"),
            F.avg("epv").alias("_epv"),
            F.regr_slope("epv", F.unix_date("date").cast("double")).alias("_slope"),
        )
        .filter(F.col("_days") >= min_days)
        .select(
            "campaign_name",
            rounded("_epv", 4).alias("avg_epv"),
            rounded(slope, 6).alias("epv_daily_trend"),
            F.when(slope / 86400 < -threshold_per_second, "SATURATING")
            .when(slope / 86400 > threshold_per_second, "IMPROVING")
            .otherwise("STABLE")
            .alias("status"),
        )
        .orderBy(F.desc("avg_epv"), "campaign_name")
    )


def cr_by_segment(
    visits: DataFrame, as_of: datetime, *, days: int = 30, min_visits: int = 100
) -> DataFrame:
    """Conversion rate and earnings per visit by device and country."""
    return (
        visits.filter(trailing("visit_timestamp", as_of, days=days))
        .groupBy("device", "country_code")
        .agg(
            _visits().alias("visits"),
            _conversions().alias("conversions"),
            F.sum("revenue").alias("_revenue"),
        )
        .filter(F.col("visits") > min_visits)
        .select(
            "device",
            "country_code",
            "visits",
            "conversions",
            pct("conversions", "visits").alias("cr"),
            money("_revenue").alias("revenue"),
            ratio("_revenue", "visits", 4).alias("epv"),
        )
        .orderBy(F.desc("revenue"), "device", "country_code")
    )
