"""Conversion-rate anomalies, traffic drops and the alert feed made of both."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions.expr import hour_start, pct, rounded, trailing

# Every operator that takes ``visits`` here also takes visits counted by campaign, hour and step, as
# the streaming job stores them: columns ``until`` (the step's end), ``hour``, ``visits`` and
# ``conversions`` instead of one row per visit. For an ``as_of`` on a step boundary both agree.


def _at(rows: DataFrame) -> str:
    return "until" if "until" in rows.columns else "visit_timestamp"


def _visits(rows: DataFrame) -> Column:
    return F.sum("visits") if "until" in rows.columns else F.count(F.lit(1))


def _conversions(rows: DataFrame) -> Column:
    return F.sum("conversions") if "until" in rows.columns else F.count_if("is_conversion")


def _hour(rows: DataFrame) -> Column:
    return F.col("hour") if "until" in rows.columns else hour_start("visit_timestamp")


def cr_baseline(
    visits: DataFrame, as_of: datetime, *, days: int = 7, min_visits: int = 100
) -> DataFrame:
    """Mean and sample deviation of the per-visit conversion flag, per campaign.

    For a 0/1 flag both follow from two counts, so the baseline is an integer aggregation.
    """
    n = F.col("visits").cast("double")
    hits = F.col("conversions").cast("double")
    return (
        visits.filter(trailing(_at(visits), as_of, days=days))
        .groupBy("campaign_id", "campaign_name")
        .agg(_visits(visits).alias("visits"), _conversions(visits).alias("conversions"))
        .filter(F.col("visits") > min_visits)
        .withColumn("avg_cr", hits / n)
        .withColumn("stddev_cr", F.when(n > 1, F.sqrt((hits - hits * hits / n) / (n - 1))))
    )


def cr_current(
    visits: DataFrame, as_of: datetime, *, hours: int = 1, min_visits: int = 10
) -> DataFrame:
    """Conversion rate of the latest hours, per campaign."""
    return (
        visits.filter(trailing(_at(visits), as_of, hours=hours))
        .groupBy("campaign_id")
        .agg(_visits(visits).alias("_n"), _conversions(visits).alias("_hits"))
        .filter(F.col("_n") > min_visits)
        .select(
            "campaign_id",
            (F.col("_hits").cast("double") / F.col("_n").cast("double")).alias("current_cr"),
        )
    )


def score_cr(baseline: DataFrame, current: DataFrame, *, z_threshold: float = 2) -> DataFrame:
    """Campaigns whose current rate is more than ``z_threshold`` deviations off the baseline."""
    z = (F.col("current_cr") - F.col("avg_cr")) / F.nullif(F.col("stddev_cr"), F.lit(0.0))
    # Both sides hold one row per campaign.
    return (
        baseline.join(current, "campaign_id")
        .withColumn("_z", z)
        .filter(F.abs("_z") > z_threshold)
        .select(
            "campaign_name",
            rounded(F.col("avg_cr") * 100, 2).alias("avg_cr_pct"),
            rounded(F.col("current_cr") * 100, 2).alias("current_cr_pct"),
            rounded("_z", 2).alias("z_score"),
            F.when(F.col("_z") > z_threshold, "HIGH").otherwise("LOW").alias("status"),
            F.abs("_z").alias("_size"),
        )
    )


def anomaly_cr(
    visits: DataFrame,
    as_of: datetime,
    *,
    days: int = 7,
    hours: int = 1,
    min_baseline: int = 100,
    min_current: int = 10,
    z_threshold: float = 2,
) -> DataFrame:
    """Campaigns with an unusual conversion rate in the latest hours, largest deviation first."""
    scored = score_cr(
        cr_baseline(visits, as_of, days=days, min_visits=min_baseline),
        cr_current(visits, as_of, hours=hours, min_visits=min_current),
        z_threshold=z_threshold,
    )
    return scored.orderBy(F.desc("_size"), "campaign_name").drop("_size")


def traffic_drops(
    visits: DataFrame, as_of: datetime, *, days: int = 7, ratio: float = 0.5
) -> DataFrame:
    """Campaigns whose last hour is below ``ratio`` of their usual count at this hour of day.

    The usual count averages the hours that had traffic. Only this hour of day is ever compared,
    so other hours are filtered out before grouping.
    """
    same_hour = F.hour("visit_timestamp") == as_of.hour
    hourly = (
        visits.filter(trailing("visit_timestamp", as_of, days=days) & same_hour)
        .groupBy("campaign_id", "campaign_name", hour_start("visit_timestamp").alias("_hour"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # At most days + 1 hours (times the names used) are left per campaign.
    usual = (
        hourly.groupBy("campaign_id")
        .agg(
            (F.sum("_n").cast("double") / F.count(F.lit(1)).cast("double")).alias("_usual"),
            F.collect_set("campaign_name").alias("_names"),
        )
        .select("campaign_id", "_usual", F.explode_outer("_names").alias("campaign_name"))
    )
    current = (
        visits.filter(trailing("visit_timestamp", as_of, hours=1))
        .groupBy("campaign_id")
        .agg(F.count(F.lit(1)).alias("current_visits"))
    )
    return (
        usual.join(current, "campaign_id")
        .filter(F.col("current_visits") < F.col("_usual") * ratio)
        .select(
            "campaign_name",
            rounded("_usual", 0).alias("avg_hourly"),
            "current_visits",
            pct(F.col("_usual") - F.col("current_visits"), "_usual", 1).alias("drop_pct"),
        )
        .distinct()
        .orderBy(F.desc("drop_pct"), "campaign_name")
    )


def low_traffic_hours(
    visits: DataFrame, as_of: datetime, *, hours: int = 24, ratio: float = 0.3
) -> DataFrame:
    """Hours of the last day that stay below ``ratio`` of their campaign's hourly mean."""
    hourly = (
        visits.filter(trailing(_at(visits), as_of, hours=hours))
        .groupBy("campaign_id", "campaign_name", _hour(visits).alias("hour"))
        .agg(_visits(visits).alias("visits"))
    )
    # The window sees hourly rows, not visits: about 25 per campaign.
    usual = F.avg("visits").over(Window.partitionBy("campaign_id"))
    return hourly.withColumn("avg_visits", usual).filter(
        F.col("visits") < F.col("avg_visits") * ratio
    )


def check_alerts(
    visits: DataFrame,
    as_of: datetime,
    *,
    traffic_hours: int = 24,
    ratio: float = 0.3,
    limit: int | None = 10,
    **anomaly,
) -> DataFrame:
    """Traffic and conversion-rate alerts, ``limit`` of each kind (all of them without one).

    A traffic alert may concern any hour of the last day; ``hour`` says which. Worst come first,
    so the limit keeps the most severe. ``anomaly`` takes the arguments of :func:`anomaly_cr`.
    """
    drop = pct(F.col("avg_visits") - F.col("visits"), "avg_visits", 0)
    drops = low_traffic_hours(visits, as_of, hours=traffic_hours, ratio=ratio).withColumn("_drop", drop)
    rates = anomaly_cr(visits, as_of, **anomaly)
    if limit is not None:
        drops = drops.orderBy(F.desc("_drop"), "campaign_name", "hour").limit(limit)
        rates = rates.limit(limit)
    traffic = drops.select(
        F.lit("traffic_drop").alias("alert_type"),
        "campaign_name",
        F.format_string("Traffic dropped %d%% in last hour", F.col("_drop").cast("bigint")).alias(
            "message"
        ),
        F.lit("warning").alias("severity"),
        "hour",
    )
    return traffic.unionByName(cr_alerts(rates))


def cr_alerts(anomalies: DataFrame) -> DataFrame:
    """Anomalies as alert rows; an unusually high rate is only information."""
    two_places = "decimal(18,2)"
    return anomalies.select(
        F.lit("cr_anomaly").alias("alert_type"),
        "campaign_name",
        F.concat(
            F.lit("CR is "),
            F.col("current_cr_pct").cast(two_places).cast("string"),
            F.lit("% vs avg "),
            F.col("avg_cr_pct").cast(two_places).cast("string"),
            F.lit("%"),
        ).alias("message"),
        F.when(F.col("status") == "HIGH", "info").otherwise("warning").alias("severity"),
        F.lit(None).cast("timestamp_ntz").alias("hour"),
    )
