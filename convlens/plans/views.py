"""The stored tables and the analytic views under their SQL names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from convlens.operators import anomaly, features, joins, views


def register_views(
    spark: SparkSession,
    as_of: datetime,
    *,
    visits: DataFrame,
    live_visits: DataFrame,
    live_clicks: DataFrame,
    conversions: DataFrame,
) -> list[str]:
    """Make tables and views queryable with ``spark.sql``; returns the names.

    The views are lazy plans: a filter or projection of the query on top is optimised together
    with the view, down to the scan.
    """
    frames = {
        "visits": visits,
        "live_visits": live_visits,
        "live_clicks": live_clicks,
        "conversions": conversions,
        "daily_summary": views.daily_summary(visits, as_of),
        "hourly_patterns": views.hourly_patterns(visits, as_of),
        "realtime_cr": views.realtime_cr(visits, as_of),
        "best_hours": views.best_hours(visits, as_of),
        "hourly_heatmap": views.hourly_heatmap(visits, as_of),
        "country_trends": views.country_trends(visits, as_of),
        "emerging_countries": views.emerging_countries(visits, as_of),
        "campaign_momentum": views.campaign_momentum(visits, as_of),
        "campaign_saturation": views.campaign_saturation(visits, as_of),
        "cr_by_segment": views.cr_by_segment(visits, as_of),
        "anomaly_cr": anomaly.anomaly_cr(visits, as_of),
        "traffic_drops": anomaly.traffic_drops(visits, as_of),
        "check_alerts": anomaly.check_alerts(visits, as_of),
        "ml_features": features.ml_features(visits, as_of),
        "visit_conversions": joins.visit_conversions(live_visits, conversions),
        "daily_campaign_performance": joins.daily_campaign_performance(
            live_visits, conversions, as_of
        ),
        "country_cr": joins.country_cr(live_visits, conversions, as_of),
        "device_os_cr": joins.device_os_cr(live_visits, conversions, as_of),
        "conversion_timing": joins.conversion_timing(conversions, as_of),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
