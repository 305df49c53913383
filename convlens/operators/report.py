"""The parameterised performance report and the listings of the report service."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions.expr import (
    dow,
    hour_start,
    local_midnight,
    local_time,
    money,
    pct,
    ts_lit,
)

# Dimension name of the service -> columns (key, display name).
DIMENSIONS = {
    "campaign": ("campaign_id", "campaign_name"),
    "offer": ("offer_id", "offer_name"),
    "lander": ("lander_id", "lander_name"),
    "traffic-source": ("traffic_source_id", "traffic_source_name"),
    "affiliate-network": ("affiliate_network_id", "affiliate_network_name"),
    "country": ("country_code", None),
    "device-type": ("device", None),
    "os": ("os", None),
    "browser": ("browser", None),
    "connection-type": ("connection_type", None),
    "isp": ("isp", None),
    "day": (None, None),
    "hour": (None, None),
    "day-of-week": (None, None),
}
FILTERS = {
    "campaign": "campaign_id",
    "offer": "offer_id",
    "traffic-source": "traffic_source_id",
}
METRICS = ["visits", "clicks", "conversions", "revenue", "cost", "profit", "roi", "cr", "ctr"]


def _dimension(group_by: str, tz: str) -> Column:
    """The grouping value as text; times are those of ``tz``."""
    if group_by not in DIMENSIONS:
        raise ValueError(f"unknown dimension {group_by!r}; one of {sorted(DIMENSIONS)}")
    here = local_time("visit_timestamp", tz)
    times = {
        "day": here.cast("date").cast("string"),
        "hour": hour_start(here).cast("string"),
        "day-of-week": dow(here).cast("string"),
    }
    return times.get(group_by, F.col(DIMENSIONS[group_by][0]) if DIMENSIONS[group_by][0] else None)


def in_days(ts: str, first: date, last: date, tz: str) -> Column:
    """Whole days ``first`` .. ``last`` of ``tz``, as constant bounds on the stored UTC column."""
    return (F.col(ts) >= ts_lit(local_midnight(first, tz))) & (
        F.col(ts) < ts_lit(local_midnight(last + timedelta(days=1), tz))
    )


def report_days(
    today: date, from_date: date | None, to_date: date | None, days_back: int | None
) -> tuple[date, date]:
    """The days a report covers: the last N days and today, a given range, or today."""
    if days_back:
        return today - timedelta(days=days_back), today
    if from_date:
        return from_date, to_date or from_date
    return today, to_date or today


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("visits"),
        F.count_if("is_click").alias("clicks"),
        F.count_if("is_conversion").alias("conversions"),
        F.sum("revenue").alias("revenue"),
        F.sum("cost").alias("cost"),
        F.sum("profit").alias("profit"),
    ]


def _with_rates(totals: DataFrame, *labels: str) -> DataFrame:
    return totals.select(
        *labels,
        "visits",
        "clicks",
        "conversions",
        *[money(c).alias(c) for c in ("revenue", "cost", "profit")],
        pct("profit", "cost").alias("roi"),
        pct("conversions", "visits").alias("cr"),
        pct("clicks", "visits").alias("ctr"),
    )


def _grouped(
    visits: DataFrame,
    group_by: str,
    first: date,
    last: date,
    tz: str,
    filters: dict[str, str] | None = None,
) -> DataFrame:
    """Exact sums per value of a dimension, under its latest display name."""
    rows = visits.filter(in_days("visit_timestamp", first, last, tz))
    for name, wanted in (filters or {}).items():
        rows = rows.filter(F.col(FILTERS[name]) == wanted)
    key = _dimension(group_by, tz).alias("dimension")
    label = DIMENSIONS[group_by][1]
    if label is None:
        return rows.groupBy(key).agg(*_sums()).withColumn("name", F.col("dimension"))
    # Names join the first, hash-based grouping; only its few rows are grouped again.
    return (
        rows.groupBy(key, F.col(label).alias("_name"))
        .agg(F.max("visit_timestamp").alias("_last"), *_sums())
        .groupBy("dimension")
        .agg(
            F.max_by("_name", F.struct("_last", "_name")).alias("name"),
            *[F.sum(c).alias(c) for c in ("visits", "clicks", "conversions")],
            *[F.sum(c).alias(c) for c in ("revenue", "cost", "profit")],
        )
    )


def performance_report(
    visits: DataFrame,
    today: date,
    *,
    group_by: str = "campaign",
    from_date: date | None = None,
    to_date: date | None = None,
    days_back: int | None = None,
    filters: dict[str, str] | None = None,
    sort_by: str = "profit",
    descending: bool = True,
    limit: int = 50,
    tz: str = "UTC",
) -> DataFrame:
    """Metrics per value of one dimension (the top ``limit`` by ``sort_by``) and a total row.

    The total covers every value, also those beyond the limit: grouping sets add up the grouped rows
    once per value and once in all, so the visits are scanned a single time.
    ``tz`` applies to the day bounds and to the day, hour and weekday dimensions alike.
    """
    if sort_by not in METRICS:
        raise ValueError(f"unknown metric {sort_by!r}; one of {METRICS}")
    first, last = report_days(today, from_date, to_date, days_back)
    groups = _grouped(visits, group_by, first, last, tz, filters)
    order = F.desc_nulls_last(sort_by) if descending else F.asc_nulls_last(sort_by)
    value = F.col("dimension")
    sums = groups.groupingSets([[value], []], value).agg(
        F.grouping("dimension").alias("_total"),
        F.max("name").alias("_name"),
        *[F.sum(c).alias(c) for c in ("visits", "clicks", "conversions")],
        *[F.sum(c).alias(c) for c in ("revenue", "cost", "profit")],
    )
    named = sums.withColumns(
        {
            "name": F.when(F.col("_total") == 1, "total").otherwise(F.col("_name")),
            "row_type": F.when(F.col("_total") == 1, "total").otherwise("group"),
        }
    )
    # The limit counts group rows only; it is applied in the map tasks first.
    place = F.row_number().over(Window.partitionBy("row_type").orderBy(order, "dimension"))
    return (
        _with_rates(named, "dimension", "name", "row_type")
        .withColumn("_place", place)
        .filter(F.col("_place") <= limit)
        .orderBy("row_type", "_place")
        .select("dimension", "name", *METRICS, "row_type")
    )


def summary(
    visits: DataFrame, today: date, *, days_back: int = 1, tz: str = "UTC"
) -> DataFrame:
    """Totals over the last days, in one row."""
    first, last = report_days(today, None, None, days_back)
    period = "Today" if days_back == 1 else f"Last {days_back} days"
    totals = visits.filter(in_days("visit_timestamp", first, last, tz)).agg(*_sums())
    return _with_rates(totals.withColumn("period", F.lit(period)), "period")


def top_performers(
    visits: DataFrame,
    today: date,
    *,
    entity: str = "campaign",
    metric: str = "profit",
    days_back: int = 7,
    limit: int = 10,
    tz: str = "UTC",
) -> DataFrame:
    """The best values of a dimension by a metric."""
    first, last = report_days(today, None, None, days_back)
    rows = _with_rates(_grouped(visits, entity, first, last, tz), "dimension", "name")
    return rows.orderBy(F.desc_nulls_last(metric), "dimension").limit(limit)


def worst_performers(
    visits: DataFrame,
    today: date,
    *,
    entity: str = "campaign",
    days_back: int = 7,
    limit: int = 10,
    tz: str = "UTC",
) -> DataFrame:
    """The values of a dimension that lose most money; none that earns any."""
    first, last = report_days(today, None, None, days_back)
    rows = _with_rates(_grouped(visits, entity, first, last, tz), "dimension", "name")
    return rows.filter(F.col("profit") < 0).orderBy("profit", "dimension").limit(limit)


# Catalog kind -> columns listed beside id and name.
CATALOG_PARENTS = {
    "campaign": ["traffic_source_name"],
    "offer": ["affiliate_network_name"],
    "traffic-source": [],
    "lander": [],
    "affiliate-network": [],
}


def dimension_catalog(
    visits: DataFrame, kind: str, *, limit: int | None = None, ts: str = "visit_timestamp"
) -> DataFrame:
    """Every campaign, offer, … seen, with its latest name and parent."""
    key, name = DIMENSIONS[kind][0], DIMENSIONS[kind][1]
    parents = CATALOG_PARENTS[kind]
    seen = (
        visits.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id"), F.col(name).alias("name"), *parents)
        .agg(F.max(ts).alias("_last"))
    )
    described = F.struct("name", *parents)
    catalog = (
        seen.groupBy("id")
        .agg(F.max_by(described, F.struct("_last", "name", *parents)).alias("_d"))
        .select("id", "_d.*")
        .orderBy("id")
    )
    return catalog if limit is None else catalog.limit(limit)


def conversion_listing(
    conversions: DataFrame,
    today: date,
    *,
    from_date: date | None = None,
    to_date: date | None = None,
    days_back: int | None = None,
    campaign_id: str | None = None,
    limit: int = 100,
    tz: str = "UTC",
) -> DataFrame:
    """The latest conversions of a range of days."""
    first, last = report_days(today, from_date, to_date, days_back)
    rows = conversions.filter(in_days("postback_timestamp", first, last, tz))
    if campaign_id is not None:
        rows = rows.filter(F.col("campaign_id") == campaign_id)
    return (
        rows.orderBy(F.desc("postback_timestamp"), "transaction_id")
        .limit(limit)
        .select(
            "transaction_id",
            "click_id",
            "postback_timestamp",
            "visit_timestamp",
            "campaign_name",
            "offer_name",
            money("revenue").alias("revenue"),
        )
    )


def click_listing(
    live_clicks: DataFrame,
    today: date,
    campaign_id: str,
    *,
    from_date: date | None = None,
    to_date: date | None = None,
    days_back: int | None = None,
    limit: int = 100,
    tz: str = "UTC",
) -> DataFrame:
    """The latest clicks of a campaign."""
    first, last = report_days(today, from_date, to_date, days_back)
    return (
        live_clicks.filter(in_days("click_timestamp", first, last, tz))
        .filter(F.col("campaign_id") == campaign_id)
        .orderBy(F.desc("click_timestamp"), "click_id")
        .limit(limit)
        .select(
            "click_id",
            "click_timestamp",
            "campaign_name",
            "offer_name",
            "lander_name",
            "country_code",
            "device",
            "os",
            "browser",
        )
    )


def format_report_row(report: DataFrame) -> DataFrame:
    """Report rows as display text: the name, then the metrics."""

    def whole(c: str) -> Column:
        return F.format_number(F.col(c), 0)

    def dollars(c: str) -> Column:
        return F.concat(F.lit("$"), F.format_number(F.col(c), 2))

    def percent(c: str, places: int) -> Column:
        exact = F.round(F.col(c).cast("decimal(18,4)"), places)
        return F.concat(F.format_number(exact, places), F.lit("%"))

    parts = [
        ("Visits: ", whole("visits")),
        ("Clicks: ", whole("clicks")),
        ("Conv: ", whole("conversions")),
        ("Rev: ", dollars("revenue")),
        ("Cost: ", dollars("cost")),
        ("Profit: ", dollars("profit")),
        ("ROI: ", percent("roi", 1)),
        ("CR: ", percent("cr", 2)),
        ("CTR: ", percent("ctr", 2)),
    ]
    # concat_ws leaves out a metric that is NULL.
    line = F.concat_ws(" | ", *[F.concat(F.lit(label), text) for label, text in parts])
    return report.select(
        "dimension",
        F.concat(F.lit("**"), F.coalesce("name", F.lit("")), F.lit("**")).alias("title"),
        line.alias("metrics"),
    )
