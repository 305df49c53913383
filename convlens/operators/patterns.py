"""Segment patterns in conversion revenue: which values of which dimension pay well or badly.

The reports cover every campaign variable (``custom_var_3``) and every dimension in one job:
dimensions are unpivoted to (feature, value) rows and grouped, with no loop over campaigns. A
report-wide figure (median, mean, count) enters as a scalar subquery, which is one value; a
per-campaign one is joined to the grouped rows, never to the conversions.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convlens.functions.expr import MONEY, mean, money, nonempty, or_unknown, ts_lit
from convlens.operators.median import grouped_median
from convlens.runtime import cut

# The dimensions each report looks at, and the presets of the pattern tables.
SEGMENT_FEATURES = ["country_code", "device", "os", "isp", "connection_type"]
CAMPAIGN_FEATURES = ["country_code", "device", "os", "isp"]
FEATURE_PAIRS = [
    ("country_code", "device"),
    ("country_code", "os"),
    ("device", "os"),
    ("country_code", "connection_type"),
]
PATTERN_PRESETS = {
    "var3_country": ["custom_var_3", "country_code"],
    "var3_device_os": ["custom_var_3", "device", "os"],
    "country_device_os": ["country_code", "device", "os"],
    "var3": ["custom_var_3"],
}

def _count() -> Column:
    return F.count(F.lit(1))


def recent_conversions(conversions: DataFrame, as_of: datetime, *, days: int = 30) -> DataFrame:
    """Conversions posted since ``as_of - days`` (inclusive) and up to ``as_of``."""
    posted = F.col("postback_timestamp")
    return conversions.filter(
        (posted >= ts_lit(as_of - timedelta(days=days))) & (posted <= ts_lit(as_of))
    )


def clean_conversions(conversions: DataFrame, features: list[str] = ()) -> DataFrame:
    """Unreadable revenue becomes 0 (see ``unread_amount``); a missing campaign variable or ``features`` value 'unknown'."""
    filled = {c: F.coalesce(c, F.lit("unknown")) for c in ("custom_var_3", *features)}
    revenue = F.coalesce(F.col("revenue").try_cast(MONEY), F.lit(0).cast(MONEY))
    return conversions.withColumns({**filled, "revenue": revenue})


def _of_campaign(conversions: DataFrame, var3: str | None) -> DataFrame:
    return conversions if var3 is None else conversions.filter(F.col("custom_var_3") == var3)


def revenue_cells(
    conversions: DataFrame, dims: list[str], *, var3: str | None = None
) -> DataFrame:
    """Cleaned conversions reduced to (``dims``, ``revenue``) with their number as ``_n``, as a written table.

    Reports that need a median beside their groups read it instead of the conversions, which
    may be a join, twice. ``_r`` is a cell's total revenue.
    """
    rows = _of_campaign(clean_conversions(conversions), var3)
    cells = cut(rows.groupBy(*dict.fromkeys(dims), "revenue").agg(_count().alias("_n")))
    return cells.withColumn("_r", F.col("revenue") * F.col("_n").cast("decimal(14,0)"))


def _overall(cells: DataFrame) -> Column:
    """Median revenue, number and mean revenue of all cells, as one value."""
    middle = grouped_median(cells, [], "revenue", weight="_n").select("median").scalar()
    totals = cells.agg(F.sum("_n").alias("n"), F.sum("_r").alias("_r"))
    return totals.select(F.struct(middle.alias("median"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), mean("_r", "n").alias("mean"))).scalar()


def _known(*values: str) -> Column:
    """Named values only: not NULL, not empty, not 'unknown'."""
    named = F.lit(True)
    for value in values:
        named = named & nonempty(value).isNotNull() & (F.col(value) != "unknown")
    return named


def pattern_stats(
    conversions: DataFrame,
    dims: list[str],
    *,
    min_convs: int = 5,
    var3: str | None = None,
    worst: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Revenue, payout and profit per combination of ``dims``, best (or worst) payer first.

    Dimensions stay columns, so values may contain any character.
    """
    revenue, payout = F.sum(money_or_zero("revenue")), F.sum(money_or_zero("payout"))
    grouped = (
        _of_campaign(conversions, var3)
        .groupBy(*[or_unknown(d).alias(d) for d in dims])
        .agg(_count().alias("convs"), revenue.alias("_revenue"), payout.alias("_payout"))
        .filter(F.col("convs") >= min_convs)
        .select(
            *dims,
            "convs",
            money("_revenue").alias("revenue"),
            money("_payout").alias("payout"),
            mean("_revenue", "convs").alias("rev_per_conv"),
            money(F.col("_revenue") - F.col("_payout")).alias("profit"),
        )
    )
    first = F.asc("rev_per_conv") if worst else F.desc("rev_per_conv")
    ordered = grouped.orderBy(first, *dims)
    return ordered if limit is None else ordered.limit(limit)


def money_or_zero(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast(MONEY), F.lit(0).cast(MONEY))


def conversion_totals(conversions: DataFrame, live_visits: DataFrame) -> DataFrame:
    """Conversions, revenue, their average (NULL without conversions) and visits, in one row."""
    tracked = live_visits.agg(_count().alias("n")).scalar()
    return conversions.agg(
        _count().alias("total_conversions"),
        F.coalesce(F.sum(money_or_zero("revenue")), F.lit(0).cast("decimal(28,6)")).alias("_r"),
    ).select(
        "total_conversions",
        money("_r").alias("total_revenue"),
        mean("_r", "total_conversions").alias("avg_rev_per_conv"),
        tracked.alias("visits_tracked"),
    )


def overall_stats(conversions: DataFrame, *, var3: str | None = None) -> DataFrame:
    """Count, sum, mean and median of revenue, in one row."""
    rows = _of_campaign(clean_conversions(conversions), var3)
    median = grouped_median(rows, [], "revenue").select("median").scalar()
    return rows.agg(_count().alias("conversions"), F.sum("revenue").alias("_r")).select(
        "conversions",
        money("_r").alias("total_revenue"),
        mean("_r", "conversions").alias("avg_revenue"),
        median.alias("median_revenue"),
    )


def var3_stats(conversions: DataFrame, *, min_conversions: int = 50) -> DataFrame:
    """Count, sum and mean of revenue per campaign variable with enough conversions."""
    return (
        clean_conversions(conversions)
        .groupBy(F.col("custom_var_3").alias("var3"))
        .agg(_count().alias("conversions"), F.sum("revenue").alias("_r"))
        .filter(F.col("conversions") >= min_conversions)
        .select(
            "var3",
            "conversions",
            money("_r").alias("total_revenue"),
            mean("_r", "conversions").alias("avg_revenue"),
        )
    )


def var3_rankings(
    conversions: DataFrame, *, min_conversions: int = 50, limit: int = 10
) -> DataFrame:
    """The ``limit`` best and worst campaign variables by mean revenue.

    Both lists are in descending order of the mean; ``list_rank`` counts along it.
    """
    stats = var3_stats(conversions, min_conversions=min_conversions)
    best = stats.orderBy(F.desc("avg_revenue"), "var3").limit(limit)
    worst = stats.orderBy(F.asc("avg_revenue"), F.desc("var3")).limit(limit)
    # Each list holds at most ``limit`` rows.
    listed = best.withColumn("list", F.lit("top")).unionByName(
        worst.withColumn("list", F.lit("bottom"))
    )
    rank = F.row_number().over(Window.partitionBy("list").orderBy(F.desc("avg_revenue"), "var3"))
    return listed.withColumn("list_rank", rank)


def _long(rows: DataFrame, features: list[str], *ids: str) -> DataFrame:
    """One row per (row, feature) holding that feature's value."""
    return rows.select(*ids, *features).unpivot(list(ids), features, "feature", "value")


def deviation_pct(average: Column, center: Column) -> Column:
    """Distance of ``average`` from ``center`` in percent; 0 for a center of 0 or less."""
    return F.when(center > 0, (average - center) / F.nullif(center, F.lit(0.0)) * 100).otherwise(
        F.lit(0.0)
    )


def _above(center: Column) -> Column:
    """The conversions of cells that earn more than ``center``."""
    return F.coalesce(F.sum(F.when(money("revenue") > center, F.col("_n"))), F.lit(0).cast("bigint"))


def feature_patterns(
    conversions: DataFrame,
    features: list[str] = SEGMENT_FEATURES,
    *,
    min_samples: int = 20,
    var3: str | None = None,
) -> DataFrame:
    """Each value of each feature against the overall median revenue.

    ``pct_high`` is the share of the value's conversions above the median.
    """
    cells = revenue_cells(conversions, features, var3=var3)
    overall = grouped_median(cells, [], "revenue", weight="_n").select(F.struct("median", "n")).scalar()
    average = mean("_r", "count")
    return (
        _long(cells, features, "revenue", "_n", "_r")
        .filter(_known("value"))
        .groupBy("feature", "value")
        .agg(F.sum("_n").alias("count"), F.sum("_r").alias("_r"), _above(overall["median"]).alias("_high"))
        .filter((F.col("count") >= min_samples) & (overall["n"] >= min_samples))
        .select(
            "feature",
            "value",
            "count",
            average.alias("avg_revenue"),
            money("_r").alias("total_revenue"),
            (F.lit(100.0) * F.col("_high") / F.col("count")).alias("pct_high"),
            deviation_pct(average, overall["median"]).alias("deviation"),
        )
    )


def two_feature_patterns(
    conversions: DataFrame,
    pairs: list[tuple[str, str]] = FEATURE_PAIRS,
    *,
    min_samples: int = 15,
    var3: str | None = None,
    min_deviation: float = 20,
) -> DataFrame:
    """Each combination of a feature pair against the overall **mean** revenue.

    Only combinations more than ``min_deviation`` percent off the mean are kept.
    """
    cells = revenue_cells(conversions, [f for pair in pairs for f in pair], var3=var3)
    overall = _overall(cells)
    center = F.nullif(overall["mean"], F.lit(0.0))
    average = mean("_r", "count")
    combos = F.array(
        *[
            F.struct(
                F.lit(a).alias("feature_1"),
                F.lit(b).alias("feature_2"),
                F.col(a).alias("value_1"),
                F.col(b).alias("value_2"),
            )
            for a, b in pairs
        ]
    )
    dims = ["feature_1", "feature_2", "value_1", "value_2"]
    return (
        cells.select("revenue", "_n", "_r", F.inline(combos))
        .filter(_known("value_1", "value_2"))
        .groupBy(*dims)
        .agg(F.sum("_n").alias("count"), F.sum("_r").alias("_r"), _above(overall["median"]).alias("_high"))
        .filter((F.col("count") >= min_samples) & (overall["n"] >= min_samples))
        .select(
            *dims,
            "count",
            average.alias("avg_revenue"),
            (F.lit(100.0) * F.col("_high") / F.col("count")).alias("pct_high"),
            ((average - center) / center * 100).alias("deviation"),
        )
        .filter(F.abs("deviation") > min_deviation)
    )


def _ends(
    patterns: DataFrame, group: list[str], ties: list[str], *, beyond: float, keep: int
) -> DataFrame:
    """Per group, the ``keep`` best patterns above +``beyond`` and the ``keep`` worst below.

    ``list_rank`` 1 is the best to scale and the worst to block. One ranking serves both lists,
    and its filter prunes inside the map tasks.
    """
    average = F.col("avg_revenue")
    merit = F.when(F.col("action") == "SCALE", -average).otherwise(average)
    place = F.row_number().over(Window.partitionBy(*group, "action").orderBy(merit, *ties))
    return (
        patterns.withColumn("action", _action(beyond))
        .filter(F.col("action").isNotNull())
        .withColumn("list_rank", place)
        .filter(F.col("list_rank") <= keep)
    )


def _action(beyond: float) -> Column:
    return F.when(F.col("deviation") > beyond, "SCALE").when(
        F.col("deviation") < -beyond, "BLOCK"
    )


def scale_block_lists(
    conversions: DataFrame,
    *,
    min_samples: int = 30,
    beyond: float = 20,
    keep: int = 5,
    var3: str | None = None,
) -> DataFrame:
    """Per feature, the values to scale and the values to block."""
    patterns = feature_patterns(conversions, min_samples=min_samples, var3=var3)
    return _ends(patterns, ["feature"], ["value"], beyond=beyond, keep=keep)


def scale_block_pairs(
    conversions: DataFrame,
    *,
    min_samples: int = 20,
    beyond: float = 30,
    keep: int = 3,
    var3: str | None = None,
) -> DataFrame:
    """Per feature pair, the combinations to scale and the combinations to block."""
    patterns = two_feature_patterns(conversions, min_samples=min_samples, var3=var3)
    return _ends(
        patterns, ["feature_1", "feature_2"], ["value_1", "value_2"], beyond=beyond, keep=keep
    )


def isp_deep_dive(
    conversions: DataFrame, *, min_samples: int = 20, limit: int = 10, var3: str | None = None
) -> DataFrame:
    """Providers with the highest and the lowest mean revenue."""
    patterns = feature_patterns(conversions, ["isp"], min_samples=min_samples, var3=var3)
    top = patterns.orderBy(F.desc("avg_revenue"), "value").limit(limit)
    bottom = patterns.orderBy(F.asc("avg_revenue"), F.desc("value")).limit(limit)
    return top.withColumn("list", F.lit("top")).unionByName(
        bottom.withColumn("list", F.lit("bottom"))
    )


def recommended_actions(
    conversions: DataFrame,
    *,
    min_samples: int = 30,
    beyond: float = 30,
    limit: int = 5,
    var3: str | None = None,
) -> DataFrame:
    """The patterns with the most revenue at stake, over all features together."""
    patterns = feature_patterns(conversions, min_samples=min_samples, var3=var3)
    place = F.row_number().over(
        Window.partitionBy("action").orderBy(F.desc("total_revenue"), "feature", "value")
    )
    return (
        patterns.withColumn("action", _action(beyond))
        .filter(F.col("action").isNotNull())
        .withColumn("list_rank", place)
        .filter(F.col("list_rank") <= limit)
    )


def var3_overview(
    conversions: DataFrame,
    *,
    min_conversions: int = 50,
    scale_above: float = 1.2,
    block_below: float = 0.8,
) -> DataFrame:
    """Campaign variables against the overall mean revenue, largest total first."""
    rows = clean_conversions(conversions)
    overall = rows.agg(mean(F.sum("revenue"), _count()).alias("m")).scalar()
    average = F.col("avg_revenue")
    return (
        var3_stats(conversions, min_conversions=min_conversions)
        .withColumn("vs_overall_avg", (average - overall) / F.nullif(overall, F.lit(0.0)))
        .withColumn(
            "status",
            F.when(average > overall * scale_above, "SCALE")
            .when(average < overall * block_below, "BLOCK")
            .otherwise("OK"),
        )
        .orderBy(F.desc("total_revenue"), "var3")
    )


def campaign_patterns(
    conversions: DataFrame,
    features: list[str] = CAMPAIGN_FEATURES,
    *,
    min_conversions: int = 50,
    beyond: float = 25,
) -> DataFrame:
    """Values of each feature that deviate from their own campaign variable's median revenue.

    All campaign variables at once: medians are grouped, values are unpivoted and grouped, and the
    two grouped results meet. A value needs max(5, n // 20) conversions, n being its campaign's.
    """
    cells = revenue_cells(conversions, ["custom_var_3", *features])
    return _campaign_patterns(cells, features, min_conversions, beyond)


def _campaign_patterns(
    cells: DataFrame, features: list[str], min_conversions: int, beyond: float
) -> DataFrame:
    campaigns = grouped_median(cells, ["custom_var_3"], "revenue", weight="_n").filter(
        F.col("n") >= min_conversions
    )
    values = (
        _long(cells, features, "custom_var_3", "_n", "_r")
        .filter(_known("value"))
        .groupBy("custom_var_3", "feature", "value")
        .agg(F.sum("_n").alias("conversions"), F.sum("_r").alias("_r"))
    )
    average = mean("_r", "conversions")
    enough = F.greatest(F.lit(5).cast("bigint"), F.expr("n div 20"))
    return (
        values.join(campaigns, "custom_var_3")
        .filter(F.col("conversions") >= enough)
        .select(
            F.col("custom_var_3").alias("var3"),
            "feature",
            "value",
            "conversions",
            average.alias("avg_revenue"),
            money("_r").alias("total_revenue"),
            deviation_pct(average, F.col("median")).alias("deviation"),
        )
        .filter(F.abs("deviation") > beyond)
    )


def patterns_by_var3(
    conversions: DataFrame, *, min_conversions: int = 50, beyond: float = 25
) -> DataFrame:
    """The campaign pattern sheet: display labels, deviation as a fraction, action."""
    patterns = campaign_patterns(conversions, min_conversions=min_conversions, beyond=beyond)
    return patterns.select(
        "var3",
        F.initcap(F.replace("feature", F.lit("_"), F.lit(" "))).alias("dimension"),
        "value",
        "conversions",
        "avg_revenue",
        "total_revenue",
        (F.col("deviation") / 100).alias("vs_campaign_median"),
        F.when(F.col("deviation") > beyond, "SCALE").otherwise("BLOCK").alias("action"),
    ).orderBy("var3", "dimension", F.desc("vs_campaign_median"), "value")


def _top_patterns(conversions: DataFrame, action: str, limit: int, **settings) -> DataFrame:
    return (
        patterns_by_var3(conversions, **settings)
        .filter(F.col("action") == action)
        .orderBy(F.desc("total_revenue"), "var3", "dimension", "value")
        .limit(limit)
    )


def top_scale(conversions: DataFrame, *, limit: int = 50, **settings) -> DataFrame:
    """Scale opportunities with the most revenue."""
    return _top_patterns(conversions, "SCALE", limit, **settings)


def top_block(conversions: DataFrame, *, limit: int = 50, **settings) -> DataFrame:
    """Block targets with the most revenue."""
    return _top_patterns(conversions, "BLOCK", limit, **settings)


def var3_insights(
    conversions: DataFrame, *, min_conversions: int = 50, beyond: float = 25, keep: int = 3
) -> DataFrame:
    """Per campaign variable and feature, the best values to scale and the worst to block.

    A campaign variable without any such value does not appear.
    """
    patterns = campaign_patterns(conversions, min_conversions=min_conversions, beyond=beyond)
    return _ends(patterns, ["var3", "feature"], ["value"], beyond=beyond, keep=keep)


def report_summary(
    conversions: DataFrame, *, min_conversions: int = 50, beyond: float = 25
) -> DataFrame:
    """Campaign variables (without 'unknown'), patterns found, conversions and revenue."""
    cells = revenue_cells(conversions, ["custom_var_3", *CAMPAIGN_FEATURES])
    patterns = _campaign_patterns(cells, CAMPAIGN_FEATURES, min_conversions, beyond)
    found = patterns.agg(_count().alias("n")).scalar()
    per_campaign = cells.groupBy("custom_var_3").agg(F.sum("_n").alias("_n"), F.sum("_r").alias("_r"))
    return per_campaign.agg(
        F.count_if(F.col("custom_var_3") != "unknown").alias("var3_count"),
        F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("total_conversions"),
        money(F.sum("_r")).alias("total_revenue"),
    ).select("var3_count", found.alias("pattern_count"), "total_conversions", "total_revenue")
