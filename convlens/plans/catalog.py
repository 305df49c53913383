"""Every operator as a runnable query over the event table.

A query takes the session and the folder of the tables. Thresholds are those of the small test
tables where the operators' defaults, meant for production volumes, would return nothing; the
rows are never restricted.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from convlens.functions import expr as X
from convlens.operators import anomaly, features, ingest, joins, patterns, report, tree, views
from convlens.operators.patterns import PATTERN_PRESETS
from convlens.runtime import cut, scratch
from convlens.sources import derive, schemas
from convlens.plans import sync
from convlens.sources.tables import FORMATS, read_report, read_table, scan_projected, write_report
from convlens.streaming import jobs

AS_OF = datetime(2024, 1, 30, 22)
TODAY = date(2024, 1, 30)
# Where "now" is not on the hour, so that cutting to whole hours shows.
NOW = datetime(2024, 1, 30, 21, 40)
ZONE = "America/Los_Angeles"

ANOMALY = {"min_baseline": 5, "hours": 24, "min_current": 2, "z_threshold": 0.1}

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def doubles(frame: DataFrame) -> DataFrame:
    """Exact amounts as doubles, for results that leave Spark."""
    exact = [f.name for f in frame.schema.fields if isinstance(f.dataType, DecimalType)]
    return frame.withColumns({c: X.money(c) for c in exact})


def register(name: str, query: Query) -> None:
    REGISTRY[name] = query


def on_visits(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    register(name, lambda spark, sf: doubles(build(derive.visits(spark, sf))))


def on_conversions(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    register(name, lambda spark, sf: doubles(build(derive.conversions(spark, sf))))


def on_both(name: str, build: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    register(
        name,
        lambda spark, sf: doubles(
            build(derive.live_visits(spark, sf), derive.conversions(spark, sf))
        ),
    )


# --- rollups, trends and alerts over visits -------------------------------------------------

on_visits("hourly_rollup", lambda v: views.hourly_rollup(v, AS_OF - timedelta(days=30), AS_OF))
on_visits("daily_summary", lambda v: views.daily_summary(v, AS_OF))
on_visits("hourly_patterns", lambda v: views.hourly_patterns(v, AS_OF, min_samples=2))
on_visits("realtime_cr", lambda v: views.realtime_cr(v, AS_OF, min_visits=2))
on_visits("best_hours", lambda v: views.best_hours(v, AS_OF, min_visits=5))
on_visits("hourly_heatmap", lambda v: views.hourly_heatmap(v, AS_OF))
on_visits("hourly_heatmap_grid", lambda v: views.hourly_heatmap_grid(v, AS_OF))
on_visits("country_trends", lambda v: views.country_trends(v, AS_OF))
on_visits("emerging_countries", lambda v: views.emerging_countries(v, AS_OF, growth=1.0))
on_visits("campaign_momentum", lambda v: views.campaign_momentum(v, AS_OF))
on_visits("campaign_saturation", lambda v: views.campaign_saturation(v, AS_OF))
on_visits("cr_by_segment", lambda v: views.cr_by_segment(v, AS_OF, min_visits=10))
on_visits("anomaly_cr", lambda v: anomaly.anomaly_cr(v, AS_OF, **ANOMALY))
on_visits("traffic_drops", lambda v: anomaly.traffic_drops(v, AS_OF, ratio=1.0))
on_visits("check_alerts", lambda v: anomaly.check_alerts(v, AS_OF, ratio=0.6, **ANOMALY))
on_visits("ml_features", lambda v: features.ml_features(v, AS_OF))

# --- visits and conversions together ---------------------------------------------------------

on_both("visit_conversions", joins.visit_conversions)
on_both("flag_converted", lambda v, c: joins.flag_converted(v, c).select(
    "click_id", "campaign_id", "custom_var_3", "converted"))
on_both("daily_campaign_performance", lambda v, c: joins.daily_campaign_performance(v, c, AS_OF))
on_both("country_cr", lambda v, c: joins.country_cr(v, c, AS_OF))
on_both("device_os_cr", lambda v, c: joins.device_os_cr(v, c, AS_OF))
on_both("low_conversion_segments", joins.low_conversion_segments)
on_both("conversion_totals", lambda v, c: patterns.conversion_totals(c, v))
on_both("referential_check", lambda v, c: joins.referential_check(c, v).select(
    "click_id", "transaction_id", "postback_timestamp", "revenue"))
on_conversions("attribute_conversions", lambda c: c.select(
    "transaction_id", "click_id", "postback_timestamp", "visit_timestamp"))
on_conversions("conversion_timing", lambda c: joins.conversion_timing(c, AS_OF))

# --- segment patterns ------------------------------------------------------------------------

for _preset, _dims in PATTERN_PRESETS.items():
    on_conversions(
        f"pattern_stats_{_preset}", lambda c, dims=_dims: patterns.pattern_stats(c, dims)
    )
on_conversions("pattern_stats_worst", lambda c: patterns.pattern_stats(
    c, PATTERN_PRESETS["var3_country"], worst=True, limit=15))
on_conversions("pattern_stats_of_var3", lambda c: patterns.pattern_stats(
    c, PATTERN_PRESETS["var3_device_os"], var3="v1"))
on_conversions("var3_rankings", lambda c: patterns.var3_rankings(c, limit=3))
on_conversions("feature_patterns", patterns.feature_patterns)
on_conversions("feature_patterns_of_var3", lambda c: patterns.feature_patterns(c, var3="v2"))
on_conversions("two_feature_patterns", patterns.two_feature_patterns)
on_conversions("overall_stats", patterns.overall_stats)
on_conversions("scale_block_lists", patterns.scale_block_lists)
on_conversions("scale_block_pairs", patterns.scale_block_pairs)
on_conversions("isp_deep_dive", patterns.isp_deep_dive)
on_conversions("recommended_actions", patterns.recommended_actions)
on_conversions("var3_overview", patterns.var3_overview)
on_conversions("patterns_by_var3", patterns.patterns_by_var3)
on_conversions("top_scale", patterns.top_scale)
on_conversions("top_block", patterns.top_block)
on_conversions("var3_insights", patterns.var3_insights)
on_conversions("report_summary", patterns.report_summary)

# --- performance report and listings ---------------------------------------------------------

for _dimension in report.DIMENSIONS:
    on_visits(
        f"performance_report_{_dimension.replace('-', '_')}",
        lambda v, d=_dimension: report.performance_report(v, TODAY, group_by=d, days_back=7, tz=ZONE),
    )
on_visits("performance_report_filtered", lambda v: report.performance_report(
    v,
    TODAY,
    group_by="lander",
    from_date=date(2024, 1, 10),
    to_date=date(2024, 1, 20),
    filters={"campaign": "c3", "offer": "o1"},
    sort_by="visits",
    descending=False,
))
on_visits("summary", lambda v: report.summary(v, TODAY))
on_visits("top_performers", lambda v: report.top_performers(v, TODAY, metric="revenue", limit=5))
on_visits("worst_performers", lambda v: report.worst_performers(v, TODAY, entity="hour"))
for _kind in report.CATALOG_PARENTS:
    on_visits(
        f"catalog_{_kind.replace('-', '_')}",
        lambda v, k=_kind: report.dimension_catalog(v, k),
    )
on_conversions("conversion_listing", lambda c: report.conversion_listing(
    c, TODAY, days_back=3, campaign_id="c3"))
register("click_listing", lambda spark, sf: report.click_listing(
    derive.live_clicks(spark, sf), TODAY, "c3", days_back=3))
on_visits("format_report_row", lambda v: report.format_report_row(
    report.performance_report(v, TODAY, days_back=7)))

# --- decision trees --------------------------------------------------------------------------

on_conversions("high_revenue_label", tree.high_revenue_label)
on_conversions("label_encode", tree.label_encode)
on_conversions("segment_tree", tree.segment_tree)
on_conversions("tree_cv_accuracy", tree.tree_cv_accuracy)
on_conversions("feature_importance", lambda c: tree.feature_importance(c, top=None))
on_conversions("segment_rules", tree.segment_rules)
on_conversions("ml_summary", tree.ml_summary)

# --- ingest ----------------------------------------------------------------------------------


def _numbered(frame: DataFrame, number: str = "click_id") -> DataFrame:
    return frame.withColumn("ingest_seq", F.col(number).cast("bigint"))


def raw_visits(spark: SparkSession, sf: str) -> DataFrame:
    return derive.raw_rows(
        _numbered(derive.live_visits(spark, sf)), schemas.VISIT_FIELDS, schemas.VISIT_TIMES
    )


def raw_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return derive.raw_rows(
        _numbered(derive.live_clicks(spark, sf)), schemas.CLICK_FIELDS, schemas.CLICK_TIMES
    )


def odd_revenue() -> Column:
    """Revenue as feeds write it: small, large and very large, in several ways, or no number at all."""
    turn = F.col("transaction_id").cast("bigint") % 7
    text = F.col("revenue").cast("string")
    for place, written in enumerate(["0.01", "999999.99", "1500000", "1.0E9", "n/a", ""]):
        text = F.when(turn == place, written).otherwise(text)
    return text


def raw_conversions(spark: SparkSession, sf: str) -> DataFrame:
    return derive.raw_rows(
        _numbered(derive.conversions(spark, sf).withColumn("revenue", odd_revenue()), "transaction_id"),
        schemas.CONVERSION_FIELDS,
        schemas.CONVERSION_TIMES,
    )


def raw_visits_v1(spark: SparkSession, sf: str) -> DataFrame:
    """Visits as the first feed wrote them: even rows by the first keys, odd rows by the others."""
    even = F.col("visit_id").cast("bigint") % 2 == 0
    clock = F.date_format("visit_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    won = F.col("is_conversion")
    return derive.visits(spark, sf).select(
        F.to_json(
            F.struct(
                F.when(even, F.concat(F.lit("visit-"), F.col("visit_id"))).alias("visitId"),
                F.col("click_id").alias("clickId"),
                F.col("campaign_id").alias("campaignId"),
                F.col("campaign_name").alias("campaignName"),
                F.when(even, clock).otherwise("").alias("visitTimestamp"),
                clock.alias("timestamp"),
                F.when(even, F.col("country_code")).alias("countryCode"),
                F.when(~even, F.col("country_code")).alias("country"),
                F.col("device").alias("deviceType"),
                F.when(even, F.col("custom_var_3")).alias("customVariable3"),
                F.when(~even, F.col("custom_var_3")).alias("v3"),
                F.col("revenue").cast("double").alias("revenue"),
                F.col("cost").cast("string").alias("cost"),
                F.col("is_click").alias("isClick"),
                F.when(even, won).alias("isConversion"),
                F.when(~even, won.cast("int")).alias("conversions"),
            )
        ).alias("value")
    )


def raw_conversions_v1(spark: SparkSession, sf: str) -> DataFrame:
    """Conversions as the first feed wrote them: the time and the id move between keys."""
    turn = F.col("transaction_id").cast("bigint") % 4
    clock = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    posted = F.date_format("postback_timestamp", clock)
    return derive.conversions(spark, sf).select(
        F.to_json(
            F.struct(
                F.col("click_id").alias("clickId"),
                F.when(turn == 0, F.col("transaction_id")).alias("conversionId"),
                F.when(turn == 1, F.col("transaction_id")).alias("postbackId"),
                F.when(turn == 0, posted).alias("conversionTimestamp"),
                F.when(turn == 1, posted).alias("timestamp"),
                F.when(turn == 2, posted).alias("postbackTimestamp"),
                F.date_format("visit_timestamp", clock).alias("visitTimestamp"),
                F.col("campaign_id").alias("campaignId"),
                F.col("country_code").alias("country"),
                F.col("transaction_id").alias("txid"),
                F.col("conversion_type").alias("conversionType"),
                F.col("revenue").cast("double").alias("revenue"),
            )
        ).alias("value")
    )


register("normalize_visits", lambda spark, sf: ingest.normalize_visits(
    raw_visits(spark, sf)).drop("raw_data", "ingest_seq"))
register("normalize_clicks", lambda spark, sf: ingest.normalize_clicks(
    raw_clicks(spark, sf)).drop("raw_data", "ingest_seq"))
register("normalize_conversions", lambda spark, sf: doubles(
    ingest.normalize_conversions(raw_conversions(spark, sf)).drop("raw_data", "ingest_seq")))
register("normalize_visits_fallback", lambda spark, sf: doubles(
    ingest.normalize_visits_fallback(raw_visits_v1(spark, sf)).select(
        "visit_id", "click_id", "campaign_id", "visit_timestamp", "country_code", "device_type",
        "custom_var_3", "revenue", "cost", "profit", "is_click", "is_conversion")))
register("normalize_conversions_fallback", lambda spark, sf: doubles(
    ingest.normalize_conversions_fallback(raw_conversions_v1(spark, sf), NOW).select(
        "conversion_id", "click_id", "campaign_id", "conversion_timestamp", "visit_timestamp",
        F.col("time_to_convert").cast("interval second").cast("decimal(18,6)").alias("time_to_convert_s"),
        "country_code", "revenue", "payout", "transaction_id", "conversion_type")))


def parse_event_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Event times written in five ways and read back."""
    turn = F.col("event_id") % 5
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    text = (
        F.when(turn == 0, F.date_format("ts", "yyyy-MM-dd hh:mm:ss a"))
        .when(turn == 1, F.concat(F.date_format("ts", iso), F.lit("Z")))
        .when(turn == 2, F.concat(F.date_format("ts", iso), F.lit("+05:30")))
        .when(turn == 3, F.concat(F.lit("bad "), F.col("event_id").cast("string")))
        .otherwise("")
    )
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_id", text.alias("text"))
    return rows.select(
        "event_id", X.parse_event_ts("text").alias("parsed"), X.unparsed_ts("text").alias("unread")
    )


register("parse_event_ts", parse_event_ts)


def _repeated(frame: DataFrame, number: str, moved: str) -> DataFrame:
    """Rows, then all of them once more as later copies that differ in ``moved``, then junk ids."""
    first = _numbered(frame, number)
    later = F.col("ingest_seq") + 1_000_000_000
    copies = first.withColumn(moved, F.lit("copy")).withColumn("ingest_seq", later)
    junk = first.withColumn("click_id", F.lit("")).withColumn("ingest_seq", later * 2)
    return first.unionByName(copies).unionByName(junk)


register("dedupe_visits", lambda spark, sf: ingest.dedupe_visits(
    _repeated(derive.live_visits(spark, sf), "click_id", "device")).select(
        "click_id", "device", "campaign_id", "ingest_seq"))
register("dedupe_clicks", lambda spark, sf: ingest.dedupe_clicks(
    _repeated(derive.live_clicks(spark, sf), "click_id", "os")).select(
        "click_id", "os", "campaign_id", "ingest_seq"))
register("dedupe_conversions", lambda spark, sf: ingest.dedupe_conversions(
    _repeated(derive.conversions(spark, sf), "transaction_id", "device")).select(
        "click_id", "postback_timestamp", "device", "ingest_seq"))
# The first feed's conversion id falls back to the click id, which repeats.
register("dedupe_conversions_v1", lambda spark, sf: ingest.dedupe_conversions_v1(
    _numbered(derive.conversions(spark, sf), "transaction_id").withColumn(
        "conversion_id", F.col("click_id"))).select("conversion_id", "transaction_id", "ingest_seq"))


def upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Older conversions merged with the newer days, whose amounts were corrected meanwhile."""
    columns = ["transaction_id", "click_id", "postback_timestamp", "device", "revenue"]
    rows = derive.conversions(spark, sf).select(*columns)
    posted = F.col("postback_timestamp")
    target = rows.filter(posted <= X.ts_lit(datetime(2024, 1, 20)))
    batch = rows.filter(posted > X.ts_lit(datetime(2024, 1, 15))).drop("device")
    batch = batch.withColumn("revenue", (F.col("revenue") * 2).cast(X.MONEY))
    return doubles(ingest.upsert(target, batch, ["transaction_id", "click_id"]))


register("upsert", upsert)


def rollup_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The stored rollup of the older days merged with a fresh rollup of the last two."""
    rows = derive.visits(spark, sf)
    stored = views.hourly_rollup(rows, datetime(2024, 1, 1), datetime(2024, 1, 29, 12))
    fresh = views.hourly_rollup(rows, datetime(2024, 1, 29), AS_OF)
    keys = ["hour_timestamp", "campaign_id", "country_code", "device"]
    return doubles(ingest.upsert(stored, fresh, keys))


register("rollup_merge", rollup_merge)


def _arrive(rows: DataFrame, fields, times, folder: str, feed: str) -> None:
    """More raw files in a feed's folder."""
    derive.raw_rows(rows, fields, times).select("value").write.mode("append").text(f"{folder}/raw/{feed}")


def sync_cycle_state(spark: SparkSession, sf: str) -> DataFrame:
    """What four sync cycles stored: half of the files, none, the rest ten days later, none.

    The files that come later hold old rows too; conversions after a cycle's hour wait for the next one.
    """
    folder = scratch(spark, "cycles")
    feeds = {
        "live_visits": (derive.live_visits(spark, sf), "click_id", schemas.VISIT_FIELDS, schemas.VISIT_TIMES, schemas.LIVE_VISITS),
        # Both halves come from one table: their attribution is done once.
        "conversions": (cut(derive.conversions(spark, sf)), "transaction_id", schemas.CONVERSION_FIELDS, schemas.CONVERSION_TIMES, schemas.CONVERSIONS),
    }
    raw = {feed: f"{folder}/raw/{feed}" for feed in feeds}
    found = []
    for cycle, now in enumerate([NOW - timedelta(days=10), NOW - timedelta(days=10), NOW, NOW]):
        for feed, (rows, number, fields, times, _) in feeds.items():
            if cycle % 2 == 0:
                half = F.col(number).cast("bigint") % 2 == cycle // 2
                _arrive(_numbered(rows.filter(half), number), fields, times, folder, feed)
        sync.run_cycle(spark, raw, f"{folder}/tables", now, days_back=5)
        last = {r["sync_type"]: r["last_sync_timestamp"] for r in sync.read_state(spark, f"{folder}/tables").collect()}
        for feed, (*_, schema) in feeds.items():
            stored = read_table(spark, f"{folder}/tables/{feed}", schema).count()
            found.append((cycle, feed, stored, sync.loads(spark, f"{folder}/tables", feed), last[feed]))
    return spark.createDataFrame(found, "cycle int, feed string, stored_rows bigint, loads bigint, last_sync_timestamp timestamp_ntz")


def raw_wide_visits(visits: DataFrame) -> DataFrame:
    """Visits with their outcome as the first feed wrote them."""
    clock = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    text = [F.col(c).cast("string").alias(c) for c in ("cost", "revenue", "profit")]
    return visits.select(
        F.to_json(
            F.struct(
                F.col("visit_id").alias("visitId"),
                F.col("campaign_id").alias("campaignId"),
                F.col("campaign_name").alias("campaignName"),
                F.col("country_code").alias("countryCode"),
                F.col("device").alias("deviceType"),
                F.date_format("visit_timestamp", clock).alias("visitTimestamp"),
                F.col("is_click").alias("isClick"),
                F.col("is_conversion").alias("isConversion"),
                *text,
            )
        ).alias("value")
    )


def cycle_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The rollup that three sync cycles keep: a third of the visits with wrong times and amounts first,
    another third, then the rest beside the corrections."""
    folder = scratch(spark, "cycles")
    rows = derive.visits(spark, sf)
    part = F.col("visit_id").cast("bigint") % 3
    wrong = rows.filter(part == 0).withColumns(
        {
            "visit_timestamp": F.col("visit_timestamp") + F.expr("interval 5 hours"),
            "revenue": (F.col("revenue") * 2).cast(X.MONEY),
            "device": F.lit("unknown"),
        }
    )
    for arriving in (wrong, rows.filter(part == 1), rows.filter(part != 1)):
        raw_wide_visits(arriving).write.mode("append").text(f"{folder}/raw")
        sync.run_cycle(spark, {"visits": f"{folder}/raw"}, f"{folder}/tables", NOW)
    return doubles(read_table(spark, f"{folder}/tables/hourly_stats", schemas.HOURLY_STATS).drop("day"))


def report_files(spark: SparkSession, sf: str) -> DataFrame:
    """The performance report by country written in each format, by campaign, and read back."""
    folder = scratch(spark, "reports")
    rows = derive.conversions(spark, sf).groupBy("campaign_id", "country_code").agg(
        F.count(F.lit(1)).alias("conversions"), X.money(F.sum("revenue")).alias("revenue"), F.max("postback_timestamp").alias("latest"))
    out = None
    for fmt in FORMATS:
        write_report(rows, f"{folder}/{fmt}", fmt, by=["campaign_id"], order=["country_code"])
        back = read_report(spark, f"{folder}/{fmt}", rows.schema, fmt).withColumn("format", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return out


for _stored in (sync_cycle_state, cycle_rollup, report_files):
    register(_stored.__name__, _stored)
on_visits("tracked_campaigns", lambda v: ingest.tracked_campaigns(v, NOW))
on_visits("tracked_campaigns_filtered", lambda v: ingest.tracked_campaigns(v, NOW, "paign 3"))
on_visits("sync_window", lambda v: ingest.sync_window(
    v, "visit_timestamp", NOW - timedelta(days=1), NOW).select(
        "visit_id", "campaign_id", "visit_timestamp"))
on_visits("backfill", lambda v: ingest.backfill(v, "visit_timestamp", NOW, days=30).groupBy(
    "chunk").agg(F.count(F.lit(1)).alias("visits"), F.sum("revenue").alias("revenue")))
on_visits("campaign_snapshot", lambda v: ingest.campaign_snapshot(
    v, NOW - timedelta(days=1), NOW))
register("retention_cleanup", lambda spark, sf: ingest.retention_cleanup(
    {
        "live_visits": (derive.live_visits(spark, sf), "visit_timestamp"),
        "live_clicks": (derive.live_clicks(spark, sf), "click_timestamp"),
        "conversions": (derive.conversions(spark, sf), "postback_timestamp"),
    },
    AS_OF,
    days=10,
))
on_conversions("retention_keep", lambda c: ingest.retention_keep(
    c, "visit_timestamp", AS_OF, days=10).select("transaction_id", "visit_timestamp"))
on_conversions("scan_projected", lambda c: scan_projected(c, AS_OF, days=10))
on_conversions("clean_conversions", lambda c: patterns.clean_conversions(
    c.withColumn("revenue", odd_revenue()), tree.TREE_FEATURES).select(
            "transaction_id", "custom_var_3", "revenue", *tree.TREE_FEATURES))

# --- streaming -------------------------------------------------------------------------------


def _run(writer, folder: str) -> None:
    jobs.start(writer, f"{folder}/checkpoint", once=True).awaitTermination()


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Raw JSON files through normalise and de-duplicate in four batches or more, of which every third merges;
    then the stored table with the deltas after it."""
    folder = scratch(spark, "ingest")
    raw_visits(spark, sf).select("value").repartition(4).write.text(f"{folder}/raw")
    raw = jobs.raw_stream(spark, f"{folder}/raw", files_per_batch=1)
    _run(jobs.stream_ingest(raw, folder, "live_visits", compact_every=3), folder)
    stored = jobs.stored_feed(spark, folder, "live_visits")
    return stored.select("click_id", "visit_timestamp", *derive.ATTRIBUTES)


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Live visits, each arriving three times."""
    folder = scratch(spark, "dedupe")
    visits = derive.live_visits_of(derive.event_stream(spark, sf))
    thrice = visits.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    unique = jobs.stream_dedupe(thrice, "visit_timestamp")
    schema = unique.schema
    _run(unique.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    stored = spark.read.schema(schema).parquet(f"{folder}/out")
    return stored.select("click_id", "visit_timestamp", *derive.ATTRIBUTES)


def stream_hourly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, "rollup")
    visits = derive.visits_of(derive.event_stream(spark, sf))
    _run(jobs.rollup_writer(jobs.stream_hourly_rollup(visits), folder), folder)
    return doubles(jobs.stored_rollup(spark, folder))


def stream_visit_conversions(spark: SparkSession, sf: str) -> DataFrame:
    """All visits of the joined streams, which arrive in four batches each that are not in order of time.

    A last batch of one visit and one conversion years later closes the streams: the watermark passes
    every visit, and those without a conversion are reported.
    """
    folder = scratch(spark, "joined")
    part = F.pmod(F.hash("event_id"), F.lit(4))
    events = spark.read.schema(derive.EVENTS_SCHEMA).parquet(f"{sf}/events.parquet")
    visits = derive.live_visits_of(derive.with_attributes(events.repartition(4, part)))
    conversions = derive.conversions(spark, sf)
    feeds = {"visits": (visits, "visit_timestamp"), "conversions": (conversions.repartition(4, "transaction_id"), "postback_timestamp")}
    streams = []
    for feed, (rows, ts) in feeds.items():
        rows.write.parquet(f"{folder}/{feed}")
        closing = {"click_id": F.lit(jobs.CLOSING), ts: X.ts_lit(NOW + timedelta(days=3650))}
        empty = spark.range(1).select(
            *[closing.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema]
        )
        empty.write.mode("append").parquet(f"{folder}/{feed}")
        streams.append(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{feed}"))
    joined = jobs.stream_visit_conversions(*streams, within="2 days", lateness="60 days")
    out = joined.schema
    _run(joined.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    stored = spark.read.schema(out).parquet(f"{folder}/out").filter(F.col("click_id") != jobs.CLOSING)
    return doubles(
        stored.select(
            "click_id", "visit_timestamp", "campaign_id", "conversion_timestamp", "revenue",
            "transaction_id", "converted",
        )
    )


def stream_realtime_cr(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, "recent")
    visits = derive.visits_of(derive.event_stream(spark, sf))
    _run(jobs.recent_counts_writer(jobs.stream_recent_counts(visits), folder), folder)
    counts = jobs.recent_counts(spark, folder)
    return jobs.realtime_cr_of_counts(counts, AS_OF, min_visits=2)


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """All visits arriving in four batches, then the alerts of the stored counts."""
    folder = scratch(spark, "alerts")
    rows = spark.read.schema(derive.EVENTS_SCHEMA).parquet(f"{sf}/events.parquet")
    part = F.pmod(F.hash("event_id"), F.lit(4))
    rows.repartition(4, part).write.parquet(f"{folder}/arriving")
    stream = spark.readStream.schema(derive.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
    visits = derive.visits_of(derive.with_attributes(stream.parquet(f"{folder}/arriving")))
    counts = jobs.stream_alert_counts(visits, lateness="60 days")
    _run(jobs.alert_counts_writer(counts, folder), folder)
    return jobs.stored_alerts(spark, folder, AS_OF, ratio=0.6, **ANOMALY)


for _job in (
    stream_ingest,
    stream_dedupe,
    stream_hourly_rollup,
    stream_visit_conversions,
    stream_realtime_cr,
    stream_alerts,
):
    register(_job.__name__, _job)
