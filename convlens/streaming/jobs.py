"""Streaming jobs.

Stored times are UTC ``timestamp_ntz``; event-time operators need a zoned ``timestamp``, so each
job derives ``event_time`` for its watermark and stores UTC again. Sinks are idempotent (a merge on
keys, or one folder per batch), so a batch repeated after a failure leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from convlens.functions.expr import (
    hour_start,
    instant_to_utc,
    nonempty,
    pct,
    trailing,
    utc_to_instant,
)
from convlens.operators.anomaly import check_alerts
from convlens.operators.views import finish_rollup
from convlens.plans.sync import FEEDS, ROLLED_UP, ROLLUP_KEYS, arrival_order, note_hours
from convlens.runtime import cut
from convlens.sources import schemas as S
from convlens.sources.tables import delete_path, located, read_table, table_exists, upsert_table, with_arrival

LATENESS = "24 hours"  # how late an event may arrive; the batch cycle re-reads as much
INTERVAL = "2 minutes"
#: The id of a row that only moves a stream's watermark on.
CLOSING = "closing"


def start(writer, checkpoint: str, *, once: bool = False) -> StreamingQuery:
    """Start a writer: continuously, or once over what is there (``availableNow``)."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=INTERVAL)
    return writer.start()


def _deltas(path: str) -> str:
    return f"{path}_deltas"


def delta_writer(
    totals: DataFrame, path: str, schema: T.StructType, keys: list[str], ts: str, *, compact_every: int = 30
):
    """Running totals (update mode) as one small folder a batch, merged into the table now and then.

    A batch writes its own rows only, so what it costs follows the batch and not the days it touches. Every
    ``compact_every`` batches the deltas so far are merged by key into the day folders, and then
    deleted; doing either twice is harmless. ``read_totals`` sees both.
    """

    def write(batch: DataFrame, number: int) -> None:
        keep_delta(batch, number, path, schema)
        if (number + 1) % compact_every == 0:
            compact(batch.sparkSession, path, schema, keys, ts)

    return totals.writeStream.outputMode("update").foreachBatch(write)


def keep_delta(rows: DataFrame, number: int, path: str, schema: T.StructType) -> None:
    """A batch's rows as a folder of its own; a repeated batch replaces it."""
    rows.select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{_deltas(path)}/batch={number}")


def _newest(deltas: DataFrame, keys: list[str], schema: T.StructType) -> DataFrame:
    """The latest batch's row of each key."""
    others = [c for c in schema.fieldNames() if c not in keys]
    newest = F.max_by(F.struct(*others), "batch").alias("_v")
    return deltas.groupBy(*keys).agg(newest).select(*keys, "_v.*").select(*schema.fieldNames())


def _read_deltas(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    if not table_exists(spark, _deltas(path)):
        return None
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(_deltas(path))


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: list[str],
    ts: str,
    *,
    noted: Callable[[DataFrame], None] | None = None,
) -> None:
    """Merge all deltas into the table, then delete them. One writer at a time, as for any table.

    The oldest go first: what a lost run leaves are the newest rows of their keys, which may be merged again.
    ``noted`` as for ``upsert_table``.
    """
    files, pattern = located(spark, f"{_deltas(path)}/batch=*")
    folders = [f.getPath().toString() for f in files.globStatus(pattern) or []]
    folders.sort(key=lambda folder: int(folder.rsplit("=", 1)[1]))
    if folders:
        rows = cut(_newest(_read_deltas(spark, path, schema), keys, schema))
        upsert_table(spark, rows, path, schema, keys, ts, noted=noted)
        for folder in folders:
            delete_path(spark, folder)


def read_totals(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The table with the deltas that are not merged yet; a key's newest row counts."""
    deltas = _read_deltas(spark, path, schema)
    stored = read_table(spark, path, schema).select(*schema.fieldNames()) if table_exists(spark, path) else None
    if deltas is None:
        return stored if stored is not None else spark.createDataFrame([], schema)
    if stored is not None:
        deltas = deltas.unionByName(stored.withColumn("batch", F.lit(-1).cast("long")))
    return _newest(deltas, keys, schema)


def raw_stream(spark: SparkSession, path: str, *, files_per_batch: int | None = None) -> DataFrame:
    """A folder of raw JSON lines as a stream of text rows with their ``arrival``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_arrival(reader.load(path))


def stream_ingest(raw: DataFrame, warehouse: str, feed: str, *, compact_every: int = 1):
    """Raw rows -> normalised -> first per key within the batch -> merged, last batch winning.

    With ``compact_every`` above 1 a batch writes its own rows only, as a delta, and every so many batches
    the deltas are merged into the day folders; ``stored_feed`` reads both. Each merge rewrites the days it
    touches, so a short trigger should merge seldom. The hours of merged visits are noted for the rollup.
    """
    normalize, dedupe, schema, _, _ = FEEDS[feed]

    def write(batch: DataFrame, number: int) -> None:
        rows = dedupe(normalize(arrival_order(batch)))
        keep_delta(rows, number, f"{warehouse}/{feed}", schema)
        if (number + 1) % compact_every == 0:
            compact_feed(batch.sparkSession, warehouse, feed)

    return raw.writeStream.outputMode("append").foreachBatch(write)


def compact_feed(spark: SparkSession, warehouse: str, feed: str) -> None:
    """Merge what a stream has written of a feed and not merged yet, as before a batch cycle on the same table."""
    _, _, schema, keys, ts = FEEDS[feed]
    noted = (lambda times: note_hours(times, warehouse)) if feed == ROLLED_UP else None
    compact(spark, f"{warehouse}/{feed}", schema, keys, ts, noted=noted)


def stored_feed(spark: SparkSession, warehouse: str, feed: str) -> DataFrame:
    """A feed's table with the deltas that are not merged yet; a key's newest row counts."""
    _, _, schema, keys, _ = FEEDS[feed]
    return read_totals(spark, f"{warehouse}/{feed}", schema, keys)


def _thinned(key: str, ts: str):
    """Of the rows of one id in a batch, the first and the newest; the newest is on time if any is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = pa.array(range(batch.num_rows), pa.int64())
            slim = pa.table({"key": batch.column(key), "at": batch.column(ts), "place": place})
            first = slim.group_by("key").aggregate([("place", "min")]).column("place_min")
            newest = slim.group_by("key").aggregate([("at", "max")]).rename_columns({"at_max": "at"})
            last = slim.join(newest, ["key", "at"], join_type="inner").group_by("key").aggregate([("place", "min")])
            kept = pa.chunked_array([*first.chunks, *last.column("place_min").chunks], pa.int64()).unique().sort()
            yield batch.take(kept)

    return run


def stream_dedupe(
    rows: DataFrame, ts: str, *, key: str = "click_id", lateness: str = LATENESS
) -> DataFrame:
    """The first row per key within the lateness.

    The state holds one entry per id, which expires by itself once the watermark has passed it.
    Copies are thinned where they are read, without state: an id with very many of them sends two rows of each
    Arrow batch into the keyed step.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return (
        rows.filter(nonempty(key).isNotNull())
        .mapInArrow(_thinned(key, ts), schema)
        .withColumn("event_time", utc_to_instant(ts))
        .withWatermark("event_time", lateness)
        .dropDuplicatesWithinWatermark([key])
        .drop("event_time")
    )


def stream_hourly_rollup(visits: DataFrame, *, lateness: str = LATENESS) -> DataFrame:
    """The hourly rollup as running totals (update mode): late visits correct their hour."""
    return (
        visits.withColumn("event_time", utc_to_instant("visit_timestamp"))
        .withWatermark("event_time", lateness)
        .groupBy(
            F.window("event_time", "1 hour").alias("w"), "campaign_id", "country_code", "device"
        )
        .agg(
            F.max(F.struct("event_time", "campaign_name")).alias("_name"),
            F.count(F.lit(1)).alias("visits"),
            F.count_if("is_click").alias("clicks"),
            F.count_if("is_conversion").alias("conversions"),
            *[F.sum(c).cast("decimal(28,6)").alias(c) for c in ("revenue", "cost", "profit")],
        )
        .withColumn("hour_timestamp", instant_to_utc(F.col("w.start")))
        .withColumn("campaign_name", F.col("_name.campaign_name"))
    )


def rollup_writer(totals: DataFrame, warehouse: str, *, compact_every: int = 30):
    """Keep running totals as the stored rollup on its null-safe key; see ``stored_rollup``."""
    path = f"{warehouse}/hourly_stats"
    return delta_writer(finish_rollup(totals), path, S.HOURLY_STATS, ROLLUP_KEYS, "hour_timestamp", compact_every=compact_every)


def stored_rollup(spark: SparkSession, warehouse: str) -> DataFrame:
    return read_totals(spark, f"{warehouse}/hourly_stats", S.HOURLY_STATS, ROLLUP_KEYS)


def stream_visit_conversions(
    live_visits: DataFrame,
    conversions: DataFrame,
    *,
    within: str = "30 days",
    lateness: str = LATENESS,
) -> DataFrame:
    """Each visit beside its conversions of the following ``within``.

    A stream cannot wait forever for a conversion: the bound is what lets the state of a visit be
    dropped and an unconverted visit be reported, once the watermark of both streams has passed it.
    Rows may come in any order within the lateness; those of an empty or missing id meet nothing.
    """
    visit = live_visits.withColumn("visit_time", utc_to_instant("visit_timestamp")).withWatermark(
        "visit_time", lateness
    )
    conversion = conversions.select(
        F.col("click_id").alias("c_click_id"),
        F.col("postback_timestamp").alias("conversion_timestamp"),
        utc_to_instant("postback_timestamp").alias("conversion_time"),
        "revenue",
        "payout",
        "transaction_id",
    ).withWatermark("conversion_time", lateness)
    on = (
        (F.col("click_id") == F.col("c_click_id"))
        & (F.col("conversion_time") >= F.col("visit_time"))
        & (F.col("conversion_time") <= F.col("visit_time") + F.expr(f"interval {within}"))
    )
    return (
        visit.join(conversion, on, "left")
        .withColumn("converted", F.col("c_click_id").isNotNull())
        .drop("c_click_id", "visit_time", "conversion_time")
    )


RECENT_COUNTS = T.StructType(
    [
        T.StructField("until", T.TimestampNTZType()),
        T.StructField("campaign_name", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("visits", T.LongType()),
        T.StructField("conversions", T.LongType()),
    ]
)


def stream_recent_counts(
    visits: DataFrame, *, step: str = "5 minutes", lateness: str = LATENESS
) -> DataFrame:
    """Visits and conversions per step, campaign and country (update mode).

    Steps are half-open at the start, ``until - step < ts <= until``, like the batch windows;
    sliding 24-hour windows would instead update hundreds of windows per visit.
    """
    moment = F.col("event_time") - F.expr("interval 1 microsecond")
    return (
        visits.withColumn("event_time", utc_to_instant("visit_timestamp"))
        .withColumn("event_time", moment)
        .withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", step).alias("w"), "campaign_name", "country_code")
        .agg(
            F.count(F.lit(1)).alias("visits"), F.count_if("is_conversion").alias("conversions")
        )
        .withColumn("until", instant_to_utc(F.col("w.end")))
    )


RECENT_KEYS = ["until", "campaign_name", "country_code"]


def recent_counts_writer(counts: DataFrame, warehouse: str, *, compact_every: int = 30):
    """Keep running counts; see ``recent_counts``."""
    return delta_writer(counts, f"{warehouse}/recent_counts", RECENT_COUNTS, RECENT_KEYS, "until", compact_every=compact_every)


def recent_counts(spark: SparkSession, warehouse: str) -> DataFrame:
    return read_totals(spark, f"{warehouse}/recent_counts", RECENT_COUNTS, RECENT_KEYS)


def realtime_cr_of_counts(
    counts: DataFrame, as_of: datetime, *, min_visits: int = 50
) -> DataFrame:
    """The real-time report from the stored counts, for an ``as_of`` on a step boundary."""
    last_hour = trailing("until", as_of, hours=1)

    def hour_only(c: str):
        return F.coalesce(F.sum(F.when(last_hour, F.col(c))), F.lit(0).cast("bigint"))

    return (
        counts.filter(trailing("until", as_of, hours=24))
        .groupBy("campaign_name", "country_code")
        .agg(
            hour_only("visits").alias("visits_1h"),
            hour_only("conversions").alias("conv_1h"),
            F.sum("visits").alias("visits_24h"),
            F.sum("conversions").alias("conv_24h"),
        )
        .filter(F.col("visits_24h") > min_visits)
        .withColumn("cr_1h", pct("conv_1h", "visits_1h"))
        .withColumn("cr_24h", pct("conv_24h", "visits_24h"))
    )


ALERT_COUNTS = T.StructType(
    [
        T.StructField("until", T.TimestampNTZType()),
        T.StructField("hour", T.TimestampNTZType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("campaign_name", T.StringType()),
        T.StructField("visits", T.LongType()),
        T.StructField("conversions", T.LongType()),
    ]
)
ALERT_KEYS = ["until", "hour", "campaign_id", "campaign_name"]


def stream_alert_counts(
    visits: DataFrame, *, step: str = "5 minutes", lateness: str = LATENESS
) -> DataFrame:
    """Visits and conversions per step, hour and campaign (update mode): what alerts are judged by.

    A step ends at ``until``, inclusive, like the trailing windows; the visit that falls on the hour
    belongs to the next hour, so the hour is a key of its own.
    """
    moment = F.col("event_time") - F.expr("interval 1 microsecond")
    return (
        visits.withColumn("hour", hour_start("visit_timestamp"))
        .withColumn("event_time", utc_to_instant("visit_timestamp"))
        .withColumn("event_time", moment)
        .withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", step).alias("w"), "hour", "campaign_id", "campaign_name")
        .agg(
            F.count(F.lit(1)).alias("visits"), F.count_if("is_conversion").alias("conversions")
        )
        .withColumn("until", instant_to_utc(F.col("w.end")))
    )


def alert_counts_writer(counts: DataFrame, warehouse: str, *, compact_every: int = 30):
    """Keep running totals, so that no alert depends on how batches fall."""
    return delta_writer(counts, f"{warehouse}/alert_counts", ALERT_COUNTS, ALERT_KEYS, "until", compact_every=compact_every)


def stored_alerts(
    spark: SparkSession, warehouse: str, as_of: datetime, *, limit: int | None = None, **thresholds
) -> DataFrame:
    """The alerts of :func:`check_alerts` from the stored counts, for an ``as_of`` on a step boundary.

    Baselines come from the same counts and so follow them; ``thresholds`` are those of
    :func:`check_alerts`.
    """
    counts = read_totals(spark, f"{warehouse}/alert_counts", ALERT_COUNTS, ALERT_KEYS)
    return check_alerts(counts, as_of, limit=limit, **thresholds)
