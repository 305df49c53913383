"""One ingest cycle over files: read, normalise, de-duplicate, merge, roll up, expire."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.functions import expr as X
from convlens.functions.expr import hour_start, nonempty
from convlens.operators import ingest
from convlens.operators.ingest import backfill_chunks, of_campaign_name, sync_window
from convlens.operators.views import hourly_rollup
from convlens.runtime import cut
from convlens.sources import arrivals
from convlens.sources import schemas as S
from convlens.sources.tables import (
    DAY,
    delete_path,
    drop_days,
    expire_table,
    located,
    of_days,
    overwrite_days,
    read_raw,
    read_table,
    table_exists,
    upsert_table,
)

log = logging.getLogger(__name__)

# Stored table -> (normaliser, de-duplicator, schema, keys, time column).
FEEDS = {
    "visits": (
        ingest.normalize_visits_fallback,
        ingest.dedupe_visits_v1,
        S.VISITS,
        ["visit_id"],
        "visit_timestamp",
    ),
    "live_visits": (
        ingest.normalize_visits,
        ingest.dedupe_visits,
        S.LIVE_VISITS,
        ["click_id"],
        "visit_timestamp",
    ),
    "live_clicks": (
        ingest.normalize_clicks,
        ingest.dedupe_clicks,
        S.LIVE_CLICKS,
        ["click_id"],
        "click_timestamp",
    ),
    "conversions": (
        ingest.normalize_conversions,
        ingest.dedupe_conversions,
        S.CONVERSIONS,
        ["click_id", "postback_timestamp"],
        "postback_timestamp",
    ),
}
#: The feed that the stored rollup is of.
ROLLED_UP = "visits"
ROLLUP_KEYS = ["hour_timestamp", "campaign_id", "country_code", "device"]
#: Repeated keys of a load that every task can hold as a list, of eight bytes each.
FEW = 500_000


def arrival_order(raw: DataFrame) -> DataFrame:
    """``ingest_seq`` orders raw rows by the age and name of their file and by position, so that "first"
    has a meaning within a batch; rows that come from no file are ordered as they are read."""
    read = F.monotonically_increasing_id().alias("row")
    if "arrival" not in raw.columns:
        return raw.withColumn("ingest_seq", F.struct(read))
    return raw.withColumn("ingest_seq", F.struct("arrival", read)).drop("arrival")


def rejected_rows(rows: DataFrame, feed: str) -> DataFrame:
    """Normalised rows that cannot be stored where they belong, with the reason and the original text."""
    _, _, _, keys, ts = FEEDS[feed]
    unread = F.col(f"{ts}_raw").isNotNull()
    reason = F.when(nonempty(keys[0]).isNull(), "no id or broken row").when(unread, "unreadable time")
    return rows.select(reason.alias("reason"), "raw_data").filter(F.col("reason").isNotNull())


def first_rows(rows: DataFrame, dedupe: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """``dedupe(rows)`` of rows in written tables, again read from written tables.

    Only rows whose keys repeat need it. Their key hashes are found on the keys alone; while the list is short,
    every task holds it, and the other rows, whole as they are, stay where they have been written. Where
    many repeat, all rows are de-duplicated at once. Two keys of one hash only have more rows compared.
    """
    given = rows.filter(nonempty(keys[0]).isNotNull()).withColumn("_hash", F.xxhash64(*keys))
    repeated = cut(given.groupBy("_hash").count().filter("count > 1").select("_hash"))
    if repeated.count() > FEW:
        return cut(dedupe(rows))
    again = F.broadcast(repeated)
    single = given.join(again, "_hash", "left_anti").drop("_hash")
    first = cut(dedupe(given.join(again, "_hash", "left_semi").drop("_hash")))
    return single.unionByName(first)


def merge_rows(
    spark: SparkSession,
    every: DataFrame,
    warehouse: str,
    feed: str,
    *,
    since: datetime | None = None,
    until: datetime | None = None,
    campaign_filter: str | None = None,
) -> int:
    """Merge normalised rows with their ``ingest_seq`` into a feed's stored table; returns the rows merged.

    The rows are read several times, so they should be those of a written table.

    The hours of visits that come in, and of those they replace, are noted for the rollup.
    """
    _, dedupe, schema, keys, ts = FEEDS[feed]
    rows = of_campaign_name(every, campaign_filter)
    if since is not None and until is not None:
        rows = sync_window(rows, ts, since, until)
    batch = first_rows(rows, dedupe, keys).drop("ingest_seq")
    noted = (lambda times: note_hours(times, warehouse)) if feed == ROLLED_UP else None
    return upsert_table(spark, batch, f"{warehouse}/{feed}", schema, keys, ts, noted=noted, written=True)


def load_feed(
    spark: SparkSession,
    raw_path: str,
    warehouse: str,
    feed: str,
    *,
    since: datetime | None = None,
    until: datetime | None = None,
    campaign_filter: str | None = None,
) -> int:
    """Merge a whole folder of raw JSON lines into its stored table; returns the rows merged.

    Rows without an id, and those whose time cannot be read, are kept in ``rejected/feed=…/load=folder``; it
    holds what the folder's rows were rejected for when it was last loaded.
    """
    every = cut(FEEDS[feed][0](arrival_order(read_raw(spark, raw_path))))
    rejected_rows(every, feed).write.mode("overwrite").parquet(f"{warehouse}/rejected/feed={feed}/load=folder")
    return merge_rows(spark, every, warehouse, feed, since=since, until=until, campaign_filter=campaign_filter)


def load_arrivals(
    spark: SparkSession,
    raw_path: str,
    warehouse: str,
    feed: str,
    *,
    since: datetime | None = None,
    until: datetime | None = None,
    campaign_filter: str | None = None,
) -> int:
    """Merge the files of a folder that no earlier load has read; returns the rows merged.

    With a window, rows of its running hour and later wait in ``pending`` for the next load, and rows
    before it are left to the backfill. What a load writes bears its number; a load that is lost before its state is
    saved has the same number when it is repeated, and finds the same files and waiting rows. Raw text is read
    once, into a written table: a filter on a parsed value would parse the text again, once for each place that
    names the value.
    """
    normalize, _, _, _, ts = FEEDS[feed]
    load = loads(spark, warehouse, feed)
    log, waiting = f"{warehouse}/sync_files", f"{warehouse}/pending/feed={feed}"
    files = cut(arrivals.unseen(spark, raw_path, log, feed, load))
    fresh = arrival_order(arrivals.read_files(spark, raw_path, files))
    new = cut(normalize(fresh))
    rejected_rows(new, feed).write.mode("overwrite").parquet(f"{warehouse}/rejected/feed={feed}/load={load}")
    every = new
    if until is not None:
        if table_exists(spark, f"{waiting}/load={load - 1}"):
            pending = spark.read.schema(fresh.schema).parquet(f"{waiting}/load={load - 1}")
            every = new.unionByName(cut(normalize(pending)))
        later = every.filter(F.col(ts) >= X.ts_lit(ingest.whole_hour(until)))
        later.select(F.col("raw_data").alias("value"), "ingest_seq").write.mode("overwrite").parquet(f"{waiting}/load={load}")
    synced = merge_rows(spark, every, warehouse, feed, since=since, until=until, campaign_filter=campaign_filter)
    arrivals.remember(files, log, feed, load)
    return synced


def read_state(spark: SparkSession, warehouse: str) -> DataFrame:
    """The latest sync time per feed. State is only ever appended, so a lost job cannot harm it."""
    path = f"{warehouse}/sync_state"
    if not table_exists(spark, path):
        return spark.createDataFrame([], S.SYNC_STATE)
    log_rows = spark.read.schema(S.SYNC_STATE).parquet(path)
    latest = F.struct("last_sync_timestamp", "records_synced")
    newest = F.max_by("records_synced", latest).alias("records_synced")
    return log_rows.groupBy("sync_type").agg(
        F.max("last_sync_timestamp").alias("last_sync_timestamp"), newest
    )


def loads(spark: SparkSession, warehouse: str, feed: str) -> int:
    """How many loads of a feed have been completed."""
    path = f"{warehouse}/sync_state"
    if not table_exists(spark, path):
        return 0
    return spark.read.schema(S.SYNC_STATE).parquet(path).filter(F.col("sync_type") == feed).count()


def last_sync(spark: SparkSession, warehouse: str, feed: str, now: datetime, days_back: int = 1):
    row = read_state(spark, warehouse).filter(F.col("sync_type") == feed).first()
    return row["last_sync_timestamp"] if row else now - timedelta(days=days_back)


def save_state(spark: SparkSession, warehouse: str, feed: str, until: datetime, synced: int) -> None:
    """Note that a feed is read up to a moment, and how many rows this run merged."""
    state = spark.createDataFrame([(feed, until, synced)], S.SYNC_STATE)
    state.write.mode("append").parquet(f"{warehouse}/sync_state")


def merge_rollup(
    spark: SparkSession, visits: DataFrame, warehouse: str, now: datetime, *, hours_back: int = 24
) -> None:
    """Recompute the last hours of the rollup and merge them on their null-safe key.

    Whole hours only: a partly covered first hour would overwrite a complete stored one.
    """
    since = ingest.whole_hour(now - timedelta(hours=hours_back))
    rollup = hourly_rollup(visits, since, now)
    upsert_table(
        spark, rollup, f"{warehouse}/hourly_stats", S.HOURLY_STATS, ROLLUP_KEYS, "hour_timestamp"
    )


def note_hours(times: DataFrame, warehouse: str) -> None:
    """Keep the hours of ``times(ts)`` until the rollup has been recomputed for them."""
    hours = times.filter("ts is not null").select(hour_start("ts").alias("hour")).distinct()
    hours.write.parquet(f"{warehouse}/hourly_stats_due/{uuid.uuid4().hex}")


def refresh_rollup(spark: SparkSession, warehouse: str) -> int:
    """Recompute the stored rollup for the hours that merges have touched; returns how many.

    Only the touched hours' visits are read: the list of hours, one value each, prunes day folders and
    bounds the scan. A touched hour's rows are replaced as a whole, so a group that lost its last visit goes.
    What is due is forgotten after the rollup is written; doing it twice is harmless.
    """
    due = f"{warehouse}/hourly_stats_due"
    if not table_exists(spark, due):
        return 0
    files, pattern = located(spark, f"{due}/*/_SUCCESS")
    notes = [str(f.getPath().getParent()) for f in files.globStatus(pattern) or []]
    if not notes:
        return 0
    hours = sorted(r["hour"] for r in spark.read.schema("hour timestamp_ntz").parquet(*notes).distinct().collect())
    if hours:
        days = {h.date() for h in hours}
        first, after = hours[0], hours[-1] + timedelta(hours=1)
        visits = read_table(spark, f"{warehouse}/{ROLLED_UP}", S.VISITS).filter(of_days(days))
        inside = (F.col("visit_timestamp") >= X.ts_lit(first)) & (F.col("visit_timestamp") < X.ts_lit(after))
        visits = visits.filter(inside & hour_start("visit_timestamp").isin(hours)).withColumnRenamed("device_type", "device")
        whole = hourly_rollup(visits, first).withColumn(DAY, F.col("hour_timestamp").cast("date"))
        path = f"{warehouse}/hourly_stats"
        if table_exists(spark, path):
            stored = read_table(spark, path, S.HOURLY_STATS).filter(of_days(days))
            whole = stored.filter(~F.col("hour_timestamp").isin(hours)).unionByName(whole.select(*stored.columns))
        whole = cut(whole)
        overwrite_days(whole, path)
        drop_days(spark, path, days - {r[DAY] for r in whole.select(DAY).distinct().collect()})
    for note in notes:
        delete_path(spark, note)
    return len(hours)


def run_cycle(
    spark: SparkSession,
    raw: dict[str, str],
    warehouse: str,
    now: datetime,
    *,
    days_back: int = 1,
    retention_days: int = 90,
    campaign_filter: str | None = None,
) -> dict[str, int]:
    """Sync every feed in ``raw`` (feed name -> folder), roll up, then expire old rows; returns what expired.

    A cycle goes on from where the last one ended: it reads the files that have arrived since, late
    ones included. Of conversions it takes the whole hours from ``days_back`` days before the last sync (before
    ``now`` at first), because they arrive late, up to the running hour, whose rows wait for the next cycle.
    """
    for feed, path in raw.items():
        windowed = feed == "conversions"
        since = last_sync(spark, warehouse, feed, now, 0) - timedelta(days=days_back) if windowed else None
        synced = load_arrivals(
            spark, path, warehouse, feed, since=since, until=now if windowed else None,
            campaign_filter=campaign_filter if windowed else None,
        )
        save_state(spark, warehouse, feed, now, synced)
    tables = {feed: (FEEDS[feed][2], FEEDS[feed][4]) for feed in raw}
    if ROLLED_UP in raw:
        refresh_rollup(spark, warehouse)
        tables["hourly_stats"] = (S.HOURLY_STATS, "hour_timestamp")
    return {
        name: expire_table(spark, f"{warehouse}/{name}", schema, ts, now, days=retention_days)
        for name, (schema, ts) in tables.items()
    }


def run_backfill(
    spark: SparkSession, raw_path: str, warehouse: str, feed: str, now: datetime, *, days: int, chunk_days: int = 7
) -> list[tuple[datetime, datetime]]:
    """Load a range chunk by chunk, newest first; returns the chunks that failed.

    The folder is read once: its rows of the range are staged by chunk. Each chunk is then a merge of
    its own and noted when it is done, so that running the same backfill again repeats the failed
    chunks only, from what was staged. Rejected rows are kept as by ``load_feed``.
    """
    normalize, _, _, _, ts = FEEDS[feed]
    folder = f"{warehouse}/backfill/{feed}-{now:%Y%m%d%H%M%S}-{days}-{chunk_days}"
    if not table_exists(spark, f"{folder}/staged/_SUCCESS"):
        every = normalize(arrival_order(read_raw(spark, raw_path)))
        staged = ingest.backfill(every, ts, now, days=days, chunk_days=chunk_days)
        bad = rejected_rows(every.withColumn("chunk", F.lit(-1)), feed)
        staged.write.mode("overwrite").partitionBy("chunk").parquet(f"{folder}/staged")
        bad.write.mode("overwrite").parquet(f"{warehouse}/rejected/feed={feed}/load=folder")
    rows = spark.read.parquet(f"{folder}/staged")
    failed = []
    for chunk, (since, until) in enumerate(backfill_chunks(now, days, chunk_days)):
        done = f"{folder}/done/{chunk}"
        if table_exists(spark, f"{done}/_SUCCESS"):
            continue
        try:
            own = rows.filter(F.col("chunk") == chunk).drop("chunk")
            merged = merge_rows(spark, own, warehouse, feed)
            spark.range(1).select(F.lit(merged).alias("rows")).write.mode("overwrite").parquet(done)
        except Exception:  # a bad chunk must not stop the others
            log.exception("backfill chunk %s .. %s failed", since, until)
            failed.append((since, until))
    if feed == ROLLED_UP:
        refresh_rollup(spark, warehouse)
    return failed
