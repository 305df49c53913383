"""From raw tracker rows to stored rows: normalise, de-duplicate, merge, expire.

Raw rows arrive as JSON text in a column named ``value`` (what ``spark.read.text`` and most
stream sources give); any other column, such as an arrival number, is passed through.
"""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from convlens.functions.expr import MONEY, money, nonempty, parse_event_ts, ts_lit, unparsed_ts
from convlens.sources import schemas as S


def _parsed(raw: DataFrame, schema: StructType, column: str) -> tuple[DataFrame, list[str]]:
    others = [c for c in raw.columns if c != column]
    return raw.withColumn("_r", F.from_json(column, schema)), others


def _amount(key: str) -> Column:
    """Missing amounts are 0; so are unreadable ones, whose text :func:`unread_amount` keeps."""
    return F.coalesce(F.col(key).try_cast(MONEY), F.lit(0).cast(MONEY))


def unread_amount(key: str) -> Column:
    """The text of an amount that is no number, or too large to be held, else NULL."""
    return F.when(F.col(key).try_cast(MONEY).isNull(), nonempty(key))


def _normalize(raw, column, schema, fields, times, amounts=()) -> DataFrame:
    rows, others = _parsed(raw, schema, column)
    return rows.select(
        *[F.col(f"_r.{key}").alias(name) for key, name in fields],
        *[parse_event_ts(f"_r.{key}").alias(name) for key, name in times],
        *[_amount(f"_r.{key}").alias(key) for key in amounts],
        *[unparsed_ts(f"_r.{key}").alias(f"{name}_raw") for key, name in times],
        *[unread_amount(f"_r.{key}").alias(f"{key}_raw") for key in amounts],
        F.col(column).alias("raw_data"),
        *others,
    )


def normalize_visits(raw: DataFrame, column: str = "value") -> DataFrame:
    """Raw visits to ``live_visits`` rows; a missing key is NULL."""
    return _normalize(raw, column, S.RAW_VISIT, S.VISIT_FIELDS, S.VISIT_TIMES)


def normalize_clicks(raw: DataFrame, column: str = "value") -> DataFrame:
    return _normalize(raw, column, S.RAW_CLICK, S.CLICK_FIELDS, S.CLICK_TIMES)


def normalize_conversions(raw: DataFrame, column: str = "value") -> DataFrame:
    """Raw conversions to stored rows; missing amounts are 0, unreadable ones are kept as text too."""
    return _normalize(
        raw,
        column,
        S.RAW_CONVERSION,
        S.CONVERSION_FIELDS,
        S.CONVERSION_TIMES,
        S.CONVERSION_MONEY,
    )


def _first_given(keys: list[str]) -> Column:
    """The first key that is present and not empty."""
    return F.coalesce(*[nonempty(f"_r.{key}") for key in keys])


def normalize_visits_fallback(raw: DataFrame, column: str = "value") -> DataFrame:
    """First-generation visits, whose values may sit under alternate keys."""
    rows, others = _parsed(raw, S.RAW_VISIT_V1, column)

    def flag(key: str) -> Column:
        return F.coalesce(F.col(f"_r.{key}").try_cast("boolean"), F.lit(False))

    counted = F.coalesce(F.col("_r.conversions").try_cast("double") > 0, F.lit(False))

    def value(name: str, keys: list[str]) -> Column:
        # A value without alternates is taken as it is, an empty text included.
        return (F.col(f"_r.{keys[0]}") if len(keys) == 1 else _first_given(keys)).alias(name)

    return rows.select(
        *[value(name, keys) for name, keys in S.VISIT_ALTERNATES.items()],
        *[
            parse_event_ts(_first_given(keys)).alias(name)
            for name, keys in S.VISIT_ALTERNATE_TIMES.items()
        ],
        *[
            unparsed_ts(_first_given(keys)).alias(f"{name}_raw")
            for name, keys in S.VISIT_ALTERNATE_TIMES.items()
        ],
        *[_amount(f"_r.{key}").alias(key) for key in ("cost", "revenue", "profit")],
        *[unread_amount(f"_r.{key}").alias(f"{key}_raw") for key in ("cost", "revenue", "profit")],
        flag("isClick").alias("is_click"),
        (flag("isConversion") | counted).alias("is_conversion"),
        F.col(column).alias("raw_data"),
        *others,
    )


def normalize_conversions_fallback(
    raw: DataFrame, now: datetime, column: str = "value"
) -> DataFrame:
    """First-generation conversions.

    The conversion time is the first of four keys, or ``now``; the time to convert is NULL when
    either end is missing or unreadable.
    """
    rows, others = _parsed(raw, S.RAW_CONVERSION_V1, column)
    given = _first_given(S.CONVERSION_ALTERNATE_TIMES)
    converted = F.when(given.isNull(), ts_lit(now)).otherwise(parse_event_ts(given))
    visited = parse_event_ts("_r.visitTimestamp")

    def value(name: str, keys: list[str]) -> Column:
        return (F.col(f"_r.{keys[0]}") if len(keys) == 1 else _first_given(keys)).alias(name)

    return rows.select(
        *[value(name, keys) for name, keys in S.CONVERSION_ALTERNATES.items()],
        converted.alias("conversion_timestamp"),
        visited.alias("visit_timestamp"),
        (converted - visited).alias("time_to_convert"),
        *[_amount(f"_r.{key}").alias(key) for key in ("revenue", "payout")],
        *[unread_amount(f"_r.{key}").alias(f"{key}_raw") for key in ("revenue", "payout")],
        F.col(column).alias("raw_data"),
        *others,
    )


def dedupe_first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row (by ``order``) per ``keys``; rows whose first key is NULL or empty are dropped.

    Spark turns ``row_number() = 1`` into a group limit that runs inside the map tasks as well, so
    an id with very many copies sends one row per task into the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return (
        rows.filter(nonempty(keys[0]).isNotNull())
        .withColumn("_place", place)
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def dedupe_visits(rows: DataFrame, order: str = "ingest_seq") -> DataFrame:
    return dedupe_first(rows, ["click_id"], order)


def dedupe_visits_v1(rows: DataFrame, order: str = "ingest_seq") -> DataFrame:
    return dedupe_first(rows, ["visit_id"], order)


def dedupe_clicks(rows: DataFrame, order: str = "ingest_seq") -> DataFrame:
    return dedupe_first(rows, ["click_id"], order)


def dedupe_conversions(rows: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """First per click and postback time; a missing time is a value of its own."""
    return dedupe_first(rows, ["click_id", "postback_timestamp"], order)


def dedupe_conversions_v1(rows: DataFrame, order: str = "ingest_seq") -> DataFrame:
    return dedupe_first(rows, ["conversion_id"], order)


def of_campaign_name(rows: DataFrame, name_filter: str | None) -> DataFrame:
    """Rows whose campaign name contains the filter (case-sensitive)."""
    if name_filter is None:
        return rows
    return rows.filter(F.coalesce("campaign_name", F.lit("")).contains(name_filter))


def tracked_campaigns(
    visits: DataFrame, now: datetime, name_filter: str | None = None
) -> DataFrame:
    """Campaigns with traffic from yesterday's midnight to today 23:00, under their latest name."""
    midnight = datetime.combine(now.date(), time.min)
    recent = visits.filter(
        (F.col("visit_timestamp") >= ts_lit(midnight - timedelta(days=1)))
        & (F.col("visit_timestamp") < ts_lit(midnight + timedelta(hours=23)))
    )
    campaigns = (
        recent.groupBy("campaign_id", "campaign_name")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("visit_timestamp").alias("_last"))
        .groupBy("campaign_id")
        .agg(
            F.max_by("campaign_name", F.struct("_last", "campaign_name")).alias("campaign_name"),
            F.sum("_n").alias("visits"),
        )
    )
    return of_campaign_name(campaigns, name_filter).filter(F.col("visits") > 0)


def whole_hour(moment: datetime) -> datetime:
    return moment.replace(minute=0, second=0, microsecond=0)


def sync_window(rows: DataFrame, ts: str, since: datetime, until: datetime) -> DataFrame:
    """Rows of the whole hours between two moments; the running hour is left for next time."""
    return rows.filter(
        (F.col(ts) >= ts_lit(whole_hour(since))) & (F.col(ts) < ts_lit(whole_hour(until)))
    )


def backfill_chunks(
    now: datetime, days: int, chunk_days: int = 7
) -> list[tuple[datetime, datetime]]:
    """The (from, to) ranges of a backfill, newest first."""
    return [
        (now - timedelta(days=min(start + chunk_days, days)), now - timedelta(days=start))
        for start in range(0, days, chunk_days)
    ]


def backfill(
    rows: DataFrame, ts: str, now: datetime, *, days: int, chunk_days: int = 7
) -> DataFrame:
    """All chunks of a backfill in one job: the rows of the range with the ``chunk`` they fall in."""
    chunk = F.lit(None).cast("int")
    for number, (since, until) in enumerate(backfill_chunks(now, days, chunk_days)):
        inside = (F.col(ts) >= ts_lit(whole_hour(since))) & (F.col(ts) < ts_lit(whole_hour(until)))
        chunk = F.when(inside, number).otherwise(chunk)
    whole_range = sync_window(rows, ts, now - timedelta(days=days), now)
    return whole_range.withColumn("chunk", chunk)


def campaign_snapshot(visits: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """One summary row per campaign for a sync window, keyed by campaign and first hour.

    These are kept apart from visits: a summary is no visit, and its flags would distort rates.
    """
    start = whole_hour(since)
    window = sync_window(visits, "visit_timestamp", since, until)
    amounts = ["cost", "revenue", "profit"]
    named = ["campaign_name", "traffic_source_id", "traffic_source_name"]
    return (
        window.groupBy("campaign_id", *named)
        .agg(
            F.max("visit_timestamp").alias("_last"),
            F.count_if("is_conversion").alias("_conversions"),
            *[F.sum(c).alias(c) for c in amounts],
        )
        .groupBy("campaign_id")
        .agg(
            F.max_by(F.struct(*named), F.struct("_last", *named)).alias("_d"),
            F.sum("_conversions").alias("_conversions"),
            *[F.sum(c).alias(c) for c in amounts],
        )
        .select(
            F.concat_ws(
                "_", "campaign_id", F.lit(start.strftime("%Y-%m-%dT%H:00:00")), F.lit("0")
            ).alias("visit_id"),
            "campaign_id",
            "_d.*",
            ts_lit(start).alias("visit_timestamp"),
            *[money(c).alias(c) for c in amounts],
            (F.col("_conversions") > 0).alias("is_conversion"),
        )
    )


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], *, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``target`` after merging ``batch`` on ``keys``, which are unique on both sides.

    Columns the batch supplies overwrite, even with NULL; columns it lacks, and those in ``keep``,
    stay as they were. NULL keys equal each other.
    """
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = batch.withColumn("_new", F.lit(True)).alias("new")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}"))
    is_new = F.col("new._new").isNotNull()
    is_old = F.col("old._old").isNotNull()

    def merged(c: str) -> Column:
        if c not in batch.columns:
            return F.col(f"old.{c}")
        if c in keep:
            return F.when(is_old, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}"))
        return F.when(is_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))

    return old.join(new, same, "full").select(*[merged(c).alias(c) for c in target.columns])


def expired(ts: str, as_of: datetime, days: int = 90) -> Column:
    """Older than the retention; a row without a time never expires."""
    return F.coalesce(F.col(ts) < ts_lit(as_of - timedelta(days=days)), F.lit(False))


def retention_keep(rows: DataFrame, ts: str, as_of: datetime, *, days: int = 90) -> DataFrame:
    return rows.filter(~expired(ts, as_of, days))


def retention_cleanup(
    tables: dict[str, tuple[DataFrame, str]], as_of: datetime, *, days: int = 90
) -> DataFrame:
    """Rows past the retention per table, as (table, deleted, kept)."""
    counts = None
    for name, (rows, ts) in tables.items():
        one = rows.agg(
            F.count_if(expired(ts, as_of, days)).alias("deleted"),
            F.count_if(~expired(ts, as_of, days)).alias("kept"),
        ).select(F.lit(name).alias("table_name"), "deleted", "kept")
        counts = one if counts is None else counts.unionByName(one)
    return counts
