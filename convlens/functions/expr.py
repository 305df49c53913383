"""Column helpers: literals, time parts, ratios and text clean-up.

Nothing here is a Python UDF; each helper builds a built-in expression, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,6)"

# Names of dow 0..6.
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(moment: datetime) -> Column:
    """A UTC moment as a ``timestamp_ntz`` literal (folds, so it reaches the parquet filter)."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def trailing(ts: str | Column, as_of: datetime, **span) -> Column:
    """``as_of - span < ts <= as_of``; ``span`` is given as for ``timedelta``."""
    return (col(ts) > ts_lit(as_of - timedelta(**span))) & (col(ts) <= ts_lit(as_of))


def hour_start(ts: str | Column) -> Column:
    """Hour truncation that never passes through the session time zone."""
    ts = col(ts)
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def minute_start(ts: str | Column) -> Column:
    ts = col(ts)
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.hour(ts), F.minute(ts)
    )


def minute_number(ts: str | Column) -> Column:
    """Whole minutes since the epoch."""
    ts = col(ts)
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 1440 + F.hour(ts) * 60 + F.minute(ts)


def micros_in_minute(ts: str | Column) -> Column:
    return (F.date_part(F.lit("SECOND"), col(ts)) * 1_000_000).cast("bigint")


def dow(ts: str | Column) -> Column:
    """Day of week with Sunday = 0."""
    return (F.dayofweek(col(ts)) - 1).cast("int")


def weekday_name(ts: str | Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in WEEKDAYS]), dow(ts))


def week_start(ts: str | Column) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(col(ts).cast("date"), "week")


def local_time(ts: str | Column, tz: str) -> Column:
    """UTC wall-clock time to the wall-clock time of ``tz``."""
    return col(ts) if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), col(ts))


def local_midnight(day: date, tz: str) -> datetime:
    """UTC moment (naive) at which ``day`` starts in ``tz``; used for scan bounds."""
    start = datetime.combine(day, time.min, tzinfo=ZoneInfo(tz))
    return start.astimezone(ZoneInfo("UTC")).replace(tzinfo=None)


def instant_to_utc(instant: Column) -> Column:
    """Zoned ``timestamp`` to UTC ``timestamp_ntz`` without using the session time zone."""
    seconds = (F.unix_micros(instant).cast("decimal(24,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def utc_to_instant(ts: str | Column) -> Column:
    """UTC ``timestamp_ntz`` to a zoned ``timestamp`` (event-time operators need that type)."""
    ts = col(ts)
    return F.timestamp_micros(minute_number(ts) * 60_000_000 + micros_in_minute(ts))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in seconds with microseconds, as decimal(20,6)."""
    gap = (col(end) - col(start)).cast("interval second")
    return gap.cast("decimal(18,6)")


def pct(num: str | Column, den: str | Column, places: int = 2) -> Column:
    """``100 * num / den`` rounded half up; NULL when ``den`` is 0.

    The quotient goes through a decimal before rounding: rounding a binary double directly
    depends on the engine.
    """
    quotient = F.lit(100.0) * col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))
    return F.round(quotient.cast("decimal(24,6)"), places).cast("double")


def ratio(num: str | Column, den: str | Column, places: int = 4) -> Column:
    quotient = col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))
    return F.round(quotient.cast("decimal(24,8)"), places).cast("double")


def mean(total: str | Column, n: str | Column) -> Column:
    """Unrounded ``total / n``; NULL when ``n`` is 0."""
    return col(total).cast("double") / F.nullif(col(n).cast("double"), F.lit(0.0))


def rounded(value: str | Column, places: int) -> Column:
    """Round a double through a decimal (half up)."""
    return F.round(col(value).cast("decimal(30,10)"), places).cast("double")


def money(value: str | Column) -> Column:
    """Exact decimal amounts leave an operator as doubles, only at the very end."""
    return col(value).cast("double")


def nonempty(c: str | Column) -> Column:
    """NULL for the empty string."""
    return F.nullif(col(c), F.lit(""))


def or_unknown(c: str | Column) -> Column:
    """NULL and '' both become 'unknown'."""
    return F.coalesce(nonempty(c), F.lit("unknown"))


def parse_event_ts(text: str | Column) -> Column:
    """Tracker time text to UTC.

    Accepts ``2025-12-18 12:52:23 AM`` and ISO text with or without an offset; text without an
    offset is UTC. Empty or unreadable text gives NULL (see :func:`unparsed_ts`).
    """
    text = nonempty(text)
    clock = r"(?i)[ap]m$"
    zoned = r"^\d{4}-\d{2}-\d{2}.*:.*(Z|[+-]\d{2}:?\d{2})$"
    plain = r"^\d{4}-\d{2}-\d{2}"
    # A zone is appended so that the pattern yields an instant, whatever the session zone. The
    # form is decided first: a failed parse costs far more than a match.
    pattern = F.lit("yyyy-MM-dd h:mm:ss a Z")
    return (
        F.when(
            text.rlike(clock),
            instant_to_utc(F.try_to_timestamp(F.concat(text, F.lit(" +0000")), pattern)),
        )
        .when(text.rlike(zoned), instant_to_utc(text.try_cast("timestamp")))
        .when(text.rlike(plain), text.try_cast("timestamp_ntz"))
    )


def unparsed_ts(text: str | Column) -> Column:
    """The original text where :func:`parse_event_ts` could not read it, else NULL."""
    return F.when(parse_event_ts(text).isNull(), nonempty(text))
