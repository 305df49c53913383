"""The tracker tables, derived from the ``events`` table by column expressions.

``user_id`` and ``props.k`` stand in for the attributes a tracker would deliver; a purchase or
sign-up is a conversion and is attributed to the user's latest earlier view or click. Everything
is one scan of ``events`` plus, only where the attributed click is needed, the as-of operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.functions.expr import MONEY
from convlens.operators.asof import asof_last_within

# Fixed values of the derived data, as Spark SQL over ``user_id``, ``k`` and ``value``. ``get``
# gives NULL past the end of its array, which is the eighth country.
ATTRIBUTE_SQL = {
    "campaign_id": "concat('c', user_id % 8)",
    "campaign_name": "concat('Campaign ', user_id % 8)",
    "offer_id": "concat('o', user_id % 5)",
    "offer_name": "concat('Offer ', user_id % 5)",
    "traffic_source_id": "concat('t', user_id % 3)",
    "traffic_source_name": "concat('Source ', user_id % 3)",
    "affiliate_network_id": "concat('n', user_id % 2)",
    "affiliate_network_name": "concat('Network ', user_id % 2)",
    "lander_id": "concat('l', k % 4)",
    "lander_name": "concat('Lander ', k % 4)",
    "country_code": "get(array('US', 'GB', 'DE', 'FR', 'BR', 'IN', 'JP'), k % 8)",
    "device": "get(array('mobile', 'desktop', 'tablet'), k % 3)",
    "os": "get(array('iOS', 'Android', 'Windows', 'macOS'), k % 4)",
    "browser": "get(array('Chrome', 'Safari', 'Firefox', 'Edge', 'Edge'), k % 5)",
    "isp": "if((user_id * 7 + k) % 12 = 0, '', concat('ISP ', (user_id * 7 + k) % 12))",
    "connection_type": "get(array('wifi', 'cellular'), k % 2)",
    "custom_var_3": "if(user_id % 6 = 5, NULL, concat('v', user_id % 6))",
}
ATTRIBUTES = list(ATTRIBUTE_SQL)
DEVICE_FACTOR = "get(array(1.5BD, 1.0BD, 0.3BD), k % 3)"
MONEY_KEYS = ("revenue", "payout", "cost", "profit")


# The columns of the events file, declared so that no reader opens it to ask.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_attributes(raw_events(spark, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a stream of files."""
    files = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events*.parquet")
    return with_attributes(files.parquet(sf_dir))


def keyed(frame: DataFrame) -> DataFrame:
    """Events with ``props.k``: the few columns that all others are computed from."""
    k = "cast(get_json_object(props, '$.k') as int) AS k"
    return frame.selectExpr("event_id", "ts", "user_id", "event_type", "value", k)


def widened(keyed_events: DataFrame) -> DataFrame:
    """Events of :func:`keyed`, and what else they have, with the attributes of their user and ``k``."""
    return keyed_events.selectExpr("*", "cast(value as decimal(12,2)) AS amount").selectExpr(
        "*", *[f"{sql} AS {name}" for name, sql in ATTRIBUTE_SQL.items()]
    )


def with_attributes(frame: DataFrame) -> DataFrame:
    """Events with the tracker attributes of their user and ``props.k``."""
    return widened(keyed(frame))


def visits_of(events: DataFrame) -> DataFrame:
    """One wide row per visit, with its click and conversion flags and its money."""
    return events.selectExpr(
        "cast(event_id as string) AS visit_id",
        "cast(event_id as string) AS click_id",
        "ts AS visit_timestamp",
        "event_type IN ('click', 'signup', 'purchase') AS is_click",
        "event_type = 'purchase' AS is_conversion",
        f"cast(if(event_type = 'purchase', value, 0D) as {MONEY}) AS revenue",
        f"cast(amount * 0.1BD as {MONEY}) AS cost",
        *ATTRIBUTES,
    ).withColumn("profit", (F.col("revenue") - F.col("cost")).cast(MONEY))


def live_visits_of(events: DataFrame) -> DataFrame:
    return events.filter("event_type IN ('view', 'click')").selectExpr(
        "cast(event_id as string) AS click_id", "ts AS visit_timestamp", *ATTRIBUTES
    )


def live_clicks_of(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'click'").selectExpr(
        "cast(event_id as string) AS click_id", "ts AS click_timestamp", *ATTRIBUTES
    )


def conversion_columns(events: DataFrame) -> DataFrame:
    """Events with the columns that a conversion has, beside the touch they are attributed to."""
    return events.selectExpr(
        "touch_timestamp",
        "touch_id",
        "cast(event_id as string) AS transaction_id",
        "ts AS postback_timestamp",
        "if(event_type = 'purchase', 'sale', 'lead') AS conversion_type",
        f"cast(amount * {DEVICE_FACTOR} as {MONEY}) AS revenue",
        f"cast(amount * 0.6BD as {MONEY}) AS payout",
        f"cast(amount * 0.1BD as {MONEY}) AS cost",
        *ATTRIBUTES,
    ).withColumn("profit", (F.col("revenue") - F.col("cost")).cast(MONEY))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_of(events(spark, sf_dir))


def live_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_visits_of(events(spark, sf_dir))


def live_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_clicks_of(events(spark, sf_dir))


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversions carrying the click they came from; ``orphan-…`` where there is none.

    The narrow events go through the as-of join, and their answers get the columns of a conversion.
    """
    kind = F.col("event_type")
    attributed = asof_last_within(
        keyed(raw_events(spark, sf_dir)),
        by="user_id",
        at="ts",
        asks=kind.isin("purchase", "signup"),
        seen=kind.isin("view", "click"),
        other_at="touch_timestamp",
        value="touch_id",
        id_of_seen="event_id",
    )
    return conversion_columns(widened(attributed)).selectExpr(
        "coalesce(cast(touch_id as string), concat('orphan-', transaction_id)) AS click_id",
        "transaction_id",
        "conversion_type",
        "postback_timestamp",
        "touch_timestamp AS visit_timestamp",
        *MONEY_KEYS,
        *ATTRIBUTES,
    )


def _raw_time(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def raw_rows(frame: DataFrame, fields: list[tuple[str, str]], times: list[tuple[str, str]]) -> DataFrame:
    """Stored rows back as raw JSON text in ``value``, numbered by ``ingest_seq``."""
    names = dict((column, key) for key, column in fields)
    present = [F.col(c).alias(names[c]) for c in frame.columns if c in names]
    clock = [_raw_time(column).alias(key) for key, column in times]
    # Amounts that are text already stay as they are written.
    amounts = [
        (F.col(c) if kind == "string" else F.col(c).cast("double")).alias(c)
        for c, kind in frame.dtypes
        if c in MONEY_KEYS
    ]
    return frame.select(F.to_json(F.struct(*present, *clock, *amounts)).alias("value"), "ingest_seq")
