"""Declared schemas of the raw tracker rows and of the stored tables.

Raw rows are JSON objects with camelCase keys; stored tables use snake_case columns. The pairs
below are fixed values of the tracker's format, in its order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw key -> stored column. Time keys are listed apart because they are parsed.
VISIT_FIELDS = [
    ("clickId", "click_id"),
    ("externalId", "external_id"),
    ("campaignId", "campaign_id"),
    ("campaignName", "campaign_name"),
    ("trafficSourceId", "traffic_source_id"),
    ("trafficSourceName", "traffic_source_name"),
    ("offerId", "offer_id"),
    ("offerName", "offer_name"),
    ("affiliateNetworkId", "affiliate_network_id"),
    ("affiliateNetworkName", "affiliate_network_name"),
    ("landerId", "lander_id"),
    ("landerName", "lander_name"),
    ("countryCode", "country_code"),
    ("countryName", "country_name"),
    ("region", "region"),
    ("city", "city"),
    ("device", "device"),
    ("deviceName", "device_name"),
    ("brand", "brand"),
    ("model", "model"),
    ("os", "os"),
    ("osVersion", "os_version"),
    ("browser", "browser"),
    ("browserVersion", "browser_version"),
    ("connectionType", "connection_type"),
    ("isp", "isp"),
    ("mobileCarrier", "mobile_carrier"),
    ("ip", "ip"),
    *[(f"customVariable{i}", f"custom_var_{i}") for i in range(1, 11)],
    ("referrer", "referrer"),
    ("userAgent", "user_agent"),
]
VISIT_TIMES = [("timestamp", "visit_timestamp")]

CLICK_FIELDS = [
    ("clickId", "click_id"),
    ("externalId", "external_id"),
    ("campaignId", "campaign_id"),
    ("campaignName", "campaign_name"),
    ("offerId", "offer_id"),
    ("offerName", "offer_name"),
    ("landerId", "lander_id"),
    ("landerName", "lander_name"),
    ("countryCode", "country_code"),
    ("countryName", "country_name"),
    ("device", "device"),
    ("os", "os"),
    ("browser", "browser"),
    ("ip", "ip"),
]
CLICK_TIMES = [("timestamp", "click_timestamp")]

CONVERSION_FIELDS = [
    ("clickId", "click_id"),
    ("externalId", "external_id"),
    ("transactionId", "transaction_id"),
    ("campaignId", "campaign_id"),
    ("campaignName", "campaign_name"),
    ("offerId", "offer_id"),
    ("offerName", "offer_name"),
    ("affiliateNetworkId", "affiliate_network_id"),
    ("affiliateNetworkName", "affiliate_network_name"),
    ("countryCode", "country_code"),
    ("countryName", "country_name"),
    ("device", "device"),
    ("os", "os"),
    ("browser", "browser"),
    ("connectionType", "connection_type"),
    ("isp", "isp"),
    ("ip", "ip"),
    *[(f"customVariable{i}", f"custom_var_{i}") for i in range(1, 6)],
]
CONVERSION_TIMES = [
    ("postbackTimestamp", "postback_timestamp"),
    ("visitTimestamp", "visit_timestamp"),
]
CONVERSION_MONEY = ["revenue", "payout", "cost", "profit"]

# Alternate keys of the first-generation feed, tried left to right.
VISIT_ALTERNATES = {
    "visit_id": ["visitId", "clickId"],
    "click_id": ["clickId"],
    "campaign_id": ["campaignId"],
    "campaign_name": ["campaignName"],
    "offer_id": ["offerId"],
    "offer_name": ["offerName"],
    "lander_id": ["landerId"],
    "lander_name": ["landerName"],
    "traffic_source_id": ["trafficSourceId"],
    "traffic_source_name": ["trafficSourceName"],
    "country_code": ["countryCode", "country"],
    "country_name": ["countryName"],
    "region": ["region"],
    "city": ["city"],
    "device_type": ["deviceType"],
    "os": ["os"],
    "os_version": ["osVersion"],
    "browser": ["browser"],
    "browser_version": ["browserVersion"],
    "isp": ["isp"],
    "connection_type": ["connectionType"],
    "ip": ["ip"],
    **{f"custom_var_{i}": [f"customVariable{i}", f"v{i}"] for i in range(1, 11)},
    "external_id": ["externalId"],
    "sub_id": ["subId"],
}
VISIT_ALTERNATE_TIMES = {
    "visit_timestamp": ["visitTimestamp", "timestamp"],
    "click_timestamp": ["clickTimestamp"],
    "conversion_timestamp": ["conversionTimestamp"],
}
CONVERSION_ALTERNATES = {
    "visit_id": ["visitId"],
    "click_id": ["clickId"],
    "conversion_id": ["conversionId", "postbackId", "clickId"],
    "campaign_id": ["campaignId"],
    "campaign_name": ["campaignName"],
    "offer_id": ["offerId"],
    "offer_name": ["offerName"],
    "country_code": ["countryCode", "country"],
    "transaction_id": ["transactionId", "txid"],
    "conversion_type": ["conversionType"],
}
CONVERSION_ALTERNATE_TIMES = [
    "conversionTimestamp",
    "timestamp",
    "postbackTimestamp",
    "visitTimestamp",
]


def _strings(names) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in dict.fromkeys(names)]


def raw_schema(fields, times=(), money=()) -> T.StructType:
    """Schema of a raw JSON row, all keys optional.

    Amounts are read as text too: a feed may quote them, and a typed key would lose the row.
    """
    names = [raw for raw, _ in fields] + [raw for raw, _ in times]
    return T.StructType(_strings([*names, *money]))


RAW_VISIT = raw_schema(VISIT_FIELDS, VISIT_TIMES)
RAW_CLICK = raw_schema(CLICK_FIELDS, CLICK_TIMES)
RAW_CONVERSION = raw_schema(CONVERSION_FIELDS, CONVERSION_TIMES, CONVERSION_MONEY)
RAW_VISIT_V1 = T.StructType(
    _strings(
        [key for keys in VISIT_ALTERNATES.values() for key in keys]
        + [key for keys in VISIT_ALTERNATE_TIMES.values() for key in keys]
    )
    + _strings(["cost", "revenue", "profit", "isClick", "isConversion", "conversions"])
)
RAW_CONVERSION_V1 = T.StructType(
    _strings(
        [key for keys in CONVERSION_ALTERNATES.values() for key in keys]
        + CONVERSION_ALTERNATE_TIMES
    )
    + _strings(["revenue", "payout"])
)

MONEY = T.DecimalType(18, 6)
NTZ = T.TimestampNTZType()


def stored_schema(fields, times, money=()) -> T.StructType:
    """Schema of a stored table: text, UTC times, exact money, unread time and money text, raw row."""
    return T.StructType(
        _strings([name for _, name in fields])
        + [T.StructField(name, NTZ) for _, name in times]
        + [T.StructField(name, MONEY) for name in money]
        + _strings([*(f"{name}_raw" for _, name in times), *(f"{name}_raw" for name in money), "raw_data"])
    )


#: First-generation visits, which carry their own outcome.
VISITS = T.StructType(
    _strings(VISIT_ALTERNATES)
    + [T.StructField(name, NTZ) for name in VISIT_ALTERNATE_TIMES]
    + [T.StructField(name, MONEY) for name in ("cost", "revenue", "profit")]
    + [T.StructField(name, T.BooleanType()) for name in ("is_click", "is_conversion")]
    + _strings([f"{name}_raw" for name in (*VISIT_ALTERNATE_TIMES, "cost", "revenue", "profit")])
    + _strings(["raw_data"])
)
LIVE_VISITS = stored_schema(VISIT_FIELDS, VISIT_TIMES)
LIVE_CLICKS = stored_schema(CLICK_FIELDS, CLICK_TIMES)
CONVERSIONS = stored_schema(CONVERSION_FIELDS, CONVERSION_TIMES, CONVERSION_MONEY)

HOURLY_STATS = T.StructType(
    [T.StructField("hour_timestamp", NTZ)]
    + _strings(["campaign_id", "campaign_name", "country_code", "device"])
    + [T.StructField(name, T.LongType()) for name in ("visits", "clicks", "conversions")]
    + [T.StructField(name, T.DecimalType(28, 6)) for name in ("revenue", "cost", "profit")]
    + [T.StructField(name, T.DoubleType()) for name in ("ctr", "cr", "epc")]
)

SYNC_STATE = T.StructType(
    [
        T.StructField("sync_type", T.StringType()),
        T.StructField("last_sync_timestamp", NTZ),
        T.StructField("records_synced", T.LongType()),
    ]
)
