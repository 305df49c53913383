"""Literal rows through the normalisers, de-duplication, merge, windows and retention."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from convlens.functions import expr as X
from convlens.operators import ingest
from convlens.plans import sync
from convlens.sources import schemas as S
from convlens.sources.tables import expire_table, read_report, read_table, upsert_table, write_report

TIMES = [
    ("2025-12-18 12:52:23 AM", datetime(2025, 12, 18, 0, 52, 23), None),
    ("2025-12-18 03:30:45 PM", datetime(2025, 12, 18, 15, 30, 45), None),
    ("2025-12-18T10:30:00Z", datetime(2025, 12, 18, 10, 30), None),
    ("2025-12-18T10:30:00+00:00", datetime(2025, 12, 18, 10, 30), None),
    ("2025-12-18T10:30:00-08:00", datetime(2025, 12, 18, 18, 30), None),
    ("2025-12-18T10:30:00.25", datetime(2025, 12, 18, 10, 30, 0, 250000), None),
    ("2025-03-09 02:30:00 AM", datetime(2025, 3, 9, 2, 30), None),
    ("2025-12-18", datetime(2025, 12, 18), None),
    ("2025-12-18 13:00:00 PM", None, "2025-12-18 13:00:00 PM"),
    ("", None, None),
    (None, None, None),
    ("not-a-date", None, "not-a-date"),
]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_time_text(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(TIMES)], "i int, t string")
        got = rows.select("i", X.parse_event_ts("t"), X.unparsed_ts("t")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [(r[1], r[2]) for r in got] == [(want, left) for _, want, left in TIMES]


def raw(spark, *rows):
    return spark.createDataFrame(
        [(json.dumps(r), i) for i, r in enumerate(rows)], "value string, ingest_seq bigint"
    )


def test_full_visit(spark):
    full = {key: f"{key}-value" for key, _ in S.VISIT_FIELDS}
    row = ingest.normalize_visits(raw(spark, {**full, "timestamp": "2025-12-18 12:52:23 AM", "extra": 1})).first()
    for key, name in S.VISIT_FIELDS:
        assert row[name] == f"{key}-value"
    assert row["visit_timestamp"] == datetime(2025, 12, 18, 0, 52, 23)
    assert json.loads(row["raw_data"])["extra"] == 1  # unknown keys survive in the raw row


def test_minimal_visit(spark):
    row = ingest.normalize_visits(raw(spark, {"clickId": "v1", "campaignId": "c1"})).first()
    given = {"click_id": "v1", "campaign_id": "c1"}
    for name in S.LIVE_VISITS.fieldNames():
        if name != "raw_data":
            assert row[name] == given.get(name), name


def test_visit_without_id_is_dropped(spark):
    rows = ingest.normalize_visits(raw(spark, {"campaignId": "c1"}, {"clickId": ""}))
    assert [r["click_id"] for r in rows.collect()] == [None, ""]
    assert ingest.dedupe_visits(rows).count() == 0


def test_click(spark):
    row = ingest.normalize_clicks(
        raw(spark, {"clickId": "k1", "timestamp": "2025-12-18T10:30:00Z", "ip": "1.2.3.4"})
    ).first()
    assert (row["click_id"], row["ip"]) == ("k1", "1.2.3.4")
    assert row["click_timestamp"] == datetime(2025, 12, 18, 10, 30)


def test_conversion_amounts(spark):
    rows = ingest.normalize_conversions(
        raw(
            spark,
            {"clickId": "a", "revenue": 2.5, "payout": "2.00", "cost": 0.5, "profit": 1.5},
            {"clickId": "b", "revenue": None, "payout": None, "cost": 0},
        )
    ).orderBy("click_id")
    a, b = rows.collect()
    assert [a[c] for c in S.CONVERSION_MONEY] == [Decimal(x) for x in ("2.5", "2", "0.5", "1.5")]
    assert [b[c] for c in S.CONVERSION_MONEY] == [Decimal(0)] * 4


def test_fallback_keys(spark):
    rows = ingest.normalize_visits_fallback(
        raw(
            spark,
            {"visitId": "", "clickId": "k", "country": "US", "v3": "x", "conversions": 2},
            {"visitId": "v", "clickId": "k", "countryCode": "DE", "country": "US", "isConversion": False},
            {"clickId": "k", "customVariable3": " ", "v3": "x", "isConversion": True, "cost": "1.5"},
        )
    ).orderBy("ingest_seq")
    first, second, third = rows.collect()
    assert (first["visit_id"], first["country_code"], first["custom_var_3"]) == ("k", "US", "x")
    assert (first["is_conversion"], second["is_conversion"], third["is_conversion"]) == (True, False, True)
    assert (second["visit_id"], second["country_code"]) == ("v", "DE")
    assert third["custom_var_3"] == " "  # a blank is a value; only the empty text is not
    assert third["cost"] == Decimal("1.5") and third["is_click"] is False


def test_fallback_conversion_time(spark):
    now = datetime(2025, 1, 1)
    rows = ingest.normalize_conversions_fallback(
        raw(
            spark,
            {"clickId": "a", "timestamp": "2025-01-01T10:00:30Z", "visitTimestamp": "2025-01-01T10:00:00Z"},
            {"clickId": "b", "postbackId": "p", "visitTimestamp": "2025-01-01T10:00:00Z"},
            {"clickId": "c"},
            {"clickId": "d", "visitTimestamp": "junk", "timestamp": "2025-01-01T10:00:30Z"},
        ),
        now,
    ).orderBy("ingest_seq")
    a, b, c, d = rows.collect()
    assert (a["conversion_id"], a["time_to_convert"]) == ("a", timedelta(seconds=30))
    assert (b["conversion_id"], b["time_to_convert"]) == ("p", timedelta(0))
    assert (c["conversion_timestamp"], c["time_to_convert"]) == (now, None)
    assert d["time_to_convert"] is None and d["visit_timestamp"] is None


def test_dedupe_keeps_first(spark):
    rows = raw(spark, {"clickId": "v1", "os": "a"}, {"clickId": "v1", "os": "b"}, {"clickId": "v2"})
    kept = ingest.dedupe_visits(ingest.normalize_visits(rows)).orderBy("click_id").collect()
    assert [(r["click_id"], r["os"]) for r in kept] == [("v1", "a"), ("v2", None)]


def test_dedupe_conversions_by_click_and_time(spark):
    at = {"postbackTimestamp": "2025-12-18T10:30:00Z"}
    rows = raw(spark, {"clickId": "a", **at}, {"clickId": "a", **at}, {"clickId": "a"}, {"clickId": "a"}, at)
    kept = ingest.dedupe_conversions(ingest.normalize_conversions(rows))
    assert kept.count() == 2  # one with the time, one without; no click is dropped


def test_campaign_name_filter(spark):
    rows = spark.createDataFrame(
        [("Brand XY 1",), ("brand xy",), ("XY",), (None,)], "campaign_name string"
    )
    kept = ingest.of_campaign_name(rows, "XY").collect()
    assert [r[0] for r in kept] == ["Brand XY 1", "XY"]
    assert ingest.of_campaign_name(rows, None).count() == 4


def test_tracked_campaigns(spark):
    now = datetime(2025, 5, 10, 15, 30)
    rows = spark.createDataFrame(
        [
            ("c1", "Old", datetime(2025, 5, 9, 0, 0)),
            ("c1", "New", datetime(2025, 5, 10, 1, 0)),
            ("c2", "Late", datetime(2025, 5, 10, 23, 0)),
            ("c3", "Early", datetime(2025, 5, 8, 23, 59)),
        ],
        "campaign_id string, campaign_name string, visit_timestamp timestamp_ntz",
    )
    assert [tuple(r) for r in ingest.tracked_campaigns(rows, now).collect()] == [("c1", "New", 2)]
    assert ingest.tracked_campaigns(rows.limit(0), now).count() == 0


def test_upsert(spark):
    schema = "k string, t timestamp_ntz, a string, b string"
    old = spark.createDataFrame(
        [("x", None, "a1", "b1"), ("y", datetime(2025, 1, 1), "a2", "b2")], schema
    )
    new = spark.createDataFrame(
        [("x", None, "a9"), ("z", None, None)], "k string, t timestamp_ntz, a string"
    )
    merged = ingest.upsert(old, new, ["k", "t"])
    rows = {r["k"]: (r["a"], r["b"]) for r in merged.collect()}
    assert rows == {"x": ("a9", "b1"), "y": ("a2", "b2"), "z": (None, None)}
    again = ingest.upsert(merged, new, ["k", "t"])
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_sync_window_leaves_the_running_hour(spark):
    times = [datetime(2025, 1, 1, h, m) for h, m in [(9, 59), (10, 0), (11, 59), (12, 0), (12, 10)]]
    rows = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    kept = ingest.sync_window(rows, "t", datetime(2025, 1, 1, 10, 30), datetime(2025, 1, 1, 12, 20))
    assert [r[0] for r in kept.orderBy("t").collect()] == times[1:3]


def test_backfill_chunks():
    now = datetime(2025, 1, 31, 12)
    chunks = ingest.backfill_chunks(now, 10)
    assert chunks == [
        (now - timedelta(days=7), now),
        (now - timedelta(days=10), now - timedelta(days=7)),
    ]


def test_retention(spark):
    as_of = datetime(2025, 4, 1)
    cutoff = as_of - timedelta(days=90)
    rows = spark.createDataFrame(
        [(cutoff,), (cutoff - timedelta(microseconds=1),), (None,)], "t timestamp_ntz"
    )
    assert ingest.retention_keep(rows, "t", as_of).count() == 2
    counts = ingest.retention_cleanup({"x": (rows, "t")}, as_of).first()
    assert (counts["deleted"], counts["kept"]) == (1, 2)


def stored(spark, path):
    table = read_table(spark, path, S.LIVE_VISITS)
    return {r["click_id"]: r for r in table.collect()}


def test_stored_table_merge_and_expiry(spark, tmp_path):
    path = f"{tmp_path}/live_visits"

    def merge(*rows):
        batch = ingest.dedupe_visits(ingest.normalize_visits(raw(spark, *rows)))
        upsert_table(spark, batch, path, S.LIVE_VISITS, ["click_id"], "visit_timestamp")

    merge(
        {"clickId": "a", "timestamp": "2025-01-01T10:00:00Z", "os": "1"},
        {"clickId": "b", "timestamp": "2025-01-02T10:00:00Z", "os": "1"},
        {"clickId": "n", "os": "1"},
    )
    # "a" gets a corrected time on another day, "b" stays untouched, "c" is new.
    merge(
        {"clickId": "a", "timestamp": "2025-01-03T10:00:00Z", "os": "2"},
        {"clickId": "c", "timestamp": "2025-01-03T11:00:00Z", "os": "2"},
        {"clickId": "n", "os": "2"},
    )
    rows = stored(spark, path)
    assert {k: r["os"] for k, r in rows.items()} == {"a": "2", "b": "1", "c": "2", "n": "2"}
    assert read_table(spark, path, S.LIVE_VISITS).count() == 4
    assert rows["a"]["visit_timestamp"] == datetime(2025, 1, 3, 10)

    gone = expire_table(
        spark, path, S.LIVE_VISITS, "visit_timestamp", datetime(2025, 1, 3, 10, 30), days=0
    )
    assert gone == 2
    assert set(stored(spark, path)) == {"c", "n"}


def test_sync_cycle(spark, tmp_path):
    visits = [{"clickId": f"v{i}", "timestamp": f"2025-01-0{1 + i % 3}T10:00:00Z"} for i in range(9)]
    conversions = [
        {"clickId": "v1", "campaignName": "Brand XY", "postbackTimestamp": "2025-01-03T09:10:00Z", "revenue": 2},
        {"clickId": "v2", "campaignName": "Other", "postbackTimestamp": "2025-01-03T09:20:00Z"},
        {"clickId": "v3", "campaignName": "XY two", "postbackTimestamp": "2025-01-03T10:30:00Z"},
    ]
    folders = {}
    for feed, rows in {"live_visits": visits + visits[:2], "conversions": conversions}.items():
        folders[feed] = f"{tmp_path}/raw/{feed}"
        raw(spark, *rows).select("value").write.text(folders[feed])
    now = datetime(2025, 1, 3, 10, 45)
    for gone in (3, 0):  # a repeated cycle changes nothing, and does not read again what has expired
        expired = sync.run_cycle(
            spark, folders, f"{tmp_path}/tables", now, retention_days=2, campaign_filter="XY"
        )
        assert expired["live_visits"] == gone
        kept = read_table(spark, f"{tmp_path}/tables/conversions", S.CONVERSIONS)
        assert [r["click_id"] for r in kept.collect()] == ["v1"]  # filter, and the running hour
        assert read_table(spark, f"{tmp_path}/tables/live_visits", S.LIVE_VISITS).count() == 6
    assert sync.last_sync(spark, f"{tmp_path}/tables", "conversions", now) == now
    failed = sync.run_backfill(
        spark, folders["live_visits"], f"{tmp_path}/back", "live_visits", now, days=10
    )
    assert failed == []
    # The day-3 visits are in the running hour.
    assert read_table(spark, f"{tmp_path}/back/live_visits", S.LIVE_VISITS).count() == 6


def test_first_is_decided_by_the_files_not_their_sizes(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    row = {"clickId": "v", "timestamp": "2025-01-01T10:00:00Z"}
    (folder / "0001.json").write_text(json.dumps({**row, "os": "first"}) + "\n")
    later = [{**row, "os": "second"}] + [{**row, "clickId": f"x{i}", "os": "x" * 200} for i in range(2000)]
    (folder / "0002.json").write_text("\n".join(map(json.dumps, later)))
    assert sync.load_feed(spark, str(folder), f"{tmp_path}/t", "live_visits") == 2001
    assert stored(spark, f"{tmp_path}/t/live_visits")["v"]["os"] == "first"


def test_rows_that_cannot_be_stored_are_kept(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    lines = [
        json.dumps({"clickId": "a", "postbackTimestamp": "2025-01-03T09:10:00Z", "revenue": "x"}),
        json.dumps({"clickId": "b", "postbackTimestamp": "soon"}),
        json.dumps({"clickId": "c"}),
        "{broken",
    ]
    (folder / "1.json").write_text("\n".join(lines))
    now = datetime(2025, 1, 3, 12)
    for _ in range(2):
        sync.run_cycle(spark, {"conversions": str(folder)}, f"{tmp_path}/t", now)
        rejected = spark.read.parquet(f"{tmp_path}/t/rejected").collect()
        assert sorted((r["feed"], r["reason"], r["raw_data"]) for r in rejected) == [
            ("conversions", "no id or broken row", "{broken"),
            ("conversions", "unreadable time", lines[1]),
        ]
    (row,) = read_table(spark, f"{tmp_path}/t/conversions", S.CONVERSIONS).collect()
    assert (row["click_id"], row["revenue"], row["revenue_raw"]) == ("a", 0, "x")
    state = sync.read_state(spark, f"{tmp_path}/t").collect()
    assert [(r["sync_type"], r["records_synced"]) for r in state] == [("conversions", 1)]


def test_rollup_merge_repeats_without_duplicates(spark, tmp_path):
    rows = spark.createDataFrame(
        [
            ("c1", "Old", None, "m", datetime(2025, 1, 1, 10, 1), True, False),
            ("c1", "New", None, "m", datetime(2025, 1, 1, 10, 2), False, False),
        ],
        "campaign_id string, campaign_name string, country_code string, device string, "
        "visit_timestamp timestamp_ntz, is_click boolean, is_conversion boolean",
    ).withColumns({c: F.lit(Decimal("1.5")).cast(X.MONEY) for c in ("revenue", "cost", "profit")})
    for _ in range(2):
        sync.merge_rollup(spark, rows, str(tmp_path), datetime(2025, 1, 1, 11))
    (row,) = read_table(spark, f"{tmp_path}/hourly_stats", S.HOURLY_STATS).collect()
    assert (row["campaign_name"], row["visits"], row["clicks"]) == ("New", 2, 1)
    assert (row["ctr"], row["cr"], row["epc"]) == (50.0, 0.0, 3.0)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_report_files(spark, tmp_path, fmt):
    write_report(spark.range(3), f"{tmp_path}/{fmt}", fmt)
    assert spark.read.format(fmt).option("header", True).load(f"{tmp_path}/{fmt}").count() == 3


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_reports_come_back_as_written(spark, tmp_path, fmt):
    rows = [("a", 3, 1.5, datetime(2025, 1, 1, 10, 0, 0, 123456), ""), ("b", 1, None, None, "x, \"y\""), ("a", 1, -2.0, datetime(2025, 1, 2), None)]
    report = spark.createDataFrame(rows, "name string, n int, v double, t timestamp_ntz, note string")
    write_report(report, f"{tmp_path}/{fmt}", fmt, by=["name"], order=["n"])
    assert sorted(p.name for p in (tmp_path / fmt).glob("name=*")) == ["name=a", "name=b"]
    back = read_report(spark, f"{tmp_path}/{fmt}", report.schema, fmt)
    assert back.schema.simpleString() == report.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, report.collect()))
    assert [r["n"] for r in back.filter("name = 'a'").collect()] == [1, 3]


def test_an_unknown_report_format_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown report format"):
        write_report(spark.range(3), str(tmp_path / "r"), "xlsx")
    with pytest.raises(ValueError, match="unknown report format"):
        read_report(spark, str(tmp_path / "r"), spark.range(3).schema, "xlsx")
