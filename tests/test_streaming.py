"""Streams against the batch answer, over several files and restarts."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest

from convlens.operators import anomaly, joins, views
from convlens.operators.ingest import normalize_visits
from convlens.plans import sync
from convlens.sources import derive, schemas as S
from convlens.sources.tables import read_table
from convlens.streaming import jobs


def lines(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def once(writer, folder):
    jobs.start(writer, f"{folder}/checkpoint", once=True).awaitTermination()


def split_events(spark, sf, folder, files=4):
    """The events in time order as several files, read one per micro-batch."""
    rows = spark.read.parquet(f"{sf}/events.parquet")
    for day in range(files):
        low, high = datetime(2024, 1, 1) + timedelta(days=8 * day), datetime(2024, 1, 9) + timedelta(days=8 * day)
        rows.filter(rows.ts.between(low, high - timedelta(microseconds=1))).coalesce(1).write.mode(
            "append"
        ).parquet(str(folder))
    stream = spark.readStream.schema(derive.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
    return derive.with_attributes(stream.parquet(str(folder)))


def test_ingest_merges_files_and_restarts(spark, tmp_path):
    raw = tmp_path / "raw"
    lines(raw, "1.json", [
        {"clickId": "v1", "os": "first", "timestamp": "2025-01-01T10:00:00Z"},
        {"clickId": "v1", "os": "second", "timestamp": "2025-01-01T10:00:00Z"},
        {"clickId": "v2", "os": "first", "timestamp": "2025-01-02 01:00:00 PM"},
        {"campaignId": "no id"},
    ])

    def run():
        once(jobs.stream_ingest(jobs.raw_stream(spark, str(raw)), str(tmp_path), "live_visits"), tmp_path)
        table = read_table(spark, f"{tmp_path}/live_visits", S.LIVE_VISITS)
        return {r["click_id"]: r["os"] for r in table.collect()}, table.count()

    # First within a batch, last across batches.
    assert run() == ({"v1": "first", "v2": "first"}, 2)
    assert run() == ({"v1": "first", "v2": "first"}, 2)
    lines(raw, "2.json", [{"clickId": "v2", "os": "later", "timestamp": "2025-01-02T13:00:00Z"}])
    assert run() == ({"v1": "first", "v2": "later"}, 2)


def test_hourly_rollup_over_batches(spark, sf, tmp_path):
    stream = split_events(spark, sf, tmp_path / "events")
    once(jobs.rollup_writer(jobs.stream_hourly_rollup(derive.visits_of(stream)), str(tmp_path)), tmp_path)
    got = jobs.stored_rollup(spark, str(tmp_path))
    want = views.hourly_rollup(derive.visits(spark, sf), datetime(2024, 1, 1))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_realtime_counts_over_batches(spark, sf, tmp_path):
    as_of = datetime(2024, 1, 30, 22)
    stream = split_events(spark, sf, tmp_path / "events")
    once(jobs.recent_counts_writer(jobs.stream_recent_counts(derive.visits_of(stream)), str(tmp_path)), tmp_path)
    counts = jobs.recent_counts(spark, str(tmp_path))
    got = jobs.realtime_cr_of_counts(counts, as_of, min_visits=0)
    want = views.realtime_cr(derive.visits(spark, sf), as_of, min_visits=0)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_step_ends_are_inclusive(spark, tmp_path):
    rows = [("c", "US", datetime(2025, 1, 1, 10), False), ("c", "US", datetime(2025, 1, 1, 10, 0, 0, 1), True)]
    frame = spark.createDataFrame(
        rows, "campaign_name string, country_code string, visit_timestamp timestamp_ntz, is_conversion boolean"
    )
    frame.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    once(jobs.recent_counts_writer(jobs.stream_recent_counts(stream), str(tmp_path)), tmp_path)
    got = jobs.recent_counts(spark, str(tmp_path)).orderBy("until").collect()
    assert [(r["until"], r["visits"]) for r in got] == [
        (datetime(2025, 1, 1, 10), 1),
        (datetime(2025, 1, 1, 10, 5), 1),
    ]


def test_dedupe_across_batches(spark, tmp_path):
    raw = tmp_path / "raw"
    for i in range(3):  # the same ids in every file, and one id with very many copies
        rows = [{"clickId": f"v{j}", "timestamp": "2025-01-01T10:00:00Z"} for j in range(5)]
        rows += [{"clickId": "hot", "timestamp": "2025-01-01T10:30:00Z"}] * 500
        lines(raw, f"{i}.json", rows)
    stream = normalize_visits(jobs.raw_stream(spark, str(raw), files_per_batch=1))
    unique = jobs.stream_dedupe(stream, "visit_timestamp")
    once(unique.writeStream.format("parquet").option("path", f"{tmp_path}/out"), tmp_path)
    got = [r["click_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == ["hot", "v0", "v1", "v2", "v3", "v4"]


@pytest.mark.parametrize("files", [1, 5])
def test_dedupe_state_is_one_entry_per_id(spark, tmp_path, files):
    """Whatever the batches; a copy that is too late does not hide one that is on time, and ids come back once forgotten."""
    start = datetime(2025, 1, 1)
    rows = [(f"v{i % 7}" if i % 3 else "hot", start + timedelta(minutes=i), i) for i in range(400)]
    rows += [("", start, -1), (None, start, -2)]
    frame = spark.createDataFrame(rows, "click_id string, visit_timestamp timestamp_ntz, n int")
    frame.repartitionByRange(files, "visit_timestamp", "n").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    unique = jobs.stream_dedupe(stream, "visit_timestamp", lateness="2 days")
    query = jobs.start(unique.writeStream.format("parquet").option("path", f"{tmp_path}/out"), f"{tmp_path}/c", once=True)
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r["click_id"] for r in got) == ["hot", *(f"v{i}" for i in range(7))]
    states = query.lastProgress["stateOperators"]
    assert [s["numRowsTotal"] for s in states] == [8]


def test_thinning_keeps_a_row_on_time(spark):
    late, now = datetime(2025, 1, 1), datetime(2025, 1, 9)
    rows = [("a", late, 1), ("a", now, 2), ("a", datetime(2025, 1, 5), 3), ("b", now, 4), ("c", None, 5), ("a", now, 6)]
    frame = spark.createDataFrame(rows, "k string, t timestamp_ntz, n int").coalesce(1)
    got = frame.mapInArrow(jobs._thinned("k", "t"), "k string, t timestamp_ntz, n int").collect()
    assert sorted(r["n"] for r in got) == [1, 2, 4, 5]


@pytest.mark.parametrize("every", [1, 2, 99])
def test_totals_are_kept_by_delta(spark, tmp_path, every):
    """A batch writes its own rows; the answer is the same whenever deltas are merged, and after a repeated merge."""
    keys, path = ["until", "campaign_name", "country_code"], f"{tmp_path}/recent_counts"
    rows = [(datetime(2025, 1, 1, 10, i % 50, 1), f"c{i % 3}", None if i % 2 else "US", i % 4 == 0) for i in range(200)]
    frame = spark.createDataFrame(rows, "visit_timestamp timestamp_ntz, campaign_name string, country_code string, is_conversion boolean")
    frame.repartition(5).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    once(jobs.recent_counts_writer(jobs.stream_recent_counts(stream), str(tmp_path), compact_every=every), tmp_path)
    want = {}
    for t, c, country, won in rows:
        until = t.replace(minute=t.minute // 5 * 5, second=0) + timedelta(minutes=5)
        n, m = want.get((until, c, country), (0, 0))
        want[until, c, country] = (n + 1, m + won)
    read = lambda: {(r[0], r[1], r[2]): (r[3], r[4]) for r in jobs.recent_counts(spark, str(tmp_path)).collect()}
    assert read() == want
    assert (tmp_path / "recent_counts").exists() == (every < 99)
    for _ in range(2):
        jobs.compact(spark, path, jobs.RECENT_COUNTS, keys, "until")
        assert read() == want
    assert read_table(spark, path, jobs.RECENT_COUNTS).count() == len(want)


@pytest.mark.parametrize("every", [1, 2, 99])
def test_ingest_by_delta(spark, tmp_path, every):
    """Ids that come again in later files; the newest row counts whenever deltas are merged, and the rollup follows."""
    raw, path, want = tmp_path / "raw", tmp_path / "visits", {}
    for number in range(3):
        rows = [
            {"visitId": f"v{i}", "deviceType": f"{number}", "visitTimestamp": f"2025-01-0{number + 1}T{i:02}:10:00Z", "campaignId": "c"}
            for i in range(number, 10, number + 1)
        ]
        lines(raw, f"{number}.json", rows)
        os.utime(raw / f"{number}.json", (1_700_000_000 + number,) * 2)
        want |= {r["visitId"]: (r["deviceType"], r["visitTimestamp"][:19]) for r in rows}
    arriving = jobs.raw_stream(spark, str(raw), files_per_batch=1)
    once(jobs.stream_ingest(arriving, str(tmp_path), "visits", compact_every=every), tmp_path)
    slim = lambda frame: {r["visit_id"]: (r["device_type"], r["visit_timestamp"].isoformat()) for r in frame.collect()}
    assert slim(jobs.stored_feed(spark, str(tmp_path), "visits")) == want
    left = {1: 0, 2: 1, 99: 3}[every]
    assert len(list((tmp_path / "visits_deltas").glob("batch=*"))) == left
    assert path.exists() == (every < 99)  # without a merge no day folder is written
    for _ in range(2):
        jobs.compact_feed(spark, str(tmp_path), "visits")
        assert slim(read_table(spark, str(path), S.VISITS)) == want
    sync.refresh_rollup(spark, str(tmp_path))
    visits = read_table(spark, str(path), S.VISITS).withColumnRenamed("device_type", "device")
    whole = views.hourly_rollup(visits, datetime(2024, 1, 1))
    kept = read_table(spark, f"{tmp_path}/hourly_stats", S.HOURLY_STATS).select(*whole.columns)
    assert sorted(map(str, kept.collect())) == sorted(map(str, whole.collect()))


def test_a_lost_compaction_brings_no_old_rows_back(spark, tmp_path, monkeypatch):
    """A run that ends while it deletes deltas; batch 10 is newer than batch 9."""
    path, keys = f"{tmp_path}/recent_counts", jobs.RECENT_KEYS
    for number in (8, 9, 10, 11):
        rows = [(datetime(2025, 1, 1), "every", None, number, 0), (datetime(2025, 1, 1), f"c{number}", "US", 1, 0)]
        jobs.keep_delta(spark.createDataFrame(rows, jobs.RECENT_COUNTS), number, path, jobs.RECENT_COUNTS)
    deleted, delete = [], jobs.delete_path

    def failing(spark, folder):
        if len(deleted) == 2:
            raise RuntimeError("lost")
        deleted.append(folder)
        delete(spark, folder)

    monkeypatch.setattr(jobs, "delete_path", failing)
    with pytest.raises(RuntimeError):
        jobs.compact(spark, path, jobs.RECENT_COUNTS, keys, "until")
    want = {("every", 11), *((f"c{n}", 1) for n in (8, 9, 10, 11))}
    read = lambda: {(r["campaign_name"], r["visits"]) for r in jobs.recent_counts(spark, str(tmp_path)).collect()}
    assert read() == want
    monkeypatch.setattr(jobs, "delete_path", delete)
    jobs.compact(spark, path, jobs.RECENT_COUNTS, keys, "until")
    assert read() == want


def test_joined_streams(spark, tmp_path):
    start = datetime(2025, 1, 1)
    live = [(f"k{i}", start + timedelta(days=i)) for i in range(8)]
    posted = [("k0", 1), ("k0", 2), ("k1", 30), ("k7", 1), ("gone", 1)]
    visits = spark.createDataFrame(live, "click_id string, visit_timestamp timestamp_ntz")
    conversions = spark.createDataFrame(
        [(k, dict(live).get(k, start + timedelta(days=7)) + timedelta(hours=h), 1.0, 1.0, f"{k}-{h}") for k, h in posted],
        "click_id string, postback_timestamp timestamp_ntz, revenue double, payout double, transaction_id string",
    )
    visits.write.parquet(f"{tmp_path}/v")
    conversions.write.parquet(f"{tmp_path}/c")
    joined = jobs.stream_visit_conversions(
        spark.readStream.schema(visits.schema).parquet(f"{tmp_path}/v"),
        spark.readStream.schema(conversions.schema).parquet(f"{tmp_path}/c"),
        within="1 day",
        lateness="1 hour",
    )
    once(joined.writeStream.format("parquet").option("path", f"{tmp_path}/out"), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    converted = sorted(r["transaction_id"] for r in got if r["converted"])
    assert converted == ["k0-1", "k0-2", "k7-1"]  # k1's came after its day
    # Unconverted visits appear once their day has passed the watermark, and only once.
    waiting = sorted(r["click_id"] for r in got if not r["converted"])
    assert waiting == ["k1", "k2", "k3", "k4", "k5"]
    want = joins.flag_converted(visits, conversions.filter("click_id != 'k1'")).filter("converted")
    assert {r["click_id"] for r in want.collect()} == {"k0", "k7"}


@pytest.mark.parametrize("files", [1, 3, 20])
def test_alerts_do_not_depend_on_the_batches(spark, sf, tmp_path, files):
    settings = {"min_baseline": 2, "hours": 24, "min_current": 1, "z_threshold": 0.1, "ratio": 0.9}
    as_of = datetime(2024, 1, 30, 22)
    rows = spark.read.parquet(f"{sf}/events.parquet")
    rows.repartitionByRange(files, "ts").write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(derive.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
    visits = derive.visits_of(derive.with_attributes(stream.parquet(str(tmp_path / "events"))))
    counts = jobs.stream_alert_counts(visits, lateness="60 days")
    once(jobs.alert_counts_writer(counts, str(tmp_path)), tmp_path)
    got = jobs.stored_alerts(spark, str(tmp_path), as_of, **settings).collect()
    whole = anomaly.check_alerts(derive.visits(spark, sf), as_of, limit=None, **settings).collect()
    assert len(whole) > 5
    assert sorted(map(str, got)) == sorted(map(str, whole))


def test_a_steady_campaign_raises_no_alert_in_small_batches(spark, tmp_path):
    start = datetime(2024, 1, 1)
    # Forty visits in every hour, none near its ends: no hour is cut by the trailing windows.
    rows = [(start + timedelta(hours=h, minutes=10 + i), "c", "C", False) for h in range(48) for i in range(40)]
    schema = "visit_timestamp timestamp_ntz, campaign_id string, campaign_name string, is_conversion boolean"
    spark.createDataFrame(rows, schema).repartitionByRange(12, "visit_timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    once(jobs.alert_counts_writer(jobs.stream_alert_counts(stream), str(tmp_path)), tmp_path)
    assert jobs.stored_alerts(spark, str(tmp_path), start + timedelta(hours=47, minutes=55)).count() == 0
