"""The sync cycle: what it reads, what it merges, what it rolls up, and what a lost run leaves."""

from __future__ import annotations

import json
import os
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from convlens.operators.views import hourly_rollup
from convlens.plans import sync
from convlens.sources import arrivals, schemas as S, tables
from convlens.sources.tables import DAY, read_table, scan_projected, upsert_table

START = datetime(2025, 1, 1)


def put(folder, name, rows, age=None):
    folder.mkdir(exist_ok=True, parents=True)
    file = folder / name
    file.write_text("\n".join(map(json.dumps, rows)) + "\n")
    if age is not None:
        os.utime(file, (age, age))


def visit(i, hours=0, **more):
    return {"clickId": f"v{i}", "timestamp": (START + timedelta(hours=hours)).isoformat() + "Z", **more}


def ids(spark, path, schema, key="click_id"):
    return sorted(r[key] for r in read_table(spark, path, schema).collect())


@pytest.mark.parametrize("named", [0, 10_000])
def test_a_cycle_reads_new_files_only(spark, tmp_path, monkeypatch, named):
    """Unchanged, late, rewritten and many files; by name and by the times they were written."""
    monkeypatch.setattr(arrivals, "NAMED", named)
    raw, out, log = tmp_path / "raw", f"{tmp_path}/t", f"{tmp_path}/t/sync_files"
    opened = []
    read = arrivals.read_files
    monkeypatch.setattr(arrivals, "read_files", lambda *a: opened.append(r := read(*a)) or r)

    def cycle():
        sync.run_cycle(spark, {"live_visits": str(raw)}, out, START + timedelta(days=1))
        return sorted({r[0].rsplit("/")[-1] for r in opened[-1].select("arrival.file_path").collect()})

    put(raw, "a b.json", [visit(1), visit(2)], age=1_700_000_000)
    put(raw, "b.json", [visit(2, os="late"), visit(3)], age=1_700_000_100)
    assert cycle() == ["a%20b.json", "b.json"]
    assert cycle() == []
    if named:
        assert opened[-1].inputFiles() == []
    put(raw, "c.json", [visit(4)], age=1_600_000_000)  # older than all that has been read
    put(raw, "d.json", [visit(5)], age=1_700_000_200)
    assert cycle() == ["c.json", "d.json"]
    if named:
        assert len(opened[-1].inputFiles()) == 2
    put(raw, "d.json", [visit(5), visit(6)], age=1_700_000_300)  # written again
    assert cycle() == ["d.json"]
    assert ids(spark, f"{out}/live_visits", S.LIVE_VISITS) == [f"v{i}" for i in range(1, 7)]
    state = sync.read_state(spark, out).first()
    assert state["last_sync_timestamp"] == START + timedelta(days=1) and sync.loads(spark, out, "live_visits") == 4
    assert spark.read.schema(arrivals.LOG).parquet(log).count() == 5


def test_a_lost_load_is_repeated(spark, tmp_path):
    """A run that ends before its state is saved has read nothing, as far as the next one knows."""
    raw, out = tmp_path / "raw", f"{tmp_path}/t"
    put(raw, "1.json", [visit(1)])
    sync.run_cycle(spark, {"live_visits": str(raw)}, out, START)
    put(raw, "2.json", [visit(2)])
    assert sync.load_arrivals(spark, str(raw), out, "live_visits") == 1  # and no save_state
    assert sync.load_arrivals(spark, str(raw), out, "live_visits") == 1
    sync.save_state(spark, out, "live_visits", START, 1)
    assert sync.load_arrivals(spark, str(raw), out, "live_visits") == 0
    assert ids(spark, f"{out}/live_visits", S.LIVE_VISITS) == ["v1", "v2"]


def test_no_folder_and_no_rows(spark, tmp_path):
    sync.run_cycle(spark, {"live_visits": f"{tmp_path}/none", "conversions": f"{tmp_path}/none"}, f"{tmp_path}/t", START)
    (tmp_path / "empty").mkdir()
    sync.run_cycle(spark, {"visits": f"{tmp_path}/empty"}, f"{tmp_path}/t", START)
    assert ids(spark, f"{tmp_path}/t/live_visits", S.LIVE_VISITS) == []


def test_conversions_go_on_from_the_last_sync(spark, tmp_path):
    """The running hour waits, a pause loses nothing, and what is older than the window is the backfill's."""
    raw, out = tmp_path / "raw", f"{tmp_path}/t"

    def cycle(hours):
        sync.run_cycle(spark, {"conversions": str(raw)}, out, START + timedelta(hours=hours))
        return ids(spark, f"{out}/conversions", S.CONVERSIONS)

    post = lambda i, h: {"clickId": f"k{i}", "postbackTimestamp": (START + timedelta(hours=h)).isoformat() + "Z"}
    put(raw, "1.json", [post(0, -30), post(1, -3), post(2, 9.5), post(3, 10.2), post(4, 30)])
    assert cycle(10.6) == ["k1", "k2"]
    assert cycle(10.9) == ["k1", "k2"]
    assert cycle(11) == ["k1", "k2", "k3"]
    put(raw, "2.json", [post(5, -12), post(6, -20), post(7, 60)])
    assert cycle(90) == ["k1", "k2", "k3", "k4", "k5", "k7"]  # three days later; k6 is before 11 h - 1 day
    assert sync.run_backfill(spark, str(raw), out, "conversions", START + timedelta(hours=90), days=10) == []
    assert ids(spark, f"{out}/conversions", S.CONVERSIONS) == [f"k{i}" for i in range(8)]


def test_merge_by_key_index(spark, tmp_path, monkeypatch):
    """Corrected times move rows between days; only touched buckets are read; a rebuilt index equals the kept one."""
    monkeypatch.setattr(tables, "BUCKETS", 8)
    path, draw = f"{tmp_path}/live_visits", random.Random(5)
    want = {}

    def merge(rows, again=False):
        frame = spark.createDataFrame([(k, t, v) for k, (t, v) in rows.items()], "click_id string, visit_timestamp timestamp_ntz, os string")
        others = {f.name: F.lit(None).cast(f.dataType) for f in S.LIVE_VISITS if f.name not in frame.columns}
        batch = frame.withColumns(others)
        upsert_table(spark, batch, path, S.LIVE_VISITS, ["click_id"], "visit_timestamp")
        want.update(rows)
        table = read_table(spark, path, S.LIVE_VISITS).select("click_id", "visit_timestamp", "os", DAY).collect()
        assert sorted(map(str, [(r[0], r[1], r[2]) for r in table])) == sorted(str((k, *v)) for k, v in want.items())
        assert all(r[3] == (r[1].date() if r[1] else None) for r in table)
        return batch

    for number in range(3):
        rows = {f"k{draw.randint(0, 40)}": (draw.choice([None, START + timedelta(hours=draw.randint(0, 100))]), f"{number}") for _ in range(15)}
        batch = merge(rows)
        merge(rows)  # repeated
    one = batch.limit(1)
    plan = tables.touched_index(spark, path, one, ["click_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", text)
    assert all("live_visits_keys" in f for f in plan.inputFiles())  # no column of the table itself
    live = tables.read_index(spark, path).distinct()
    held = {(r[0], r[1]) for r in live.collect()}
    tables.rebuild_index(spark, path, S.LIVE_VISITS, ["click_id"])
    rebuilt = {(r[0], r[1]) for r in tables.read_index(spark, path).collect()}
    assert rebuilt <= held and len(rebuilt) == len(want)
    merge({"k1": (START, "last")})


def test_keys_with_their_time_need_no_index(spark, tmp_path):
    path = f"{tmp_path}/conversions"
    row = spark.createDataFrame([("k", START)], "click_id string, postback_timestamp timestamp_ntz")
    batch = row.withColumns({f.name: F.lit(None).cast(f.dataType) for f in S.CONVERSIONS if f.name not in row.columns})
    for _ in range(2):
        upsert_table(spark, batch, path, S.CONVERSIONS, ["click_id", "postback_timestamp"], "postback_timestamp")
    assert not os.path.exists(f"{path}_keys") and ids(spark, path, S.CONVERSIONS) == ["k"]


def wide(i, hours, revenue=1, **more):
    when = (START + timedelta(hours=hours)).isoformat() + "Z"
    row = {"visitId": f"v{i}", "campaignId": f"c{i % 3}", "campaignName": f"C{i % 3}", "countryCode": "US" if i % 4 else None}
    return {**row, "deviceType": "m", "visitTimestamp": when, "isClick": i % 2 == 0, "isConversion": i % 5 == 0, "revenue": revenue, **more}


@pytest.mark.parametrize("seed", [1, 2])
def test_rollup_follows_the_merges(spark, tmp_path, seed):
    """Any order of batches, corrected times, campaigns and amounts; hours that lose all their visits."""
    raw, out, draw = tmp_path / "raw", f"{tmp_path}/t", random.Random(seed)
    for number in range(4):
        rows = [wide(draw.randint(0, 30), draw.randint(0, 50) + draw.random(), draw.randint(1, 9), campaignId=f"c{draw.randint(0, 2)}") for _ in range(12)]
        rows.append({"visitId": f"n{number}", "campaignId": "c"})
        put(raw, f"{number}.json", rows, age=1_700_000_000 + number)
        sync.run_cycle(spark, {"visits": str(raw)}, out, START + timedelta(days=3))
        visits = read_table(spark, f"{out}/visits", S.VISITS).withColumnRenamed("device_type", "device")
        whole = hourly_rollup(visits, START - timedelta(days=9))
        kept = read_table(spark, f"{out}/hourly_stats", S.HOURLY_STATS).select(*whole.columns)
        assert sorted(map(str, kept.collect())) == sorted(map(str, whole.collect()))
    assert sync.refresh_rollup(spark, out) == 0  # nothing is due


def test_untouched_hours_are_not_read(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", f"{tmp_path}/t"
    put(raw, "1.json", [wide(i, 30 * i) for i in range(5)])
    sync.run_cycle(spark, {"visits": str(raw)}, out, START + timedelta(days=9))
    seen = []
    real = sync.hourly_rollup
    monkeypatch.setattr(sync, "hourly_rollup", lambda visits, *a: seen.append(visits) or real(visits, *a))
    put(raw, "2.json", [wide(7, 60.5)])
    sync.run_cycle(spark, {"visits": str(raw)}, out, START + timedelta(days=9))
    (visits,) = seen
    plan = visits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*day[^]]*2025-01-03\b", plan) and "GreaterThanOrEqual(visit_timestamp" in plan
    assert sorted(r["visit_id"] for r in visits.collect()) == ["v2", "v7"]


def test_what_is_due_survives_a_lost_cycle(spark, tmp_path):
    """A correction whose cycle ends before the rollup: its old hour is known to the next cycle too."""
    raw, out = tmp_path / "raw", f"{tmp_path}/t"
    put(raw, "1.json", [wide(1, 5)])
    sync.run_cycle(spark, {"visits": str(raw)}, out, START + timedelta(days=1))
    put(raw, "2.json", [wide(1, 8)])
    sync.load_arrivals(spark, str(raw), out, "visits")
    sync.run_cycle(spark, {"visits": str(raw)}, out, START + timedelta(days=1))
    rows = read_table(spark, f"{out}/hourly_stats", S.HOURLY_STATS).collect()
    assert [r["hour_timestamp"] for r in rows] == [START + timedelta(hours=8)]


def test_time_bounds_hold_for_day_folders(spark, tmp_path):
    """A projected scan and the expiry open only the days that their bound allows."""
    rows = [(f"k{i}", START + timedelta(days=i, hours=6)) for i in range(20)] + [("never", None)]
    frame = spark.createDataFrame(rows, "click_id string, postback_timestamp timestamp_ntz")
    batch = frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in S.CONVERSIONS if f.name not in frame.columns})
    path = f"{tmp_path}/conversions"
    upsert_table(spark, batch, path, S.CONVERSIONS, ["click_id", "postback_timestamp"], "postback_timestamp")
    stored = read_table(spark, path, S.CONVERSIONS)
    scan = scan_projected(stored, START + timedelta(days=18, hours=6), days=3, columns=["click_id"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*day[^]]*>= 2025-01-16", plan)
    assert sorted(r[0] for r in scan.collect()) == ["k15", "k16", "k17", "k18", "k19"]
    last = START + timedelta(days=9, hours=12)  # the tenth day is wholly past, the eleventh is not
    assert tables.expire_table(spark, path, S.CONVERSIONS, "postback_timestamp", last, days=0) == 10
    assert ids(spark, path, S.CONVERSIONS) == sorted([f"k{i}" for i in range(10, 20)] + ["never"])
    assert tables.expire_table(spark, f"{tmp_path}/none", S.CONVERSIONS, "postback_timestamp", last) == 0


def test_backfill_reads_once_and_repeats_failed_chunks(spark, tmp_path, monkeypatch):
    raw, out, now = tmp_path / "raw", f"{tmp_path}/t", START + timedelta(days=30)
    put(raw, "1.json", [visit(i, 24 * i) for i in range(30)] + [{"os": "no id"}])
    reads, merges = [], []
    read, merge = sync.read_raw, sync.merge_rows

    def merging(spark, rows, warehouse, feed, **how):
        chunk = sorted(r["click_id"] for r in rows.select("click_id").collect())
        merges.append(len(chunk))
        if len(merges) == 2:
            raise RuntimeError("lost")
        return merge(spark, rows, warehouse, feed, **how)

    monkeypatch.setattr(sync, "read_raw", lambda *a: reads.append(1) or read(*a))
    monkeypatch.setattr(sync, "merge_rows", merging)
    failed = sync.run_backfill(spark, str(raw), out, "live_visits", now, days=30)
    assert failed == [sync.backfill_chunks(now, 30)[1]] and len(merges) == 5
    assert ids(spark, f"{out}/live_visits", S.LIVE_VISITS) == sorted(f"v{i}" for i in range(30) if not 16 <= i < 23)
    assert sync.run_backfill(spark, str(raw), out, "live_visits", now, days=30) == []
    assert len(merges) == 6 and len(reads) == 1
    assert ids(spark, f"{out}/live_visits", S.LIVE_VISITS) == sorted(f"v{i}" for i in range(30))
    assert [r["reason"] for r in spark.read.parquet(f"{out}/rejected").collect()] == ["no id or broken row"]


@pytest.mark.parametrize("few", [0, 500_000])
def test_only_repeated_keys_are_deduplicated(spark, tmp_path, monkeypatch, few):
    """Rows of single keys stay where they are; the result is that of the operator, by either way."""
    monkeypatch.setattr(sync, "FEW", few)
    rows = [(f"k{i}", i, START, f"os{i}") for i in range(20)]
    rows += [("k3", 90, START, "later"), ("k3", -1, None, "first"), ("k4", 91, START, "later"), ("k5", -2, START, "first")]
    rows += [(None, 92, START, "no id"), (None, 93, START, "no id"), ("", 94, START, "empty"), ("u", 95, None, "no time"), ("u", 96, None, "no time")]
    frame = spark.createDataFrame(rows, "click_id string, ingest_seq int, postback_timestamp timestamp_ntz, os string")
    for dedupe, keys in ((sync.ingest.dedupe_visits, ["click_id"]), (sync.ingest.dedupe_conversions, ["click_id", "postback_timestamp"])):
        compared = []
        got = sync.first_rows(frame, lambda r: compared.append(r.count()) or dedupe(r), keys).select(frame.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, dedupe(frame).collect()))
        many = {1: 9, 2: 8}[len(keys)]
        assert compared == [many if few else len(rows)]


def test_a_load_parses_its_text_once(spark, tmp_path, monkeypatch):
    """What is filtered, de-duplicated and merged is read from a written table, waiting rows included."""
    raw, out, plans = tmp_path / "raw", f"{tmp_path}/t", []
    post = lambda i, h: {"clickId": f"k{i}", "postbackTimestamp": (START + timedelta(hours=h)).isoformat() + "Z"}
    merge, reject = sync.merge_rows, sync.rejected_rows
    seen = lambda rows: plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(sync, "merge_rows", lambda s, every, *a, **b: seen(every) or merge(s, every, *a, **b))
    monkeypatch.setattr(sync, "rejected_rows", lambda rows, feed: seen(rows) or reject(rows, feed))
    put(raw, "1.json", [post(1, 9), post(2, 30), {"postbackTimestamp": "?"}])
    sync.run_cycle(spark, {"conversions": str(raw)}, out, START + timedelta(hours=12))
    put(raw, "2.json", [post(3, 31)])
    sync.run_cycle(spark, {"conversions": str(raw)}, out, START + timedelta(hours=40))
    assert ids(spark, f"{out}/conversions", S.CONVERSIONS) == ["k1", "k2", "k3"]
    assert len(plans) == 4 and not any("from_json" in p for p in plans)
    assert [r["reason"] for r in spark.read.parquet(f"{out}/rejected").collect()] == ["no id or broken row"]
