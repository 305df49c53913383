"""Boundaries, skew and brute-force checks of the batch operators."""

from __future__ import annotations

import json
import random
import statistics
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from convlens.functions import expr as X
from convlens.operators import anomaly, features, ingest, joins, patterns, report, tree, views
from convlens.operators.asof import asof_last
from convlens.operators.median import grouped_median

AS_OF = datetime(2025, 3, 10, 12)

VISIT = (
    "visit_id string, campaign_id string, campaign_name string, country_code string, "
    "device string, visit_timestamp timestamp_ntz, is_click boolean, is_conversion boolean, "
    "revenue decimal(12,6), cost decimal(12,6), profit decimal(12,6)"
)


def visit(i, ts, campaign="c", country="US", device="mobile", click=True, won=False, revenue="0"):
    money = Decimal(revenue)
    return (str(i), campaign, f"N {campaign}", country, device, ts, click, won, money, Decimal(1), money - 1)


def visits(spark, rows):
    return spark.createDataFrame(rows, VISIT)


def test_rounding(spark):
    cases = [(1005, 100000), (285, 100000), (1, 3), (2, 3), (1, 0), (None, 5)]
    frame = spark.createDataFrame(cases, "n bigint, d bigint")
    got = [r[0] for r in frame.select(X.pct("n", "d")).collect()]
    assert got == [1.01, 0.29, 33.33, 66.67, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_time_parts_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    moment = datetime(2025, 3, 9, 2, 30, 1, 123456)  # a gap hour in New York; a Sunday
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = (
            spark.createDataFrame([(moment,)], "t timestamp_ntz")
            .select(
                X.hour_start("t"),
                X.minute_start("t"),
                X.dow("t"),
                X.weekday_name("t"),
                X.week_start("t"),
                X.instant_to_utc(X.utc_to_instant("t")),
                X.local_time("t", "America/Los_Angeles"),
            )
            .first()
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (
        datetime(2025, 3, 9, 2),
        datetime(2025, 3, 9, 2, 30),
        0,
        "Sunday",
        date(2025, 3, 3),
        moment,
        datetime(2025, 3, 8, 18, 30, 1, 123456),
    )


def test_window_is_open_below_and_closed_above(spark):
    day = timedelta(days=30)
    rows = [
        visit(1, AS_OF - day),
        visit(2, AS_OF - day + timedelta(microseconds=1)),
        visit(3, AS_OF),
        visit(4, AS_OF + timedelta(microseconds=1)),
    ]
    assert views.cr_by_segment(visits(spark, rows), AS_OF, min_visits=0).first()["visits"] == 2


@pytest.mark.parametrize("threshold, found", [(2, 1), (3, 0)])
def test_having_is_strict(spark, threshold, found):
    rows = [visit(i, AS_OF) for i in range(3)]
    assert views.cr_by_segment(visits(spark, rows), AS_OF, min_visits=threshold).count() == found


def test_no_clicks_gives_null_rate(spark):
    row = views.daily_summary(visits(spark, [visit(1, AS_OF, click=False)]), AS_OF).first()
    assert (row["clicks"], row["cr"]) == (0, None)


def test_empty_inputs(spark):
    none = visits(spark, [])
    assert views.daily_summary(none, AS_OF).count() == 0
    assert anomaly.check_alerts(none, AS_OF).count() == 0
    assert features.ml_features(
        none.withColumns({c: F.lit("x") for c in ("os", "browser", "connection_type")}), AS_OF
    ).count() == 0
    empty = conversions(spark, [])
    totals = patterns.conversion_totals(empty, none).first()
    assert (totals["total_conversions"], totals["avg_rev_per_conv"]) == (0, None)
    assert patterns.feature_patterns(empty).count() == 0
    assert patterns.two_feature_patterns(empty).count() == 0
    assert patterns.patterns_by_var3(empty).count() == 0
    assert patterns.report_summary(empty).first()["total_conversions"] == 0


def test_rollup_sums_to_its_visits(spark, sf):
    from convlens.sources import derive

    rows = derive.visits(spark, sf)
    rollup = views.hourly_rollup(rows, datetime(2024, 1, 1))
    whole = rows.agg(F.count(F.lit(1)), F.sum("revenue"), F.sum("profit")).first()
    assert tuple(rollup.agg(F.sum("visits"), F.sum("revenue"), F.sum("profit")).first()) == tuple(whole)


def test_traffic_drop(spark):
    rows = [visit(f"{d}-{i}", AS_OF - timedelta(days=d, minutes=-5)) for d in range(1, 7) for i in range(10)]
    rows += [visit(f"n{i}", AS_OF - timedelta(minutes=i)) for i in range(4)]
    as_of = AS_OF + timedelta(minutes=30)
    (row,) = anomaly.traffic_drops(visits(spark, rows), as_of).collect()
    # Usual: six earlier days of 10 at noon and today's one; current: the four of the last hour.
    assert (row["avg_hourly"], row["current_visits"]) == (round(61 / 7), 4)
    assert anomaly.traffic_drops(visits(spark, rows), as_of, ratio=0.4).count() == 0


def test_anomaly_needs_strictly_more_visits(spark):
    rows = [visit(i, AS_OF - timedelta(days=2), won=i < 10) for i in range(95)]
    rows += [visit(f"n{i}", AS_OF, won=True) for i in range(11)]
    frame = visits(spark, rows)
    (row,) = anomaly.anomaly_cr(frame, AS_OF).collect() or [None]
    assert (row["status"], row["current_cr_pct"]) == ("HIGH", 100.0)
    assert anomaly.anomaly_cr(frame, AS_OF, min_current=11).count() == 0
    assert anomaly.anomaly_cr(frame, AS_OF, min_baseline=106).count() == 0


def test_momentum_splits_by_date(spark):
    rows = [
        visit(1, datetime(2025, 3, 3, 18), revenue="500", won=True),  # date not later than the 3rd, noon
        visit(2, datetime(2025, 3, 4, 1), revenue="700", won=True),
    ]
    row = views.campaign_momentum(visits(spark, rows), AS_OF).first()
    assert (row["previous_7d_revenue"], row["recent_7d_revenue"]) == (500.0, 700.0)
    assert row["momentum"] == "GROWING"


@pytest.mark.parametrize("hot", [False, True])
def test_activity_against_brute_force(spark, hot):
    """History features at every boundary, with a campaign that owns most rows."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        campaign = "c0" if hot and i % 3 else f"c{rng.randrange(4)}"
        # Whole minutes make equal times and exact one-hour and one-day distances common.
        ts = AS_OF - timedelta(minutes=rng.randrange(0, 60 * 30, 5))
        rows.append(visit(i, ts, campaign, won=rng.random() < 0.3))
    frame = visits(spark, rows).withColumns(
        {c: F.lit("x") for c in ("os", "browser", "connection_type")}
    )
    # One day is described; its history reaches a day further.
    got = {r["visit_id"]: r for r in features.ml_features(frame, AS_OF, days=1).collect()}
    described = [r for r in rows if r[5] > AS_OF - timedelta(days=1)]
    assert len(got) == len(described)
    for r in described:
        same = [o for o in rows if o[1] == r[1]]
        hour = [o for o in same if r[5] - timedelta(hours=1) < o[5] < r[5]]
        day = [o for o in same if r[5] - timedelta(days=1) < o[5] < r[5]]
        assert got[r[0]]["campaign_visits_1h"] == len(hour)
        want = sum(o[7] for o in day) / len(day) if day else None
        assert got[r[0]]["campaign_cr_24h"] == want


def test_asof_against_brute_force(spark):
    rng = random.Random(3)
    start = datetime(2025, 1, 1)

    def at():
        return start + timedelta(seconds=30 * rng.randrange(400))

    asks = [(rng.choice("aaab"), i, at()) for i in range(200)]
    seen = [(rng.choice("aaac"), i, at()) for i in range(200)]
    got = asof_last(
        spark.createDataFrame(asks, "k string, id int, t timestamp_ntz"),
        spark.createDataFrame(seen, "k string, v int, s timestamp_ntz"),
        by="k",
        at="t",
        other_at="s",
        value="v",
    )
    want = {}
    for k, i, t in asks:
        earlier = [(s, v) for key, v, s in seen if key == k and s < t]
        want[i] = max(earlier) if earlier else (None, None)
    assert {r["id"]: (r["s"], r["v"]) for r in got.collect()} == want


def test_median_against_statistics(spark):
    rng = random.Random(5)
    rows = [("hot", Decimal(rng.randrange(-4000, 4000)) / 7) for _ in range(501)]
    rows += [(g, Decimal(rng.randrange(3)) + Decimal("0.25")) for g in "abc" for _ in range(rng.randrange(1, 9))]
    rows += [("one", Decimal("1.5")), ("same", Decimal(2)), ("same", Decimal(2))]
    frame = spark.createDataFrame(rows, "g string, v decimal(12,6)")
    groups = defaultdict(list)
    for r in frame.collect():
        groups[r["g"]].append(r["v"])
    got = {r["g"]: (r["n"], r["median"]) for r in grouped_median(frame, ["g"], "v").collect()}
    assert got == {g: (len(v), float(statistics.median(v))) for g, v in groups.items()}
    whole = grouped_median(frame, [], "v").first()
    assert whole["median"] == float(statistics.median([v for vs in groups.values() for v in vs]))
    assert grouped_median(frame.limit(0), [], "v").count() == 0
    counted = frame.groupBy("g", "v").agg(F.count(F.lit(1)).alias("w"))
    again = {r["g"]: (r["n"], r["median"]) for r in grouped_median(counted, ["g"], "v", weight="w").collect()}
    assert again == got


def test_every_visit_meets_each_of_its_conversions(spark):
    names = ["campaign_id", "campaign_name", "country_code", "device", "os", "browser", "isp"]
    visit = ", ".join(["click_id string", "visit_timestamp timestamp_ntz", *(f"{n} string" for n in names)])
    rows = [(c, AS_OF, *names) for c in ("hot", "warm", "cold", "none", None)]
    visits = spark.createDataFrame(rows, visit)
    conversion = "click_id string, postback_timestamp timestamp_ntz, revenue decimal(18,6), payout decimal(18,6), offer_name string, transaction_id string"
    found = [("hot", f"h{i}") for i in range(100)] + [("warm", "w1"), ("warm", "w2"), ("cold", "c"), ("other", "o"), (None, "n")]
    conversions = spark.createDataFrame([(c, AS_OF, None, None, "o", t) for c, t in found], conversion)
    got = joins.visit_conversions(visits, conversions)
    plan = got._jdf.queryExecution().toString()
    assert "strategy=broadcast" not in plan
    assert got.count() == 105
    assert {r["click_id"] for r in got.filter(~F.col("converted")).collect()} == {"none", None}


def test_large_amounts_and_median_of_wide_money(spark):
    texts = ["0.01", "999999.99", "1500000", "2500000.5", "1.0E9", "999999999999.999999", "1000000000000", "n/a", "", None]
    raw = spark.createDataFrame([(json.dumps({"clickId": str(i), "revenue": t}),) for i, t in enumerate(texts)], "value string")
    rows = {r["click_id"]: r for r in ingest.normalize_conversions(raw).collect()}
    assert [str(rows[str(i)]["revenue"]) for i in range(6)] == [
        "0.010000", "999999.990000", "1500000.000000", "2500000.500000", "1000000000.000000", "999999999999.999999"
    ]
    assert [rows[str(i)]["revenue_raw"] for i in range(10)] == [None] * 6 + ["1000000000000", "n/a", None, None]
    assert all(rows[str(i)]["revenue"] == 0 for i in range(6, 10))
    rng = random.Random(8)
    values = [Decimal(rng.randrange(-(10**17), 10**17)) / 10**6 for _ in range(501)] + [Decimal("999999999999.999999")] * 3
    values += [Decimal(rng.randrange(-(10**7), 10**7)) / 10**6 for _ in range(400)]
    frame = spark.createDataFrame([("k", v) for v in values], "g string, v decimal(18,6)")
    (row,) = grouped_median(frame, ["g"], "v").collect()
    assert row["median"] == pytest.approx(float(statistics.median(values)), rel=1e-12)


def test_numbering_follows_the_order(spark):
    rng = random.Random(2)
    rows = [
        (f"{i:03}", i % 3, None if i % 50 == 0 else AS_OF + timedelta(seconds=10 * rng.randrange(90)))
        for i in range(600)
    ]
    frame = spark.createDataFrame(rows, "id string, g int, t timestamp_ntz")
    got = {r["id"]: r["number"] for r in tree.numbered(frame, ["g"], "t", "id").collect()}
    for g in range(3):
        own = sorted((t is not None, t or AS_OF, i) for i, group, t in rows if group == g)
        assert [got[i] for _, _, i in own] == list(range(len(own)))


CONVERSION = (
    "transaction_id string, custom_var_3 string, country_code string, device string, os string, "
    "browser string, connection_type string, isp string, revenue decimal(12,6), payout decimal(12,6)"
)


def conversions(spark, rows):
    """Rows of (var3, country, device, os, revenue)."""
    full = [
        (str(i), v, c, d, o, "b", "w", None, None if r is None else Decimal(r), Decimal(1))
        for i, (v, c, d, o, r) in enumerate(rows)
    ]
    return spark.createDataFrame(full, CONVERSION)


def test_pattern_values_may_hold_any_character(spark):
    rows = [("v|1", "US", "m", "o", "2")] * 5 + [(None, "", "m", "o", "1")] * 5 + [("x", "US", "m", "o", "9")] * 4
    got = patterns.pattern_stats(conversions(spark, rows), ["custom_var_3", "country_code"]).collect()
    assert [(r["custom_var_3"], r["country_code"], r["convs"], r["rev_per_conv"]) for r in got] == [
        ("v|1", "US", 5, 2.0),
        ("unknown", "unknown", 5, 1.0),
    ]


def test_unknown_values_are_no_pattern(spark):
    rows = [("v", c, "m", "o", "3") for c in ["US"] * 20 + ["unknown"] * 20 + [""] * 20 + [None] * 20]
    got = patterns.feature_patterns(conversions(spark, rows), ["country_code"]).collect()
    assert [(r["value"], r["count"], r["deviation"], r["pct_high"]) for r in got] == [("US", 20, 0.0, 0.0)]


def test_zero_median_gives_zero_deviation(spark):
    rows = [("v", "US", "m", "o", r) for r in ["0"] * 15 + ["5"] * 10]
    (row,) = patterns.feature_patterns(conversions(spark, rows), ["country_code"]).collect()
    assert (row["deviation"], row["pct_high"]) == (0.0, 40.0)


def test_campaign_minimum_grows_with_the_campaign(spark):
    # 120 conversions need 120 // 20 = 6 per value.
    rows = [("v", "US", "m", "o", "1")] * 109 + [("v", "DE", "m", "o", "9")] * 6 + [("v", "FR", "m", "o", "9")] * 5
    got = patterns.campaign_patterns(conversions(spark, rows), ["country_code"]).collect()
    assert [(r["value"], r["conversions"]) for r in got] == [("DE", 6)]


def test_unreadable_revenue_counts_as_zero(spark):
    frame = conversions(spark, [("v", "US", "m", "o", None)]).withColumn("revenue", F.lit("n/a"))
    row = patterns.clean_conversions(frame).first()
    assert row["revenue"] == Decimal(0)


def test_report_days_and_zone(spark):
    rows = [
        visit(1, datetime(2025, 3, 10, 7, 59), revenue="5"),
        visit(2, datetime(2025, 3, 10, 7), revenue="5"),
        visit(3, datetime(2025, 3, 10, 6, 59, 59), revenue="5"),
        visit(4, datetime(2025, 3, 11, 6, 59, 59), revenue="5"),
    ]
    # Summer time began on the 9th, so the 10th starts at 07:00 UTC.
    got = report.performance_report(
        visits(spark, rows), date(2025, 3, 10), group_by="day", tz="America/Los_Angeles"
    ).collect()
    assert [(r["dimension"], r["visits"], r["row_type"]) for r in got] == [
        ("2025-03-10", 3, "group"),
        (None, 3, "total"),
    ]


def test_report_total_covers_rows_beyond_the_limit(spark):
    rows = [visit(i, AS_OF, f"c{i}", revenue=str(i)) for i in range(5)]
    got = report.performance_report(visits(spark, rows), AS_OF.date(), limit=2).collect()
    assert [r["visits"] for r in got] == [1, 1, 5]
    assert [r["dimension"] for r in got] == ["c4", "c3", None]
    worst = report.worst_performers(visits(spark, rows), AS_OF.date()).collect()
    assert [(r["dimension"], r["profit"]) for r in worst] == [("c0", -1.0)]


def test_report_arguments(spark):
    with pytest.raises(ValueError):
        report.performance_report(visits(spark, []), AS_OF.date(), group_by="planet")
    with pytest.raises(ValueError):
        report.performance_report(visits(spark, []), AS_OF.date(), sort_by="planet")
    assert report.report_days(date(2025, 1, 9), None, None, 3) == (date(2025, 1, 6), date(2025, 1, 9))
    assert report.report_days(date(2025, 1, 9), date(2025, 1, 2), None, None) == (date(2025, 1, 2),) * 2


def test_name_is_the_latest(spark):
    rows = [visit(1, AS_OF), visit(2, AS_OF + timedelta(minutes=1))]
    rows[1] = (*rows[1][:2], "Renamed", *rows[1][3:])
    got = report.performance_report(visits(spark, rows), AS_OF.date()).first()
    assert (got["name"], got["visits"]) == ("Renamed", 2)


def test_views_answer_sql(spark, sf):
    from convlens.plans.views import register_views
    from convlens.sources import derive

    as_of = datetime(2024, 1, 30, 22)
    names = register_views(
        spark,
        as_of,
        visits=derive.visits(spark, sf),
        live_visits=derive.live_visits(spark, sf),
        live_clicks=derive.live_clicks(spark, sf),
        conversions=derive.conversions(spark, sf),
    )
    assert len(names) == 23
    total = spark.sql("SELECT sum(visits) FROM daily_summary WHERE country_code = 'US'").first()[0]
    rows = derive.visits(spark, sf).filter(X.trailing("visit_timestamp", as_of, days=30))
    assert total == rows.filter("country_code = 'US'").count()
    plan = spark.sql("SELECT click_id FROM visit_conversions WHERE device = 'mobile'")
    assert plan.count() > 0
