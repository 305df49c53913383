"""The registered queries as SQL for an independent engine, over the same event table.

The SQL is written the plain way (ASOF joins, correlated counts, built-in medians and deviations),
not the way the Spark plans are, so that agreement means something.
"""

from __future__ import annotations

from convlens.operators.patterns import CAMPAIGN_FEATURES, FEATURE_PAIRS, PATTERN_PRESETS, SEGMENT_FEATURES
from convlens.operators.report import CATALOG_PARENTS, DIMENSIONS
from convlens.operators.tree import TREE_FEATURES
from convlens.sources import schemas
from convlens.sources.derive import ATTRIBUTES

AS_OF = "TIMESTAMP '2024-01-30 22:00:00'"
ATTRS = ", ".join(ATTRIBUTES)

ORACLE: dict[str, str] = {}


# --- building blocks -------------------------------------------------------------------------


def pct(num: str, den: str, places: int = 2) -> str:
    return (
        f"CAST(round(CAST(100.0::DOUBLE * CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)"
        f" AS DECIMAL(24,6)), {places}) AS DOUBLE)"
    )


def ratio(num: str, den: str, places: int = 4) -> str:
    return (
        f"CAST(round(CAST(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)"
        f" AS DECIMAL(24,8)), {places}) AS DOUBLE)"
    )


def mean(total: str, n: str) -> str:
    return f"(CAST({total} AS DOUBLE) / nullif(CAST({n} AS DOUBLE), 0))"


def rounded(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(30,10)), {places}) AS DOUBLE)"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def n(value: str = "*") -> str:
    return f"CAST(count({value}) AS BIGINT)"


def count_if(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def since(ts: str, span: str, at: str = AS_OF) -> str:
    return f"({ts} > {at} - INTERVAL {span} AND {ts} <= {at})"


def dow(ts: str) -> str:
    return f"CAST(extract(dow FROM {ts}) AS INT)"


def hour(ts: str) -> str:
    return f"CAST(extract(hour FROM {ts}) AS INT)"


EVENTS = """ev AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k,
         CAST(value AS DECIMAL(12,2)) AS amount
  FROM events),
tracked AS (
  SELECT *,
    'c' || (user_id % 8) AS campaign_id, 'Campaign ' || (user_id % 8) AS campaign_name,
    'o' || (user_id % 5) AS offer_id, 'Offer ' || (user_id % 5) AS offer_name,
    't' || (user_id % 3) AS traffic_source_id, 'Source ' || (user_id % 3) AS traffic_source_name,
    'n' || (user_id % 2) AS affiliate_network_id,
    'Network ' || (user_id % 2) AS affiliate_network_name,
    'l' || (k % 4) AS lander_id, 'Lander ' || (k % 4) AS lander_name,
    ['US','GB','DE','FR','BR','IN','JP'][k % 8 + 1] AS country_code,
    ['mobile','desktop','tablet'][k % 3 + 1] AS device,
    ['iOS','Android','Windows','macOS'][k % 4 + 1] AS os,
    ['Chrome','Safari','Firefox','Edge','Edge'][k % 5 + 1] AS browser,
    CASE WHEN (user_id * 7 + k) % 12 = 0 THEN '' ELSE 'ISP ' || ((user_id * 7 + k) % 12) END AS isp,
    CASE WHEN k % 2 = 0 THEN 'wifi' ELSE 'cellular' END AS connection_type,
    CASE WHEN user_id % 6 = 5 THEN NULL ELSE 'v' || (user_id % 6) END AS custom_var_3
  FROM ev)"""

VISITS = f"""visits AS (
  SELECT *, CAST(revenue - cost AS DECIMAL(12,6)) AS profit FROM (
    SELECT CAST(event_id AS VARCHAR) AS visit_id, CAST(event_id AS VARCHAR) AS click_id,
      ts AS visit_timestamp,
      event_type IN ('click','signup','purchase') AS is_click,
      event_type = 'purchase' AS is_conversion,
      CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,6))
           ELSE CAST(0 AS DECIMAL(12,6)) END AS revenue,
      CAST(amount * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(12,6)) AS cost,
      {ATTRS}
    FROM tracked))"""

LIVE = f"""live_visits AS (
  SELECT CAST(event_id AS VARCHAR) AS click_id, ts AS visit_timestamp, {ATTRS}
  FROM tracked WHERE event_type IN ('view','click')),
live_clicks AS (
  SELECT CAST(event_id AS VARCHAR) AS click_id, ts AS click_timestamp, {ATTRS}
  FROM tracked WHERE event_type = 'click')"""

CONVERSIONS = f"""touch AS (
  SELECT user_id, ts, max(event_id) AS event_id FROM ev
  WHERE event_type IN ('view','click') GROUP BY ALL),
conversions AS (
  SELECT *, CAST(revenue - cost AS DECIMAL(12,6)) AS profit FROM (
    SELECT coalesce(CAST(t.event_id AS VARCHAR), 'orphan-' || c.event_id) AS click_id,
      CAST(c.event_id AS VARCHAR) AS transaction_id,
      CASE WHEN event_type = 'purchase' THEN 'sale' ELSE 'lead' END AS conversion_type,
      c.ts AS postback_timestamp, t.ts AS visit_timestamp,
      CAST(amount * CASE device WHEN 'mobile' THEN CAST(1.5 AS DECIMAL(2,1))
        WHEN 'desktop' THEN CAST(1.0 AS DECIMAL(2,1)) ELSE CAST(0.3 AS DECIMAL(2,1)) END
        AS DECIMAL(12,6)) AS revenue,
      CAST(amount * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,6)) AS payout,
      CAST(amount * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(12,6)) AS cost,
      {ATTRS}
    FROM (SELECT * FROM tracked WHERE event_type IN ('purchase','signup')) c
    ASOF LEFT JOIN touch t ON c.user_id = t.user_id AND c.ts > t.ts))"""

# Conversions as the pattern reports read them.
CLEAN = """rows AS (
  SELECT * REPLACE (coalesce(custom_var_3, 'unknown') AS custom_var_3) FROM conversions)"""


def sql(key: str, body: str, *parts: str) -> None:
    """Register ``body`` behind the named tables; ``body`` may start with further WITH entries."""
    ORACLE[key] = "WITH " + ",\n".join([EVENTS, *parts]) + body


def visits_sql(key: str, body: str) -> None:
    sql(key, "\n" + body, VISITS)


def conv_sql(key: str, body: str) -> None:
    sql(key, "\n" + body, CONVERSIONS)


def both_sql(key: str, body: str) -> None:
    sql(key, "\n" + body, LIVE, CONVERSIONS)


SUMS = (
    f"{n()} AS visits, {count_if('is_click')} AS clicks, "
    f"{count_if('is_conversion')} AS conversions, {dbl('sum(revenue)')} AS revenue, "
    f"{dbl('sum(cost)')} AS cost, {dbl('sum(profit)')} AS profit"
)

# --- rollups, trends and alerts over visits --------------------------------------------------


def rollup_sql(condition: str, table: str = "visits") -> str:
    return f"""SELECT date_trunc('hour', visit_timestamp) AS hour_timestamp, campaign_id,
      max(campaign_name) AS campaign_name, country_code, device, {SUMS},
      {pct("count(*) FILTER (WHERE is_click)", "count(*)")} AS ctr,
      {pct("count(*) FILTER (WHERE is_conversion)", "count(*) FILTER (WHERE is_click)")} AS cr,
      {ratio("sum(revenue)", "count(*) FILTER (WHERE is_click)")} AS epc
    FROM {table} WHERE {condition}
    GROUP BY date_trunc('hour', visit_timestamp), campaign_id, country_code, device"""


visits_sql(
    "hourly_rollup",
    rollup_sql(f"visit_timestamp >= {AS_OF} - INTERVAL 30 DAY AND visit_timestamp <= {AS_OF}"),
)
visits_sql(
    "rollup_merge",
    f"""SELECT * EXCLUDE (age) FROM (
      SELECT *, 1 AS age FROM ({rollup_sql("visit_timestamp BETWEEN '2024-01-29' AND " + AS_OF)})
      UNION ALL
      SELECT *, 2 FROM ({rollup_sql("visit_timestamp BETWEEN '2024-01-01' AND TIMESTAMP '2024-01-29 12:00:00'")}))
    QUALIFY row_number() OVER (
      PARTITION BY hour_timestamp, campaign_id, country_code, device ORDER BY age) = 1""",
)
visits_sql(
    "daily_summary",
    f"""SELECT CAST(visit_timestamp AS DATE) AS date, campaign_name, country_code, {SUMS},
      {pct("count(*) FILTER (WHERE is_conversion)", "count(*) FILTER (WHERE is_click)")} AS cr
    FROM visits WHERE {since("visit_timestamp", "30 DAY")} GROUP BY 1, 2, 3""",
)
visits_sql(
    "hourly_patterns",
    f"""SELECT {hour("visit_timestamp")} AS hour_of_day, {dow("visit_timestamp")} AS day_of_week,
      campaign_name, country_code, {mean("sum(revenue)", "count(*)")} AS avg_revenue,
      {rounded("stddev_samp(CAST(revenue AS DOUBLE))", 6)} AS stddev_revenue,
      {n()} AS sample_count
    FROM visits WHERE {since("visit_timestamp", "30 DAY")} GROUP BY 1, 2, 3, 4
    HAVING count(*) > 2""",
)
_H1 = since("visit_timestamp", "1 HOUR")
REALTIME = f"""SELECT campaign_name, country_code,
      {count_if(_H1)} AS visits_1h, {count_if(_H1 + " AND is_conversion")} AS conv_1h,
      {n()} AS visits_24h, {count_if("is_conversion")} AS conv_24h,
      {pct(count_if(_H1 + " AND is_conversion"), count_if(_H1))} AS cr_1h,
      {pct(count_if("is_conversion"), "count(*)")} AS cr_24h
    FROM visits WHERE {since("visit_timestamp", "24 HOUR")} GROUP BY 1, 2 HAVING count(*) > 2"""
visits_sql("realtime_cr", REALTIME)
visits_sql("stream_realtime_cr", REALTIME)
visits_sql(
    "best_hours",
    f"""SELECT dayname(visit_timestamp) AS day_of_week, {hour("visit_timestamp")} AS hour,
      {n()} AS visits, {count_if("is_conversion")} AS conversions,
      {dbl("sum(revenue)")} AS revenue,
      {pct("count(*) FILTER (WHERE is_conversion)", "count(*)")} AS cr
    FROM visits WHERE {since("visit_timestamp", "30 DAY")} GROUP BY 1, 2 HAVING count(*) > 5
    ORDER BY sum(revenue) DESC, 1, 2 LIMIT 20""",
)
HEATMAP = f"""SELECT {dow("visit_timestamp")} AS day_of_week, {hour("visit_timestamp")} AS hour,
      {dbl("sum(revenue)")} AS total_revenue, {mean("sum(revenue)", "count(*)")} AS avg_revenue,
      {n()} AS visits
    FROM visits WHERE {since("visit_timestamp", "30 DAY")} GROUP BY 1, 2"""
visits_sql("hourly_heatmap", HEATMAP)
_CELLS = ", ".join(f"max(total_revenue) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24))
visits_sql(
    "hourly_heatmap_grid", f"SELECT day_of_week, {_CELLS} FROM ({HEATMAP}) GROUP BY day_of_week"
)
_WEEK = f"sum(revenue) FILTER (WHERE week = date_trunc('week', {AS_OF}))"
_LAST = f"sum(revenue) FILTER (WHERE week = date_trunc('week', {AS_OF} - INTERVAL 7 DAY))"
visits_sql(
    "country_trends",
    f"""SELECT country_code, {dbl("sum(revenue)")} AS total_revenue,
      CAST(sum(visits) AS BIGINT) AS total_visits,
      CAST(sum(conversions) AS BIGINT) AS total_conversions,
      {pct("sum(conversions)", "sum(visits)")} AS cr,
      {pct(f"coalesce({_WEEK}, 0) - coalesce({_LAST}, 0)", f"coalesce({_LAST}, 0)", 1)}
        AS wow_change_pct
    FROM (SELECT country_code, date_trunc('week', visit_timestamp) AS week,
            sum(revenue) AS revenue, count(*) AS visits,
            count(*) FILTER (WHERE is_conversion) AS conversions
          FROM visits WHERE {since("visit_timestamp", "30 DAY")} GROUP BY 1, 2)
    GROUP BY 1 HAVING sum(visits) > 100""",
)
_NEW = f"coalesce(sum(revenue) FILTER (WHERE visit_timestamp > {AS_OF} - INTERVAL 7 DAY), 0)"
_OLD = (
    f"coalesce(sum(revenue) FILTER (WHERE visit_timestamp BETWEEN {AS_OF} - INTERVAL 14 DAY "
    f"AND {AS_OF} - INTERVAL 7 DAY), 0)"
)
visits_sql(
    "emerging_countries",
    f"""SELECT country_code, {dbl(_NEW)} AS recent_revenue, {dbl(_OLD)} AS previous_revenue,
      {pct(f"{_NEW} - {_OLD}", _OLD, 1)} AS growth_pct
    FROM visits WHERE {since("visit_timestamp", "14 DAY")} GROUP BY 1
    HAVING {_OLD} > 0 AND {_NEW} > {_OLD} ORDER BY growth_pct DESC, country_code LIMIT 20""",
)
visits_sql(
    "campaign_momentum",
    f"""SELECT campaign_name, {dbl("round(r, 2)")} AS recent_7d_revenue,
      {dbl("round(p, 2)")} AS previous_7d_revenue,
      {pct("r - p", "p", 1)} AS revenue_change_pct, {dbl("round(rp, 2)")} AS recent_7d_profit,
      CASE WHEN {dbl("r")} > {dbl("p")} * 1.2::DOUBLE THEN 'GROWING'
           WHEN {dbl("r")} < {dbl("p")} * 0.8::DOUBLE THEN 'DECLINING' ELSE 'STABLE' END AS momentum
    FROM (
      SELECT campaign_id, campaign_name,
        sum(CASE WHEN d > {AS_OF} - INTERVAL 7 DAY THEN revenue ELSE 0 END) AS r,
        sum(CASE WHEN d > {AS_OF} - INTERVAL 7 DAY THEN 0 ELSE revenue END) AS p,
        sum(CASE WHEN d > {AS_OF} - INTERVAL 7 DAY THEN profit ELSE 0 END) AS rp
      FROM (SELECT campaign_id, campaign_name, CAST(visit_timestamp AS DATE) AS d,
              sum(revenue) AS revenue, sum(profit) AS profit
            FROM visits WHERE {since("visit_timestamp", "14 DAY")} GROUP BY 1, 2, 3)
      GROUP BY 1, 2)
    WHERE r + p > 100""",
)
visits_sql(
    "campaign_saturation",
    f"""SELECT campaign_name, {rounded("avg(epv)", 4)} AS avg_epv,
      {rounded("regr_slope(epv, d)", 6)} AS epv_daily_trend,
      CASE WHEN regr_slope(epv, d) / 86400 < -0.0001 THEN 'SATURATING'
           WHEN regr_slope(epv, d) / 86400 > 0.0001 THEN 'IMPROVING' ELSE 'STABLE' END AS status
    FROM (SELECT campaign_id, campaign_name,
            CAST(date_diff('day', DATE '1970-01-01', CAST(visit_timestamp AS DATE)) AS DOUBLE) AS d,
            {mean("sum(revenue)", "count(*)")} AS epv
          FROM visits WHERE {since("visit_timestamp", "30 DAY")} GROUP BY 1, 2, 3)
    GROUP BY campaign_id, campaign_name HAVING count(*) >= 7""",
)
visits_sql(
    "cr_by_segment",
    f"""SELECT device, country_code, {n()} AS visits, {count_if("is_conversion")} AS conversions,
      {pct("count(*) FILTER (WHERE is_conversion)", "count(*)")} AS cr,
      {dbl("sum(revenue)")} AS revenue, {ratio("sum(revenue)", "count(*)")} AS epv
    FROM visits WHERE {since("visit_timestamp", "30 DAY")} GROUP BY 1, 2 HAVING count(*) > 10""",
)


def anomaly_sql(order: str = "") -> str:
    return f"""SELECT campaign_name, {rounded("avg_cr * 100", 2)} AS avg_cr_pct,
        {rounded("current_cr * 100", 2)} AS current_cr_pct, {rounded("z", 2)} AS z_score,
        CASE WHEN z > 0 THEN 'HIGH' ELSE 'LOW' END AS status
      FROM (SELECT b.campaign_name, avg_cr, current_cr,
              (current_cr - avg_cr) / nullif(sd, 0) AS z
            FROM (SELECT campaign_id, campaign_name, avg(is_conversion::INT::DOUBLE) AS avg_cr,
                    stddev_samp(is_conversion::INT::DOUBLE) AS sd
                  FROM visits WHERE {since("visit_timestamp", "7 DAY")} GROUP BY 1, 2
                  HAVING count(*) > 5) b
            JOIN (SELECT campaign_id, avg(is_conversion::INT::DOUBLE) AS current_cr
                  FROM visits WHERE {since("visit_timestamp", "24 HOUR")} GROUP BY 1
                  HAVING count(*) > 2) c USING (campaign_id))
      WHERE abs(z) > 0.1 {order}"""


visits_sql("anomaly_cr", anomaly_sql())
visits_sql(
    "traffic_drops",
    f"""SELECT DISTINCT campaign_name, {rounded("usual", 0)} AS avg_hourly, current_visits,
      {pct("usual - current_visits", "usual", 1)} AS drop_pct
    FROM (SELECT campaign_id, campaign_name, extract(hour FROM h) AS hh,
            avg(c) OVER (PARTITION BY campaign_id, extract(hour FROM h)) AS usual
          FROM (SELECT campaign_id, campaign_name, date_trunc('hour', visit_timestamp) AS h,
                  count(*) AS c
                FROM visits WHERE {since("visit_timestamp", "7 DAY")} GROUP BY 1, 2, 3))
    JOIN (SELECT campaign_id, {n()} AS current_visits
          FROM visits WHERE {_H1} GROUP BY 1) USING (campaign_id)
    WHERE hh = 22 AND current_visits < usual""",
)
_TRAFFIC = f"""SELECT 'traffic_drop' AS alert_type, campaign_name,
      'Traffic dropped ' || CAST(drop_pct AS BIGINT) || '% in last hour' AS message,
      'warning' AS severity, h AS hour
    FROM (SELECT *, {pct("usual - c", "usual", 0)} AS drop_pct
          FROM (SELECT campaign_name, h, c, avg(c) OVER (PARTITION BY campaign_id) AS usual
                FROM (SELECT campaign_id, campaign_name, date_trunc('hour', visit_timestamp) AS h,
                        count(*) AS c
                      FROM visits WHERE {since("visit_timestamp", "24 HOUR")} GROUP BY 1, 2, 3))
          WHERE c < usual * 0.6::DOUBLE)"""


def _rates(order: str) -> str:
    return f"""SELECT 'cr_anomaly' AS alert_type, campaign_name,
      'CR is ' || CAST(current_cr_pct AS DECIMAL(18,2)) || '% vs avg '
        || CAST(avg_cr_pct AS DECIMAL(18,2)) || '%' AS message,
      CASE WHEN status = 'HIGH' THEN 'info' ELSE 'warning' END AS severity,
      CAST(NULL AS TIMESTAMP) AS hour
    FROM ({anomaly_sql(order)})"""


visits_sql(
    "check_alerts",
    f"""SELECT * FROM ({_TRAFFIC} ORDER BY drop_pct DESC, campaign_name, h LIMIT 10)
    UNION ALL SELECT * FROM ({_rates("ORDER BY abs(z) DESC, campaign_name LIMIT 10")})""",
)
visits_sql("stream_alerts", f"{_TRAFFIC} UNION ALL {_rates('')}")
visits_sql(
    "ml_features",
    f"""SELECT visit_id, campaign_id, {hour("visit_timestamp")} AS hour,
      {dow("visit_timestamp")} AS day_of_week,
      CAST(extract(day FROM visit_timestamp) AS INT) AS day_of_month,
      country_code, device, os, browser, connection_type,
      CAST(count(*) OVER short AS BIGINT) AS campaign_visits_1h,
      CAST(count(*) FILTER (WHERE is_conversion) OVER long AS DOUBLE)
        / nullif(CAST(count(*) OVER long AS DOUBLE), 0) AS campaign_cr_24h,
      is_conversion
    FROM visits WHERE visit_timestamp <= {AS_OF}
    WINDOW short AS (PARTITION BY campaign_id ORDER BY visit_timestamp
             RANGE BETWEEN INTERVAL '3599.999999 seconds' PRECEDING
                       AND INTERVAL '0.000001 seconds' PRECEDING),
           long AS (PARTITION BY campaign_id ORDER BY visit_timestamp
             RANGE BETWEEN INTERVAL '86399.999999 seconds' PRECEDING
                       AND INTERVAL '0.000001 seconds' PRECEDING)
    QUALIFY visit_timestamp > {AS_OF} - INTERVAL 30 DAY""",
)

# --- visits and conversions together ---------------------------------------------------------

both_sql(
    "visit_conversions",
    f"""SELECT v.click_id, v.visit_timestamp, v.campaign_id, v.campaign_name, v.country_code,
      v.device, v.os, v.browser, v.isp,
      CAST(NULL AS VARCHAR) AS custom_var_1, CAST(NULL AS VARCHAR) AS custom_var_2,
      c.postback_timestamp AS conversion_timestamp, {dbl("c.revenue")} AS revenue,
      {dbl("c.payout")} AS payout, c.offer_name, c.transaction_id,
      c.click_id IS NOT NULL AS converted
    FROM live_visits v LEFT JOIN conversions c ON v.click_id = c.click_id""",
)
both_sql(
    "flag_converted",
    """SELECT click_id, campaign_id, custom_var_3,
      click_id IN (SELECT click_id FROM conversions) AS converted FROM live_visits""",
)


def rates_sql(key: str, dims: str, span: str, more: int) -> None:
    both_sql(
        key,
        f"""SELECT {dims}, {n("DISTINCT v.click_id")} AS visits,
          {n("DISTINCT c.click_id")} AS conversions,
          {dbl("coalesce(sum(c.revenue), 0)")} AS revenue,
          {pct("count(DISTINCT c.click_id)", "count(DISTINCT v.click_id)")} AS cr
        FROM live_visits v LEFT JOIN conversions c ON v.click_id = c.click_id
        WHERE {since("v.visit_timestamp", span)} GROUP BY ALL
        HAVING count(DISTINCT v.click_id) > {more}""",
    )


rates_sql(
    "daily_campaign_performance",
    "CAST(v.visit_timestamp AS DATE) AS date, v.campaign_id, v.campaign_name",
    "30 DAY",
    0,
)
rates_sql("country_cr", "v.country_code", "7 DAY", 10)
rates_sql("device_os_cr", "v.device, v.os", "7 DAY", 10)
both_sql(
    "low_conversion_segments",
    f"""SELECT coalesce(nullif(custom_var_3, ''), 'unknown') AS var3,
      coalesce(nullif(country_code, ''), 'unknown') AS country,
      coalesce(nullif(device, ''), 'unknown') AS device, {n()} AS visits,
      {count_if("hit")} AS converted,
      CAST(count(*) FILTER (WHERE hit) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS conv_rate
    FROM (SELECT *, click_id IN (SELECT click_id FROM conversions) AS hit FROM live_visits)
    GROUP BY 1, 2, 3 HAVING count(*) >= 20""",
)
both_sql(
    "conversion_totals",
    f"""SELECT {n()} AS total_conversions, {dbl("coalesce(sum(revenue), 0)")} AS total_revenue,
      {mean("sum(revenue)", "count(*)")} AS avg_rev_per_conv,
      (SELECT {n()} FROM live_visits) AS visits_tracked FROM conversions""",
)
both_sql(
    "referential_check",
    f"""SELECT click_id, transaction_id, postback_timestamp, {dbl("revenue")} AS revenue
    FROM conversions c WHERE NOT EXISTS (
      SELECT 1 FROM live_visits v WHERE v.click_id = c.click_id)""",
)
conv_sql(
    "attribute_conversions",
    "SELECT transaction_id, click_id, postback_timestamp, visit_timestamp FROM conversions",
)
conv_sql(
    "conversion_timing",
    f"""SELECT campaign_name, CASE WHEN s < 60 THEN '< 1 min' WHEN s < 300 THEN '1-5 min'
        WHEN s < 900 THEN '5-15 min' WHEN s < 3600 THEN '15-60 min'
        WHEN s < 86400 THEN '1-24 hours' ELSE '> 24 hours' END AS time_bucket,
      {n()} AS conversions, {dbl("sum(revenue)")} AS revenue
    FROM (SELECT *, epoch(postback_timestamp - visit_timestamp) AS s FROM conversions
          WHERE visit_timestamp IS NOT NULL AND {since("postback_timestamp", "30 DAY")})
    GROUP BY 1, 2""",
)

# --- segment patterns ------------------------------------------------------------------------


def pattern_stats_sql(dims: list[str], where: str = "true", tail: str = "") -> str:
    named = ", ".join(f"coalesce(nullif({d}, ''), 'unknown') AS {d}" for d in dims)
    return f"""SELECT {named}, {n()} AS convs, {dbl("sum(revenue)")} AS revenue,
      {dbl("sum(payout)")} AS payout, {mean("sum(revenue)", "count(*)")} AS rev_per_conv,
      {dbl("sum(revenue) - sum(payout)")} AS profit
    FROM conversions WHERE {where} GROUP BY ALL HAVING count(*) >= 5 {tail}"""


for _preset, _dims in PATTERN_PRESETS.items():
    conv_sql(f"pattern_stats_{_preset}", pattern_stats_sql(_dims))
conv_sql(
    "pattern_stats_worst",
    pattern_stats_sql(
        PATTERN_PRESETS["var3_country"],
        tail="ORDER BY rev_per_conv, 1, 2 LIMIT 15",
    ),
)
conv_sql(
    "pattern_stats_of_var3",
    pattern_stats_sql(PATTERN_PRESETS["var3_device_os"], "custom_var_3 = 'v1'"),
)

_V3 = f"""SELECT custom_var_3 AS var3, {n()} AS conversions, {dbl("sum(revenue)")} AS total_revenue,
      {mean("sum(revenue)", "count(*)")} AS avg_revenue
    FROM rows GROUP BY 1 HAVING count(*) >= 50"""
_RANKED = """SELECT var3, conversions, total_revenue, avg_revenue, list,
      CAST(row_number() OVER (PARTITION BY list ORDER BY avg_revenue DESC, var3) AS INT) AS list_rank"""
sql(
    "var3_rankings",
    f""", v3 AS ({_V3}) {_RANKED} FROM (
      SELECT * FROM (SELECT *, 'top' AS list FROM v3 ORDER BY avg_revenue DESC, var3 LIMIT 3)
      UNION ALL
      SELECT * FROM (SELECT *, 'bottom' AS list FROM v3 ORDER BY avg_revenue, var3 DESC LIMIT 3))""",
    CONVERSIONS,
    CLEAN,
)
MEDIAN = "CAST(CAST(median(CAST(revenue AS DOUBLE)) AS DECIMAL(18,7)) AS DOUBLE)"
sql(
    "overall_stats",
    f""" SELECT {n()} AS conversions, {dbl("sum(revenue)")} AS total_revenue,
      {mean("sum(revenue)", "count(*)")} AS avg_revenue, {MEDIAN} AS median_revenue FROM rows""",
    CONVERSIONS,
    CLEAN,
)


def deviation(average: str, center: str) -> str:
    return f"CASE WHEN {center} > 0 THEN ({average} - {center}) / {center} * 100 ELSE 0 END"


def features_sql(features: list[str], minimum: int, source: str = "rows") -> str:
    """One grouped select per feature, against the overall median."""
    each = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS value, revenue FROM {source}" for f in features
    )
    return f""", overall AS (
      SELECT count(*) AS all_n, {MEDIAN} AS m FROM {source}),
    long AS ({each}),
    patterns AS (
      SELECT feature, value, {n()} AS count, {mean("sum(revenue)", "count(*)")} AS avg_revenue,
        {dbl("sum(revenue)")} AS total_revenue,
        100.0::DOUBLE * CAST(count(*) FILTER (WHERE CAST(revenue AS DOUBLE) > m) AS DOUBLE)
          / CAST(count(*) AS DOUBLE) AS pct_high,
        {deviation(mean("sum(revenue)", "count(*)"), "any_value(m)")} AS deviation
      FROM long, overall WHERE value IS NOT NULL AND value NOT IN ('', 'unknown')
        AND all_n >= {minimum}
      GROUP BY 1, 2 HAVING count(*) >= {minimum})"""


sql("feature_patterns", features_sql(SEGMENT_FEATURES, 20) + " SELECT * FROM patterns", CONVERSIONS, CLEAN)
sql(
    "feature_patterns_of_var3",
    ", one AS (SELECT * FROM rows WHERE custom_var_3 = 'v2')"
    + features_sql(SEGMENT_FEATURES, 20, "one")
    + " SELECT * FROM patterns",
    CONVERSIONS,
    CLEAN,
)


def pairs_sql(minimum: int) -> str:
    each = " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {a} AS value_1, {b} AS value_2, revenue "
        "FROM rows"
        for a, b in FEATURE_PAIRS
    )
    average = mean("sum(revenue)", "count(*)")
    return f""", overall AS (
      SELECT count(*) AS all_n, {MEDIAN} AS m, {average} AS mu FROM rows),
    long AS ({each}),
    patterns AS (
      SELECT feature_1, feature_2, value_1, value_2, {n()} AS count, {average} AS avg_revenue,
        100.0::DOUBLE * CAST(count(*) FILTER (WHERE CAST(revenue AS DOUBLE) > m) AS DOUBLE)
          / CAST(count(*) AS DOUBLE) AS pct_high,
        ({average} - any_value(mu)) / nullif(any_value(mu), 0) * 100 AS deviation
      FROM long, overall
      WHERE value_1 IS NOT NULL AND value_1 NOT IN ('', 'unknown')
        AND value_2 IS NOT NULL AND value_2 NOT IN ('', 'unknown') AND all_n >= {minimum}
      GROUP BY 1, 2, 3, 4
      HAVING count(*) >= {minimum}
        AND abs(({average} - any_value(mu)) / nullif(any_value(mu), 0) * 100) > 20)"""


sql("two_feature_patterns", pairs_sql(15) + " SELECT * FROM patterns", CONVERSIONS, CLEAN)


def ends_sql(group: str, ties: list[str], beyond: float, keep: int) -> str:
    up = ", ".join(ties)
    return f""" SELECT *, 'SCALE' AS action, CAST(row_number() OVER (
          PARTITION BY {group} ORDER BY avg_revenue DESC, {up}) AS INT) AS list_rank
      FROM patterns WHERE deviation > {beyond} QUALIFY list_rank <= {keep}
      UNION ALL
      SELECT *, 'BLOCK' AS action, CAST(row_number() OVER (
          PARTITION BY {group} ORDER BY avg_revenue, {up}) AS INT) AS list_rank
      FROM patterns WHERE deviation < -{beyond} QUALIFY list_rank <= {keep}"""


sql(
    "scale_block_lists",
    features_sql(SEGMENT_FEATURES, 30) + ends_sql("feature", ["value"], 20, 5),
    CONVERSIONS,
    CLEAN,
)
sql(
    "scale_block_pairs",
    pairs_sql(20) + ends_sql("feature_1, feature_2", ["value_1", "value_2"], 30, 3),
    CONVERSIONS,
    CLEAN,
)
sql(
    "isp_deep_dive",
    features_sql(["isp"], 20)
    + """ SELECT * FROM (SELECT *, 'top' AS list FROM patterns ORDER BY avg_revenue DESC, value LIMIT 10)
      UNION ALL
      SELECT * FROM (SELECT *, 'bottom' AS list FROM patterns ORDER BY avg_revenue, value DESC LIMIT 10)""",
    CONVERSIONS,
    CLEAN,
)
sql(
    "recommended_actions",
    features_sql(SEGMENT_FEATURES, 30)
    + """ SELECT * FROM (
        SELECT *, CAST(row_number() OVER (
          PARTITION BY action ORDER BY total_revenue DESC, feature, value) AS INT) AS list_rank
        FROM (SELECT *, CASE WHEN deviation > 30 THEN 'SCALE' ELSE 'BLOCK' END AS action
              FROM patterns WHERE abs(deviation) > 30)) WHERE list_rank <= 5""",
    CONVERSIONS,
    CLEAN,
)
sql(
    "var3_overview",
    f""", v3 AS ({_V3}), overall AS (
      SELECT {mean("sum(revenue)", "count(*)")} AS mu FROM rows)
    SELECT var3, conversions, total_revenue, avg_revenue,
      (avg_revenue - mu) / nullif(mu, 0) AS vs_overall_avg,
      CASE WHEN avg_revenue > mu * 1.2::DOUBLE THEN 'SCALE'
           WHEN avg_revenue < mu * 0.8::DOUBLE THEN 'BLOCK' ELSE 'OK' END AS status
    FROM v3, overall""",
    CONVERSIONS,
    CLEAN,
)
_EACH = " UNION ALL ".join(
    f"SELECT custom_var_3 AS var3, '{f}' AS feature, {f} AS value, revenue FROM rows"
    for f in CAMPAIGN_FEATURES
)
CAMPAIGN = f""", campaigns AS (
      SELECT custom_var_3 AS var3, count(*) AS all_n, {MEDIAN} AS m FROM rows GROUP BY 1
      HAVING count(*) >= 50),
    long AS ({_EACH}),
    patterns AS (
      SELECT var3, feature, value, {n()} AS conversions,
        {mean("sum(revenue)", "count(*)")} AS avg_revenue, {dbl("sum(revenue)")} AS total_revenue,
        {deviation(mean("sum(revenue)", "count(*)"), "any_value(m)")} AS deviation
      FROM long JOIN campaigns USING (var3)
      WHERE value IS NOT NULL AND value NOT IN ('', 'unknown') GROUP BY 1, 2, 3
      HAVING count(*) >= greatest(5, any_value(all_n) // 20) AND abs(deviation) > 25)"""
SHEET = """SELECT var3, CASE feature WHEN 'country_code' THEN 'Country Code' WHEN 'device' THEN 'Device'
        WHEN 'os' THEN 'Os' ELSE 'Isp' END AS dimension, value, conversions,
      avg_revenue, total_revenue, deviation / 100 AS vs_campaign_median,
      CASE WHEN deviation > 25 THEN 'SCALE' ELSE 'BLOCK' END AS action FROM patterns"""
sql("patterns_by_var3", f"{CAMPAIGN} {SHEET}", CONVERSIONS, CLEAN)
for _key, _action in (("top_scale", "SCALE"), ("top_block", "BLOCK")):
    sql(
        _key,
        f"""{CAMPAIGN} SELECT * FROM ({SHEET}) WHERE action = '{_action}'
        ORDER BY total_revenue DESC, var3, dimension, value LIMIT 50""",
        CONVERSIONS,
        CLEAN,
    )
sql("var3_insights", CAMPAIGN + ends_sql("var3, feature", ["value"], 25, 3), CONVERSIONS, CLEAN)
sql(
    "report_summary",
    f"""{CAMPAIGN} SELECT
      {n("DISTINCT custom_var_3) FILTER (WHERE custom_var_3 <> 'unknown'")} AS var3_count,
      (SELECT {n()} FROM patterns) AS pattern_count, {n()} AS total_conversions,
      {dbl("sum(revenue)")} AS total_revenue FROM rows""",
    CONVERSIONS,
    CLEAN,
)

# --- performance report and listings ---------------------------------------------------------

RATES = f"{pct('profit', 'cost')} AS roi, {pct('conversions', 'visits')} AS cr, {pct('clicks', 'visits')} AS ctr"
# The days 2024-01-23 .. 2024-01-30 of the report's zone (UTC-8 in January).
PACIFIC = (
    "visit_timestamp >= TIMESTAMP '2024-01-23 08:00:00' "
    "AND visit_timestamp < TIMESTAMP '2024-01-31 08:00:00'"
)
_LOCAL = "(visit_timestamp - INTERVAL 8 HOUR)"
_TIMES = {
    "day": f"CAST(CAST({_LOCAL} AS DATE) AS VARCHAR)",
    "hour": f"strftime(date_trunc('hour', {_LOCAL}), '%Y-%m-%d %H:%M:%S')",
    "day-of-week": f"CAST({dow(_LOCAL)} AS VARCHAR)",
}


def report_sql(key: str, label: str | None, where: str, tail: str) -> str:
    name = f"max({label})" if label else key
    return f"""groups AS (
      SELECT {key} AS dimension, {name} AS name, {SUMS} FROM visits WHERE {where} GROUP BY {key}),
    exact AS (SELECT NULL AS dimension, 'total' AS name, {SUMS} FROM visits WHERE {where})
    SELECT *, 'group' AS row_type FROM (SELECT *, {RATES} FROM groups {tail})
    UNION ALL SELECT *, {RATES}, 'total' AS row_type FROM exact"""


for _dimension, (_column, _label) in DIMENSIONS.items():
    _key = _TIMES.get(_dimension, _column)
    sql(
        f"performance_report_{_dimension.replace('-', '_')}",
        ", " + report_sql(_key, _label, PACIFIC, "ORDER BY profit DESC, dimension LIMIT 50"),
        VISITS,
    )
sql(
    "performance_report_filtered",
    ", "
    + report_sql(
        "lander_id",
        "lander_name",
        "CAST(visit_timestamp AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' "
        "AND campaign_id = 'c3' AND offer_id = 'o1'",
        "ORDER BY visits, dimension LIMIT 50",
    ),
    VISITS,
)


def days(first: str, last: str, ts: str = "visit_timestamp") -> str:
    return f"CAST({ts} AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'"


visits_sql(
    "summary",
    f"""SELECT 'Today' AS period, *, {RATES} FROM (
      SELECT {SUMS} FROM visits WHERE {days("2024-01-29", "2024-01-30")})""",
)
visits_sql(
    "top_performers",
    f"""SELECT *, {RATES} FROM (
      SELECT campaign_id AS dimension, max(campaign_name) AS name, {SUMS} FROM visits
      WHERE {days("2024-01-23", "2024-01-30")} GROUP BY 1)
    ORDER BY revenue DESC, dimension LIMIT 5""",
)
visits_sql(
    "worst_performers",
    f"""SELECT *, {RATES} FROM (
      SELECT strftime(date_trunc('hour', visit_timestamp), '%Y-%m-%d %H:%M:%S') AS dimension,
        dimension AS name, {SUMS} FROM visits
      WHERE {days("2024-01-23", "2024-01-30")} GROUP BY 1)
    WHERE profit < 0 ORDER BY profit, dimension LIMIT 10""",
)
for _kind, _parents in CATALOG_PARENTS.items():
    _id, _name = DIMENSIONS[_kind]
    _more = "".join(f", arg_max({p}, visit_timestamp) AS {p}" for p in _parents)
    visits_sql(
        f"catalog_{_kind.replace('-', '_')}",
        f"""SELECT {_id} AS id, arg_max({_name}, visit_timestamp) AS name{_more}
        FROM visits GROUP BY 1""",
    )
conv_sql(
    "conversion_listing",
    f"""SELECT transaction_id, click_id, postback_timestamp, visit_timestamp, campaign_name,
      offer_name, {dbl("revenue")} AS revenue
    FROM conversions WHERE {days("2024-01-27", "2024-01-30", "postback_timestamp")}
      AND campaign_id = 'c3' ORDER BY postback_timestamp DESC, transaction_id LIMIT 100""",
)
sql(
    "click_listing",
    f""" SELECT click_id, click_timestamp, campaign_name, offer_name, lander_name, country_code,
      device, os, browser
    FROM live_clicks WHERE {days("2024-01-27", "2024-01-30", "click_timestamp")}
      AND campaign_id = 'c3' ORDER BY click_timestamp DESC, click_id LIMIT 100""",
    LIVE,
)
# The rendering wraps the report: names in bold, then every metric with its label.
_MONEY = "'$' || format('{{:,.2f}}', {0})"
_WHOLE = "format('{{:,}}', {0})"
_LINE = " || ' | ' || ".join(
    f"'{label}: ' || {text}"
    for label, text in [
        ("Visits", _WHOLE.format("visits")),
        ("Clicks", _WHOLE.format("clicks")),
        ("Conv", _WHOLE.format("conversions")),
        ("Rev", _MONEY.format("revenue")),
        ("Cost", _MONEY.format("cost")),
        ("Profit", _MONEY.format("profit")),
        ("ROI", "CAST(CAST(CAST(roi AS DECIMAL(18,2)) AS DECIMAL(18,1)) AS VARCHAR) || '%'"),
        ("CR", "CAST(CAST(cr AS DECIMAL(18,2)) AS VARCHAR) || '%'"),
        ("CTR", "CAST(CAST(ctr AS DECIMAL(18,2)) AS VARCHAR) || '%'"),
    ]
)
sql(
    "format_report_row",
    ", report AS (WITH "
    + report_sql(
        "campaign_id",
        "campaign_name",
        days("2024-01-23", "2024-01-30"),
        "ORDER BY profit DESC, dimension LIMIT 50",
    )
    + f") SELECT dimension, '**' || name || '**' AS title, {_LINE} AS metrics FROM report",
    VISITS,
)

# --- decision trees --------------------------------------------------------------------------

TREE_ROWS = (
    "rows AS (SELECT * REPLACE ("
    + ", ".join(f"coalesce({c}, 'unknown') AS {c}" for c in ["custom_var_3", *TREE_FEATURES])
    + ") FROM conversions)"
)
MEDIANS = f"""medians AS (
  SELECT custom_var_3 AS var3, count(*) AS all_n, {MEDIAN} AS m FROM rows GROUP BY 1)"""
sql(
    "high_revenue_label",
    f""" SELECT transaction_id, var3, {dbl("revenue")} AS revenue, m AS median_revenue,
      CAST({dbl("revenue")} > m AS INT) AS high_revenue
    FROM rows JOIN medians ON custom_var_3 = var3""",
    CONVERSIONS,
    TREE_ROWS,
    MEDIANS,
)
_UNPIVOT = " UNION ALL ".join(
    f"SELECT custom_var_3 AS var3, '{f}' AS feature, {f} AS value FROM rows" for f in TREE_FEATURES
)
sql(
    "label_encode",
    f""" SELECT var3, feature, value, {n()} AS conversions,
      CAST(dense_rank() OVER (PARTITION BY var3, feature ORDER BY value) - 1 AS INT) AS code
    FROM ({_UNPIVOT}) GROUP BY 1, 2, 3""",
    CONVERSIONS,
    TREE_ROWS,
)


def gini(h: str, size: str) -> str:
    return f"(2.0::DOUBLE * ({h}) * (({size}) - ({h})) / ({size}))"


def grow_parts(keys: str, depth: int = 4) -> list[str]:
    """The levels below ``at0``: every node's best split, then where every conversion goes."""
    picked = "CASE b.feature " + " ".join(f"WHEN '{f}' THEN a.{f}" for f in TREE_FEATURES) + " END"
    same = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in f"{keys}, node".split(","))
    gain = f"{gini('hh', 'nn')} - {gini('hl', 'nl')} - {gini('hh - hl', 'nn - nl')}"
    parts = []
    for level in range(depth):
        each = " UNION ALL ".join(
            f"SELECT {keys}, node, '{f}' AS feature, {f} AS value, h FROM at{level} "
            f"WHERE training AND node >= {2**level}"
            for f in TREE_FEATURES
        )
        parts.append(
            f"""split{level} AS MATERIALIZED (
      SELECT *, {gain} AS gain FROM (
        SELECT {keys}, node, feature, value,
          CAST(sum(n) OVER run AS BIGINT) AS nl, CAST(sum(h) OVER run AS BIGINT) AS hl,
          CAST(sum(n) OVER al AS BIGINT) AS nn, CAST(sum(h) OVER al AS BIGINT) AS hh,
          lead(value) OVER run AS next_value
        FROM (SELECT {keys}, node, feature, value, count(*) AS n, sum(h) AS h FROM ({each}) GROUP BY ALL)
        WINDOW run AS (PARTITION BY {keys}, node, feature ORDER BY value),
               al AS (PARTITION BY {keys}, node, feature))
      WHERE nl >= 10 AND nn - nl >= 10 AND nn >= 20 AND hh > 0 AND hh < nn AND {gain} > 1e-9
      QUALIFY row_number() OVER (PARTITION BY {keys}, node
        ORDER BY CAST({gain} AS DECIMAL(30,9)) DESC, feature, value) = 1)"""
        )
        parts.append(
            f"""at{level + 1} AS MATERIALIZED (
      SELECT a.* REPLACE (CASE WHEN b.feature IS NULL THEN a.node
          WHEN {picked} <= b.value THEN a.node * 2 ELSE a.node * 2 + 1 END AS node)
      FROM at{level} a LEFT JOIN split{level} b ON {same})"""
        )
    return parts


def tree_parts(depth: int = 4) -> list[str]:
    """One tree per campaign, with its splits and leaves."""
    start = f"""at0 AS MATERIALIZED (
      SELECT var3, {", ".join(TREE_FEATURES)}, CAST({dbl("revenue")} > m AS INT) AS h, 1 AS node,
        true AS training
      FROM rows JOIN medians ON custom_var_3 = var3 WHERE all_n >= 50)"""
    splits = " UNION ALL ".join(f"SELECT * FROM split{level}" for level in range(depth))
    leaves = f"""leaves AS MATERIALIZED (
      SELECT var3, node, {n()} AS samples, CAST(sum(h) AS BIGINT) AS high_count
      FROM at{depth} GROUP BY 1, 2)"""
    return [start, *grow_parts("var3", depth), f"splits AS MATERIALIZED ({splits})", leaves]


def folds_part() -> str:
    """Every conversion once per held-out fold: for testing in its own, for training elsewhere."""
    return f"""at0 AS MATERIALIZED (
      SELECT *, CAST(fold <> held_out AS BOOLEAN) AS training FROM (
        SELECT *, unnest(range(folds)) AS held_out FROM (
          SELECT *, (row_number() OVER (PARTITION BY var3, h
              ORDER BY postback_timestamp NULLS FIRST, transaction_id) - 1) % folds AS fold
          FROM (SELECT var3, {", ".join(TREE_FEATURES)}, postback_timestamp, transaction_id,
                  CAST({dbl("revenue")} > m AS INT) AS h, 1 AS node,
                  CAST(least(5, all_n // 10 + 1) AS INT) AS folds
                FROM rows JOIN medians ON custom_var_3 = var3 WHERE all_n >= 50))))"""


TREE = [CONVERSIONS, TREE_ROWS, MEDIANS, *tree_parts()]
sql(
    "segment_tree",
    """ SELECT var3, node, nn AS samples, hh AS high_count, feature, value AS split_value, gain,
      false AS is_leaf FROM splits
    UNION ALL
    SELECT var3, node, samples, high_count, NULL, NULL, NULL, true FROM leaves""",
    *TREE,
)
_LIST = ", ".join(f"'{f}'" for f in TREE_FEATURES)
sql(
    "feature_importance",
    f""" SELECT var3, feature, importance, CAST(row_number() OVER (
        PARTITION BY var3 ORDER BY importance DESC, feature) AS INT) AS feature_rank
    FROM (SELECT c.var3, c.feature, CAST(round(CAST(coalesce(g.gain
            / nullif(sum(g.gain) OVER (PARTITION BY c.var3), 0), 0) AS DECIMAL(20,9)), 6) AS DOUBLE)
            AS importance
          FROM (SELECT var3, unnest([{_LIST}]) AS feature FROM medians WHERE all_n >= 50) c
          LEFT JOIN (SELECT var3, feature, sum(gain) AS gain FROM splits GROUP BY 1, 2) g
            USING (var3, feature))""",
    *TREE,
)
sql(
    "segment_rules",
    f""", classes AS (
      SELECT var3, feature, list(DISTINCT value ORDER BY value) AS vals
      FROM ({_UNPIVOT}) GROUP BY 1, 2),
    cuts AS (
      SELECT var3, node, feature, vals,
        (list_position(vals, value) - 1 + list_position(vals, next_value) - 1) // 2 + 1 AS kept
      FROM splits JOIN classes USING (var3, feature)),
    sides AS (
      SELECT var3, node * 2 AS child, feature, vals[1:kept] AS side FROM cuts
      UNION ALL SELECT var3, node * 2 + 1, feature, vals[kept + 1:] FROM cuts),
    conditions AS (
      SELECT var3, child, feature || ' IN (' || array_to_string(side[1:3], ', ')
        || CASE WHEN len(side) > 3 THEN '...' ELSE '' END || ')' AS condition FROM sides),
    paths AS (
      SELECT var3, node, samples, high_count, unnest([node, node // 2, node // 4, node // 8]) AS child
      FROM leaves WHERE samples >= 10),
    rules AS (
      SELECT p.var3, p.node, string_agg(condition, ' AND ' ORDER BY p.child) AS rule,
        100.0::DOUBLE * CAST(high_count AS DOUBLE) / CAST(samples AS DOUBLE) AS high_pct,
        samples, high_count
      FROM paths p JOIN conditions c ON p.var3 = c.var3 AND p.child = c.child
      GROUP BY p.var3, p.node, samples, high_count)
    SELECT * FROM (
      SELECT var3, CASE WHEN high_pct > 60 THEN 'GOOD' ELSE 'BAD' END AS type, rule, high_pct, samples,
        high_count, samples - high_count AS low_count,
        CAST(row_number() OVER (PARTITION BY var3, high_pct > 60 ORDER BY
          CASE WHEN high_pct > 60 THEN -high_pct ELSE high_pct END, samples DESC, rule) AS INT)
          AS rule_rank
      FROM rules WHERE high_pct > 60 OR high_pct < 40) WHERE rule_rank <= 5""",
    *TREE,
)
sql(
    "tree_cv_accuracy",
    """ SELECT var3, CAST(count(*) AS INT) AS folds,
      CAST(round(CAST(avg(accuracy) AS DECIMAL(20,9)), 6) AS DOUBLE) AS cv_accuracy
    FROM (SELECT var3, held_out,
            avg(CAST((h = 1) = says_high AS INT)::DOUBLE) FILTER (WHERE NOT training) AS accuracy
          FROM at4 JOIN (SELECT var3, held_out, node, sum(h) * 2 > count(*) AS says_high
                         FROM at4 WHERE training GROUP BY 1, 2, 3) USING (var3, held_out, node)
          GROUP BY 1, 2)
    GROUP BY 1""",
    CONVERSIONS,
    TREE_ROWS,
    MEDIANS,
    folds_part(),
    *grow_parts("var3, held_out"),
)
_ML = """SELECT custom_var_3 AS var3, count(*) AS n, sum(revenue) AS r,
    CAST(sum(revenue) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mu
  FROM rows GROUP BY 1 HAVING count(*) >= 50"""
_ONE = "var3, CAST(1 AS BIGINT) AS campaigns, CAST(n AS BIGINT) AS conversions, CAST(r AS DOUBLE) AS total_revenue, mu AS avg_revenue FROM ml"
sql(
    "ml_summary",
    f""", ml AS ({_ML}) SELECT 'total' AS section, NULL AS var3, {n()} AS campaigns,
      CAST(sum(n) AS BIGINT) AS conversions, {dbl("sum(r)")} AS total_revenue,
      {dbl("sum(r)")} / {dbl("sum(n)")} AS avg_revenue FROM ml
    UNION ALL SELECT * FROM (SELECT 'top', {_ONE} ORDER BY mu DESC, var3 LIMIT 5)
    UNION ALL SELECT * FROM (SELECT 'bottom', {_ONE} ORDER BY mu, var3 DESC LIMIT 5)""",
    CONVERSIONS,
    CLEAN,
)

# --- ingest ----------------------------------------------------------------------------------


def stored_sql(table: str, fields, times, amounts=()) -> str:
    """What a normalised feed must hold: known columns, NULL for keys the feed does not carry."""
    known = {"click_id", "transaction_id", *ATTRIBUTES}
    columns = [c if c in known else f"CAST(NULL AS VARCHAR) AS {c}" for _, c in fields]
    columns += [c for _, c in times] + [f"{dbl(c)} AS {c}" for c in amounts]
    columns += [f"CAST(NULL AS VARCHAR) AS {c}_raw" for _, c in times]
    columns += [f"CAST(NULL AS VARCHAR) AS {c}_raw" for c in amounts]
    return f"SELECT {', '.join(columns)} FROM {table}"


sql("normalize_visits", " " + stored_sql("live_visits", schemas.VISIT_FIELDS, schemas.VISIT_TIMES), LIVE)
sql("normalize_clicks", " " + stored_sql("live_clicks", schemas.CLICK_FIELDS, schemas.CLICK_TIMES), LIVE)
ODD_AMOUNT = "CAST(transaction_id AS BIGINT) % 7"
ODD_REVENUE = f"""CASE {ODD_AMOUNT} WHEN 0 THEN 0.01 WHEN 1 THEN 999999.99 WHEN 2 THEN 1500000
  WHEN 3 THEN 1000000000 WHEN 4 THEN 0 WHEN 5 THEN 0 ELSE revenue END"""
conv_sql(
    "normalize_conversions",
    f"""SELECT * REPLACE ({dbl(ODD_REVENUE)} AS revenue,
      CASE WHEN {ODD_AMOUNT} = 4 THEN 'n/a' END AS revenue_raw) FROM ("""
    + stored_sql(
        "conversions",
        schemas.CONVERSION_FIELDS,
        schemas.CONVERSION_TIMES,
        schemas.CONVERSION_MONEY,
    )
    + ")",
)
visits_sql(
    "normalize_visits_fallback",
    f"""SELECT CASE WHEN CAST(visit_id AS BIGINT) % 2 = 0 THEN 'visit-' || visit_id
        ELSE click_id END AS visit_id, click_id, campaign_id, visit_timestamp, country_code,
      device AS device_type, custom_var_3, {dbl("revenue")} AS revenue, {dbl("cost")} AS cost,
      0.0::DOUBLE AS profit, is_click, is_conversion FROM visits""",
)
_TURN = "CAST(transaction_id AS BIGINT) % 4"
conv_sql(
    "normalize_conversions_fallback",
    f"""SELECT conversion_id, click_id, campaign_id, conversion_timestamp, visit_timestamp,
      date_diff('microsecond', visit_timestamp, conversion_timestamp) / 1000000.0::DOUBLE
        AS time_to_convert_s,
      country_code, {dbl("revenue")} AS revenue, 0.0::DOUBLE AS payout, transaction_id, conversion_type
    FROM (SELECT *, CASE WHEN {_TURN} < 2 THEN transaction_id ELSE click_id END AS conversion_id,
            CASE WHEN {_TURN} < 3 THEN postback_timestamp
                 ELSE coalesce(visit_timestamp, TIMESTAMP '2024-01-30 21:40:00') END
              AS conversion_timestamp FROM conversions)""",
)
ORACLE["parse_event_ts"] = """SELECT event_id,
  CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ts
    WHEN 2 THEN ts - INTERVAL '5 hours 30 minutes' END AS parsed,
  CASE WHEN event_id % 5 = 3 THEN 'bad ' || event_id END AS unread FROM events"""


def dedupe_sql(key: str, table: str, ident: str, moved: str, out: str, keys: str) -> None:
    """Originals, later copies and rows without an id, then the first of each key."""
    first = f"CAST({ident} AS BIGINT)"
    sql(
        key,
        f""" SELECT {out}, ingest_seq FROM (
          SELECT *, {first} AS ingest_seq FROM {table}
          UNION ALL SELECT * REPLACE ('copy' AS {moved}), {first} + 1000000000 FROM {table}
          UNION ALL SELECT * REPLACE ('' AS click_id), 0 FROM {table})
        WHERE click_id <> ''
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ingest_seq) = 1""",
        LIVE,
        CONVERSIONS,
    )


dedupe_sql("dedupe_visits", "live_visits", "click_id", "device", "click_id, device, campaign_id", "click_id")
dedupe_sql("dedupe_clicks", "live_clicks", "click_id", "os", "click_id, os, campaign_id", "click_id")
dedupe_sql(
    "dedupe_conversions",
    "conversions",
    "transaction_id",
    "device",
    "click_id, postback_timestamp, device",
    "click_id, postback_timestamp",
)
conv_sql(
    "dedupe_conversions_v1",
    """SELECT click_id AS conversion_id, transaction_id, CAST(transaction_id AS BIGINT) AS ingest_seq
    FROM conversions QUALIFY row_number() OVER (PARTITION BY click_id ORDER BY ingest_seq) = 1""",
)
conv_sql(
    "upsert",
    f"""SELECT transaction_id, click_id, postback_timestamp,
      CASE WHEN postback_timestamp <= TIMESTAMP '2024-01-20' THEN device END AS device,
      {dbl("revenue")} * CASE WHEN postback_timestamp > TIMESTAMP '2024-01-15' THEN 2 ELSE 1 END
        AS revenue FROM conversions""",
)
_TRACKED = f"""SELECT campaign_id, max(campaign_name) AS campaign_name, {n()} AS visits FROM visits
    WHERE visit_timestamp >= TIMESTAMP '2024-01-29' AND visit_timestamp < TIMESTAMP '2024-01-30 23:00:00'
    GROUP BY 1"""
visits_sql("tracked_campaigns", _TRACKED)
visits_sql("tracked_campaigns_filtered", _TRACKED + " HAVING max(campaign_name) LIKE '%paign 3%'")
visits_sql(
    "sync_window",
    """SELECT visit_id, campaign_id, visit_timestamp FROM visits
    WHERE visit_timestamp >= TIMESTAMP '2024-01-29 21:00:00'
      AND visit_timestamp < TIMESTAMP '2024-01-30 21:00:00'""",
)
visits_sql(
    "backfill",
    f"""SELECT CAST(least(date_diff('hour', visit_timestamp, TIMESTAMP '2024-01-30 20:00:00')
          // (7 * 24), 4) AS INT) AS chunk, {n()} AS visits, {dbl("sum(revenue)")} AS revenue
    FROM (SELECT * REPLACE (date_trunc('hour', visit_timestamp) AS visit_timestamp) FROM visits)
    WHERE visit_timestamp >= TIMESTAMP '2024-01-30 21:00:00' - INTERVAL 30 DAY
      AND visit_timestamp < TIMESTAMP '2024-01-30 21:00:00' GROUP BY 1""",
)
visits_sql(
    "campaign_snapshot",
    f"""SELECT campaign_id || '_2024-01-29T21:00:00_0' AS visit_id, campaign_id,
      arg_max(campaign_name, visit_timestamp) AS campaign_name,
      arg_max(traffic_source_id, visit_timestamp) AS traffic_source_id,
      arg_max(traffic_source_name, visit_timestamp) AS traffic_source_name,
      TIMESTAMP '2024-01-29 21:00:00' AS visit_timestamp, {dbl("sum(cost)")} AS cost,
      {dbl("sum(revenue)")} AS revenue, {dbl("sum(profit)")} AS profit,
      bool_or(is_conversion) AS is_conversion
    FROM visits WHERE visits.visit_timestamp >= TIMESTAMP '2024-01-29 21:00:00'
      AND visits.visit_timestamp < TIMESTAMP '2024-01-30 21:00:00' GROUP BY campaign_id""",
)
_CUT = f"({AS_OF} - INTERVAL 10 DAY)"
both_sql(
    "retention_cleanup",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {count_if(f'{ts} < {_CUT}')} AS deleted, "
        f"{count_if(f'{ts} >= {_CUT} OR {ts} IS NULL')} AS kept FROM {table}"
        for table, ts in [
            ("live_visits", "visit_timestamp"),
            ("live_clicks", "click_timestamp"),
            ("conversions", "postback_timestamp"),
        ]
    ),
)
conv_sql(
    "retention_keep",
    f"""SELECT transaction_id, visit_timestamp FROM conversions
    WHERE visit_timestamp IS NULL OR visit_timestamp >= {_CUT}""",
)
conv_sql(
    "scan_projected",
    f"""SELECT click_id, {dbl("revenue")} AS revenue, {dbl("payout")} AS payout, custom_var_3,
      country_code, device, os, browser, isp, connection_type, postback_timestamp
    FROM conversions WHERE postback_timestamp >= {_CUT}""",
)
sql(
    "clean_conversions",
    f""" SELECT transaction_id, custom_var_3,
      {dbl(ODD_REVENUE)} AS revenue,
      {", ".join(TREE_FEATURES)} FROM rows""",
    CONVERSIONS,
    TREE_ROWS,
)

# --- streaming: the batch answer -------------------------------------------------------------

sql("stream_ingest", f" SELECT click_id, visit_timestamp, {ATTRS} FROM live_visits", LIVE)
sql("stream_dedupe", f" SELECT click_id, visit_timestamp, {ATTRS} FROM live_visits", LIVE)
visits_sql("stream_hourly_rollup", rollup_sql("true"))
both_sql(
    "stream_visit_conversions",
    f"""SELECT v.click_id, v.visit_timestamp, v.campaign_id,
      c.postback_timestamp AS conversion_timestamp, {dbl("c.revenue")} AS revenue, c.transaction_id,
      c.click_id IS NOT NULL AS converted
    FROM live_visits v LEFT JOIN conversions c ON v.click_id = c.click_id
      AND c.postback_timestamp BETWEEN v.visit_timestamp AND v.visit_timestamp + INTERVAL 2 DAY""",
)

# --- sync cycles and report files --------------------------------------------------------------

visits_sql("cycle_rollup", rollup_sql("true"))
both_sql(
    "sync_cycle_state",
    """SELECT cycle, feed, CASE feed WHEN 'live_visits' THEN (
          SELECT count(*) FROM live_visits WHERE cycle >= 2 OR CAST(click_id AS BIGINT) % 2 = 0)
        ELSE (SELECT count(*) FROM (SELECT DISTINCT click_id, postback_timestamp FROM conversions
          WHERE postback_timestamp >= TIMESTAMP '2024-01-15 21:00:00' AND CASE WHEN cycle >= 2
            THEN postback_timestamp < TIMESTAMP '2024-01-30 21:00:00'
            ELSE postback_timestamp < TIMESTAMP '2024-01-20 21:00:00' AND CAST(transaction_id AS BIGINT) % 2 = 0 END)) END AS stored_rows,
      CAST(cycle + 1 AS BIGINT) AS loads,
      CASE WHEN cycle >= 2 THEN TIMESTAMP '2024-01-30 21:40:00' ELSE TIMESTAMP '2024-01-20 21:40:00' END AS last_sync_timestamp
    FROM (SELECT CAST(unnest(range(4)) AS INT) AS cycle), (SELECT unnest(['live_visits', 'conversions']) AS feed)""",
)
conv_sql(
    "report_files",
    f"""SELECT campaign_id, country_code, {n()} AS conversions, {dbl("sum(revenue)")} AS revenue,
      max(postback_timestamp) AS latest, format
    FROM conversions, (SELECT unnest(['parquet', 'csv', 'json']) AS format) GROUP BY campaign_id, country_code, format""",
)
