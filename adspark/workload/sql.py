"""The same views as :mod:`adspark.workload.tables`, in plain SQL for the reference engine."""

from __future__ import annotations

import re

W0, W1, WA = ("TIMESTAMP '2024-01-08 00:00:00'", "TIMESTAMP '2024-01-14 23:59:59'",
              "TIMESTAMP '2024-01-21 23:59:59'")
USAGE0, PAGE0 = "TIMESTAMP '2023-12-08 00:00:00'", "TIMESTAMP '2024-01-01 00:00:00'"
D0 = "TIMESTAMP '2024-01-01 00:00:00'"
SELLERS = "('86','88','1','256027','237147','escg8-6k2bc','amgyk-mxvjr')"

VIEWS = {
    "markets": """
        SELECT c.c_custkey AS device_id, c.c_name AS source_id, c.c_mktsegment AS segment, r.r_name AS country
        FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN region r ON r.r_regionkey = n.n_regionkey""",
    # Some devices have two source ids, some source ids no device.
    "ids": """
        SELECT c_name AS source_id, CASE WHEN c_custkey % 5 = 1 THEN c_custkey - 1 ELSE c_custkey END AS device_id
        FROM customer WHERE c_custkey % 17 <> 0""",
    "ev": """
        SELECT e.ts, e.user_id AS device_id, e.event_type, e.value, m.source_id, m.country,
               CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k, date_trunc('hour', e.ts) AS partition_time
        FROM events e JOIN markets m ON m.device_id = e.user_id""",
    "log": """
        SELECT CASE event_type WHEN 'click' THEN 'click' WHEN 'signup' THEN 'segment' ELSE 'impression' END AS event,
               ts AS event_time, device_id, source_id, CAST(k AS VARCHAR) AS ip, k % 25 AS campaign_id,
               k % 50 AS flight_id, k AS creative_id, CASE WHEN event_type = 'signup' THEN k % 2 END AS segment_id,
               CAST(NULL AS VARCHAR) AS tracker, country, CASE WHEN event_type = 'error' THEN TRUE END AS dropped,
               CASE WHEN k % 2 = 0 THEN 6 ELSE 1 END AS exchange_id, CAST(k AS VARCHAR) AS seller_id, partition_time
        FROM ev WHERE event_type <> 'purchase'
        UNION ALL
        SELECT 'tracker', ts, device_id, source_id, CAST(k AS VARCHAR), k % 25, k % 50, k, NULL,
               CASE k % 5 WHEN 0 THEN 'start' WHEN 1 THEN 'first_quartile' WHEN 2 THEN 'midpoint'
                          WHEN 3 THEN 'third_quartile' ELSE 'complete' END,
               country, NULL, CASE WHEN k % 2 = 0 THEN 6 ELSE 1 END, CAST(k AS VARCHAR), partition_time
        FROM ev WHERE event_type = 'view'""",
    "sessions": """
        SELECT e.source_id, i.device_id, CAST(e.k AS VARCHAR) AS app_id, e.country, e.ts AS start_time,
               e.ts + to_seconds(CAST(round(e.value * 60) AS BIGINT)) AS end_time, e.partition_time
        FROM ev e LEFT JOIN ids i ON i.source_id = e.source_id WHERE e.event_type = 'purchase'""",
    "hardware": f"""
        SELECT i.device_id, m.source_id, m.country, {D0} + to_days(CAST(m.device_id % 30 AS INTEGER)) AS partition_time
        FROM markets m JOIN ids i ON i.source_id = m.source_id""",
    "apps": """
        SELECT 'app_' || (p_size % 2) AS product_name, CAST(p_partkey AS VARCHAR) AS app_id FROM part""",
    "mapping": f"""
        SELECT s.s_name AS advertiser_name, s.s_suppkey AS advertiser_id, r.r_name AS target_country,
               1000 + p_partkey % 25 AS order_number, 'order, ' || (p_partkey % 25) AS order_name,
               p_partkey % 25 AS campaign_id, 'campaign, ' || (p_partkey % 25) AS campaign_name,
               p_partkey % 50 AS flight_id, 'flight ' || (p_partkey % 50) AS flight_name,
               {D0} + to_days(CAST(p_partkey % 15 AS INTEGER)) AS line_item_start,
               {D0} + to_days(CAST(p_partkey % 15 + 14 AS INTEGER)) AS line_item_end,
               p_partkey AS line_item_id, p_brand AS line_item_name, p_partkey AS creative_id,
               p_name AS creative_name, CASE WHEN p_size % 2 = 0 THEN 'CPM' ELSE 'Flat Rate' END AS rate_type,
               p_retailprice / 100 AS rate, p_retailprice AS booked_budget,
               CAST(p_size * 1000 AS BIGINT) AS booked_impressions,
               DATE '2024-01-01' AS campaign_start, DATE '2024-01-31' AS campaign_end
        FROM part JOIN region r ON r.r_regionkey = p_partkey % 5 JOIN supplier s ON s.s_suppkey = p_partkey % 10""",
    "cmap": """
        SELECT DISTINCT target_country, campaign_id, replace(campaign_name, ',', ' ') AS campaign_name, flight_id,
               creative_id, replace(creative_name, ',', ' ') AS creative_name, line_item_id AS placement_id,
               replace(line_item_name, ',', ' ') AS placement_name, line_item_start, line_item_end, rate_type, rate,
               booked_impressions, booked_budget
        FROM mapping
        WHERE CAST(line_item_start AS DATE) <= DATE '2024-01-14' AND CAST(line_item_end AS DATE) >= DATE '2024-01-08'""",
    "qualifier": f"""
        SELECT COALESCE(bool_or(seller_id IN {SELLERS}), FALSE) AS known_seller,
               CASE WHEN COALESCE(bool_or(seller_id IN {SELLERS}), FALSE) THEN {W0}
                    ELSE {W0} - INTERVAL 30 DAY END AS universe_start
        FROM log WHERE partition_time BETWEEN {W0} AND {W1} AND event = 'impression'
          AND campaign_id IN (SELECT campaign_id FROM cmap)""",
    "uni": f"""
        SELECT country, device_id FROM hardware
        WHERE partition_time BETWEEN (SELECT universe_start FROM qualifier) AND {W1}
        UNION
        SELECT country, device_id FROM log
        WHERE partition_time BETWEEN (SELECT universe_start FROM qualifier) AND {W1} AND event = 'impression'
          AND dropped IS NULL AND (exchange_id = 6 OR seller_id = '86')
        UNION
        SELECT country, device_id FROM sessions
        WHERE device_id IS NOT NULL AND partition_time BETWEEN (SELECT universe_start FROM qualifier) AND {W1}""",
    "shown": f"""
        SELECT l.device_id, l.country, l.event_time AS exposure_time, l.campaign_id, l.flight_id, l.creative_id, l.event
        FROM log l JOIN uni u ON u.device_id = l.device_id AND u.country = l.country
        WHERE l.partition_time BETWEEN {W0} AND {W1} AND l.event IN ('impression', 'click') AND l.dropped IS NULL
          AND EXISTS (SELECT 1 FROM cmap c WHERE c.campaign_id = l.campaign_id AND c.creative_id = l.creative_id)""",
    "usage": f"""
        SELECT device_id, source_id, country, start_time AS usage_time,
               CAST(SUM(datediff('minute', start_time, end_time)) AS BIGINT) AS minutes
        FROM sessions
        WHERE app_id IN (SELECT app_id FROM apps WHERE product_name = 'app_0')
          AND datediff('second', start_time, end_time) >= 60
          AND partition_time BETWEEN {USAGE0} AND {WA}
        GROUP BY ALL""",
    "used": """
        SELECT * FROM usage WHERE usage_time >= (SELECT MIN(line_item_start) FROM cmap)""",
    "first": f"""
        SELECT u.device_id, u.source_id, u.country, MIN(u.usage_time) AS first_open
        FROM usage u JOIN uni ON uni.device_id = u.device_id AND uni.country = u.country
        GROUP BY ALL HAVING MIN(u.usage_time) BETWEEN {W0} AND {WA}""",
    "ips": f"""
        SELECT ip, device_id FROM (
            SELECT ip, device_id, row_number() OVER (PARTITION BY ip ORDER BY event_time DESC, device_id) AS rn
            FROM log WHERE event = 'impression' AND dropped IS NULL AND partition_time BETWEEN {W0} AND {WA}
              AND device_id IN (SELECT device_id FROM ids))
        WHERE rn = 1""",
    "visits": f"""
        SELECT i.device_id, l.country, l.segment_id, l.event_time AS visit_time
        FROM log l JOIN ips i ON i.ip = l.ip
        JOIN uni u ON u.device_id = i.device_id AND u.country = l.country
        WHERE l.event = 'segment' AND l.partition_time BETWEEN {PAGE0} AND {WA}""",
    "first_visits": f"""
        SELECT device_id, country, segment_id, MIN(visit_time) AS visit_time FROM visits
        GROUP BY ALL HAVING MIN(visit_time) BETWEEN {W0} AND {WA}""",
    "pixels": f"""
        SELECT device_id, country, segment_id, event_time AS visit_time FROM log
        WHERE event = 'segment' AND dropped IS NULL AND partition_time BETWEEN {PAGE0} AND {WA}""",
    # Every exposure before every usage within seven calendar days.
    "pairs": """
        SELECT s.*, u.usage_time, u.minutes, u.source_id FROM shown s JOIN used u
        ON u.device_id = s.device_id AND u.country = s.country AND s.exposure_time <= u.usage_time
        AND datediff('day', s.exposure_time, u.usage_time) <= 7""",
    "first_pairs": """
        SELECT s.*, f.first_open FROM shown s JOIN first f
        ON f.device_id = s.device_id AND f.country = s.country AND s.exposure_time <= f.first_open
        AND datediff('day', s.exposure_time, f.first_open) <= 7""",
    "media": f"""
        SELECT device_id, event_time AS exposure_time,
               CASE creative_id % 3 WHEN 0 THEN 'native' WHEN 1 THEN 'ctv' ELSE 'stvp' END AS media
        FROM log WHERE event = 'impression' AND dropped IS NULL AND partition_time BETWEEN {W0} AND {W1}""",
    # Subscriber lift.
    "subs": """
        SELECT DISTINCT device_id FROM customer LEFT JOIN ids ON source_id = c_name WHERE c_mktsegment = 'MACHINERY'""",
    "imps": f"""
        SELECT l.country, l.device_id, 1000 + l.campaign_id AS order_number, l.campaign_id, l.flight_id, l.creative_id,
               m.line_item_name, CAST(l.event_time AS DATE) AS day, COUNT(*) AS imps
        FROM log l JOIN mapping m ON m.campaign_id = l.campaign_id AND m.flight_id = l.flight_id
             AND m.creative_id = l.creative_id
        WHERE l.event = 'impression' AND l.partition_time BETWEEN {W0} AND {WA}
        GROUP BY ALL""",
    "hours": f"""
        SELECT s.country, s.device_id, s.start_time AS usage_time, COUNT(*) AS opens,
               CAST(SUM(datediff('hour', s.start_time, s.end_time)) AS BIGINT) AS hours
        FROM sessions s JOIN uni u ON u.device_id = s.device_id AND u.country = s.country
        WHERE s.app_id IN (SELECT app_id FROM apps WHERE product_name = 'app_0')
          AND datediff('second', s.start_time, s.end_time) >= 60 AND s.partition_time BETWEEN {W0} AND {WA}
        GROUP BY ALL""",
    "matched": """
        SELECT h.* FROM hours h WHERE h.device_id IN (SELECT device_id FROM subs)""",
    "uni_size": """
        SELECT country, COUNT(DISTINCT device_id) AS total_universe FROM uni GROUP BY country""",
}

def _needs(name: str) -> list[str]:
    """Which views a view reads, found from its text."""
    words = set(re.findall(r"\w+", VIEWS[name]))
    return [v for v in VIEWS if v != name and v in words]


def with_views(query: str, *names: str) -> str:
    """``query`` preceded by the views it names and those they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _needs(name):
            if need not in order:
                add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f'"{n}" AS ({VIEWS[n]})' for n in order) + "\n" + query
