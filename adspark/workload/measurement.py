"""Universe, delivery, conversions, attribution, money, lift and audiences."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from adspark.operators.relational import in_rel
from adspark.plans import attribution, audience, conversions, delivery, finance, identity, lift, lookback, mapping, reach
from adspark.plans.reports import KEYS, TIME_LABELS, TIME_THRESHOLDS, universe_of
from adspark.schemas import schema
from adspark.sinks import export_csv
from adspark.sources import read_csv
from adspark.stage import work_dir
from adspark.workload.registry import once, query
from adspark.workload.sql import W0, W1, WA
from adspark.workload.tables import PARAMS as P, Source

IDS = ["campaign_id", "creative_id"]


@once
def cmap(s: Source) -> DataFrame:
    return mapping.creative_map(s.mapping, P)


@once
def universe(s: Source) -> DataFrame:
    return universe_of(s.report_tables, cmap(s), P)


@once
def shown(s: Source) -> DataFrame:
    return delivery.exposures(s.log, cmap(s), P, universe(s))


@once
def usage(s: Source) -> DataFrame:
    return conversions.app_usage(s.sessions, s.id_map, s.apps, P)


@once
def used(s: Source) -> DataFrame:
    return conversions.usage_since_first_line(usage(s), cmap(s))


@once
def first(s: Source) -> DataFrame:
    return conversions.first_app_open(usage(s), P, universe(s))


@once
def visits(s: Source) -> DataFrame:
    return conversions.page_visits(s.log, identity.ip_device_map(s.log, s.id_map, P), universe(s), P)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


# ---- mapping window, universe, identity

@query("creative_map", "SELECT * FROM cmap", "cmap")
def q_creative_map(s: Source):
    return cmap(s)


@query("campaign_meta", f"""
    SELECT DISTINCT target_country, target_country AS country, order_number, advertiser_id, advertiser_name, order_name, campaign_id,
           campaign_name, campaign_start, campaign_end, flight_id, flight_name, line_item_start AS flight_start, line_item_end AS flight_end,
           line_item_id, line_item_name, creative_id, creative_name, rate_type, rate, line_item_start, line_item_end, booked_impressions,
           booked_budget, 0::DOUBLE AS budget_delivered, DATE '2024-01-22' AS report_execution_date
    FROM mapping WHERE line_item_start < {W1} AND line_item_end >= {W0}""", "mapping")
def q_campaign_meta(s: Source):
    return mapping.campaign_meta(s.mapping, P)


@query("qualified_start", "SELECT known_seller, universe_start FROM qualifier", "qualifier")
def q_qualified_start(s: Source):
    return identity.qualified_start(s.log, cmap(s), P)


@query("device_universe", "SELECT country, device_id FROM uni", "uni")
def q_device_universe(s: Source):
    return universe(s)


@query("universe_size", "SELECT * FROM uni_size", "uni_size")
def q_universe_size(s: Source):
    return identity.universe_size(universe(s))


@query("ip_device_map", "SELECT ip, device_id, source_id FROM ips JOIN ids USING (device_id)", "ips", "ids")
def q_ip_device_map(s: Source):
    return identity.ip_device_map(s.log, s.id_map, P)


@query("identity_lookup", "SELECT source_id, device_id, COUNT(*) AS sessions FROM sessions GROUP BY ALL", "sessions")
def q_identity_lookup(s: Source):
    return identity.with_ad_id(s.sessions, s.id_map).groupBy("source_id", "device_id").agg(F.count("*").alias("sessions"))


# ---- delivery

@query("exposures", "SELECT * FROM shown", "shown")
def q_exposures(s: Source):
    return shown(s)


@query("delivery_by_creative", """
    SELECT campaign_id, creative_id, CAST(SUM(CASE WHEN event = 'impression' THEN 1 ELSE 0 END) AS BIGINT) AS impressions,
           CAST(SUM(CASE WHEN event = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks FROM shown GROUP BY ALL""", "shown")
def q_delivery_by_creative(s: Source):
    return delivery.delivery_stats(shown(s), IDS)


@query("delivery_daily", """
    SELECT campaign_id, creative_id, CAST(exposure_time AS DATE) AS exposure_day,
           CAST(SUM(CASE WHEN event = 'impression' THEN 1 ELSE 0 END) AS BIGINT) AS impressions,
           CAST(SUM(CASE WHEN event = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks FROM shown GROUP BY ALL""", "shown")
def q_delivery_daily(s: Source):
    return delivery.delivery_stats(shown(s), IDS, daily=True)


@query("delivery_daily_left", """
    SELECT i.campaign_id, i.creative_id, i.exposure_day, i.impressions, COALESCE(c.clicks, 0) AS clicks FROM
      (SELECT campaign_id, creative_id, CAST(exposure_time AS DATE) AS exposure_day, COUNT(*) AS impressions FROM shown
       WHERE event = 'impression' GROUP BY ALL) i
      LEFT JOIN (SELECT campaign_id, creative_id, CAST(exposure_time AS DATE) AS exposure_day, COUNT(*) AS clicks FROM shown
       WHERE event = 'click' GROUP BY ALL) c USING (campaign_id, creative_id, exposure_day)""", "shown")
def q_delivery_daily_left(s: Source):
    return delivery.delivery_stats(shown(s), IDS, daily=True, clicks_on_impression_days=True)


@query("exposures_daily", """
    SELECT DISTINCT device_id, country, campaign_id, flight_id, creative_id, event, CAST(exposure_time AS DATE) AS exposure_day,
           MIN(CAST(exposure_time AS DATE)) OVER (PARTITION BY device_id, event) AS first_day FROM shown""", "shown")
def q_exposures_daily(s: Source):
    return delivery.exposures_daily(shown(s))


@query("reach_frequency", """
    SELECT country, campaign_id, COUNT(*) AS impressions, COUNT(DISTINCT device_id) AS reach,
           round(COUNT(*)::DOUBLE / COUNT(DISTINCT device_id), 6) AS frequency
    FROM shown WHERE event = 'impression' GROUP BY ALL""", "shown")
def q_reach_frequency(s: Source):
    return rounded(delivery.reach_frequency(shown(s), ["country", "campaign_id"]), "frequency")


@query("reach_cube", " UNION ALL ".join(f"""
    SELECT '{name}' AS cut, {", ".join(c if c in by else f"NULL AS {c}" for c in ("campaign_id", "country", "creative_id", "flight_id", "week"))},
           COUNT(*) AS impressions, COUNT(DISTINCT device_id) AS reach, round(COUNT(*)::DOUBLE / NULLIF(COUNT(DISTINCT device_id), 0), 6) AS frequency
    FROM (SELECT *, CAST(date_trunc('week', exposure_time) AS DATE) AS week FROM shown WHERE event = 'impression')
    GROUP BY {", ".join(by) if by else "() HAVING COUNT(*) > 0"}""" for name, by in reach.CUBE.items()), "shown")
def q_reach_cube(s: Source):
    return rounded(reach.reach_of(shown(s)), "frequency")


@query("impressions_per_device", "SELECT country, device_id, order_number, day, CAST(SUM(imps) AS BIGINT) AS imps FROM imps GROUP BY ALL", "imps")
def q_impressions_per_device(s: Source):
    return delivery.impressions_per_device(s.log, s.mapping, P, ["order_number"], daily=True)


@query("video_tiles", f"""
    SELECT l.campaign_id, l.flight_id, l.creative_id, l.country,
           CAST(SUM(CASE WHEN tracker IN ('autoplay_start', 'start') THEN 1 END) AS BIGINT) AS video_start,
           CAST(SUM(CASE WHEN tracker IN ('autoplay_first_quartile', 'first_quartile') THEN 1 END) AS BIGINT) AS video_25,
           CAST(SUM(CASE WHEN tracker IN ('autoplay_midpoint_quartile', 'midpoint') THEN 1 END) AS BIGINT) AS video_50,
           CAST(SUM(CASE WHEN tracker IN ('autoplay_third_quartile', 'third_quartile') THEN 1 END) AS BIGINT) AS video_75,
           CAST(SUM(CASE WHEN tracker IN ('autoplay_complete', 'complete') THEN 1 END) AS BIGINT) AS video_completions
    FROM log l WHERE event = 'tracker' AND partition_time BETWEEN {W0} AND {WA} AND EXISTS (SELECT 1 FROM cmap c
      WHERE c.campaign_id = l.campaign_id AND c.flight_id = l.flight_id AND c.creative_id = l.creative_id
        AND c.target_country = l.country) GROUP BY ALL""", "log", "cmap")
def q_video_tiles(s: Source):
    return delivery.video_tiles(s.log, cmap(s), P)


@query("exposure_log", """
    SELECT country, CAST(exposure_time AS DATE) AS exposure_day, campaign_id, creative_id, COUNT(device_id) AS click
    FROM shown WHERE event = 'click' GROUP BY ALL""", "shown")
def q_exposure_log(s: Source):
    rows = delivery.exposure_log(shown(s), "click")
    return rows.groupBy("country", "exposure_day", *IDS).agg(F.count("device_id").alias("click"))


@query("impressions_with_product", f"""
    SELECT l.device_id, l.event_time AS exposure_time, l.campaign_id, l.flight_id, l.creative_id, p.p_partkey AS product_id, p.p_name AS product_name
    FROM log l JOIN part p ON p.p_partkey = l.creative_id
    WHERE l.event = 'impression' AND l.dropped IS NULL AND l.partition_time BETWEEN {W0} AND {W1}""", "log")
def q_impressions_with_product(s: Source):
    meta = s.mapping.select("campaign_id", "flight_id", "creative_id", F.col("line_item_id").alias("product_id"),
                            F.col("creative_name").alias("product_name"))
    seen = delivery.only(delivery.exposures(s.log, s.mapping, P, keys=("campaign_id",)), "impression")
    return delivery.with_product(seen, meta).drop("country", "event")


@query("creative_counts", f"""
    SELECT creative_id, country, COUNT(*) AS impressions FROM log
    WHERE event = 'impression' AND partition_time BETWEEN {W0} AND {W1} AND creative_id IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') GROUP BY ALL""", "log")
def q_creative_counts(s: Source):
    # The creatives of one product type, dropped events included.
    wanted = s.part.where("p_type = 'PROMO'").select(F.col("p_partkey").alias("creative_id"))
    seen = delivery.exposures(s.log, s.mapping, P, keep_dropped=True)
    return in_rel(delivery.only(seen, "impression"), wanted, "creative_id").groupBy("creative_id", "country").agg(
        F.count("*").alias("impressions"))


# ---- conversions

@query("app_usage", "SELECT * FROM usage", "usage")
def q_app_usage(s: Source):
    return usage(s)


@query("app_usage_day", """
    SELECT device_id, source_id, country, CAST(usage_time AS DATE) AS usage_time, CAST(SUM(minutes) AS BIGINT) AS minutes
    FROM usage GROUP BY ALL""", "usage")
def q_app_usage_day(s: Source):
    return conversions.app_usage(s.sessions, s.id_map, s.apps, P, grain="day")


@query("app_opens", f"""
    SELECT device_id, source_id, country, CAST(start_time AS DATE) AS usage_time, COUNT(*) AS opens, 0::BIGINT AS minutes
    FROM sessions WHERE app_id IN (SELECT app_id FROM apps WHERE product_name = 'app_0')
    AND partition_time BETWEEN TIMESTAMP '2023-12-08' AND {WA} GROUP BY ALL""", "sessions", "apps")
def q_app_opens(s: Source):
    return conversions.app_opens(s.app_opens, s.id_map, s.apps, P)


@query("usage_in_window", f"SELECT * FROM usage WHERE usage_time BETWEEN {W0} AND {WA}", "usage")
def q_usage_in_window(s: Source):
    return conversions.usage_in_window(usage(s), P)


@query("usage_since_first_line", "SELECT * FROM used", "used")
def q_usage_since_first_line(s: Source):
    return used(s)


@query("first_event_window", "SELECT * FROM first", "first")
def q_first_event_window(s: Source):
    return first(s)


def _days(*spans: tuple[int, int]) -> list:
    """Days counted from 1 December 2023."""
    return [[date(2023, 12, 1) + timedelta(days=k) for k in range(lo, hi)] for lo, hi in spans]


@query("first_event_incremental", "SELECT * FROM first", "first")
def q_first_event_incremental(s: Source):
    # The last days first, then the others, some of them a second time, and a month folded before it is taken again.
    state = lookback.usage_state(f"{work_dir(s.spark)}/usage")
    for days in _days((40, 62), (0, 45), (3, 8)):
        lookback.advance_usage(state, s.sessions, P, days)
        state.fold(s.spark, date(2024, 1, 20))
    return lookback.first_app_open(state, s.id_map, s.apps, P, universe(s))


@query("first_visits_incremental", f"""
    SELECT device_id, country, segment_id, MIN(visit_time) AS visit_time FROM pixels GROUP BY ALL
    HAVING MIN(visit_time) BETWEEN {W0} AND {WA}""", "pixels")
def q_first_visits_incremental(s: Source):
    state = lookback.visit_state(f"{work_dir(s.spark)}/visits")
    for days in _days((50, 62), (25, 52)):
        lookback.advance_visits(state, s.log, days)
    return lookback.first_visit(state, s.spark, P)


@query("app_users_incremental", "SELECT country, COUNT(DISTINCT device_id) AS app_users FROM usage GROUP BY 1", "usage")
def q_app_users_incremental(s: Source):
    state = lookback.usage_state(f"{work_dir(s.spark)}/usage")
    for days in _days((0, 31), (20, 62)):
        lookback.advance_usage(state, s.sessions, P, days)
    state.fold(s.spark, date(2024, 1, 20))
    return lookback.app_users(state, s.id_map, s.apps, P)


@query("ip_device_map_incremental", "SELECT ip, device_id, source_id FROM ips JOIN ids USING (device_id)", "ips", "ids")
def q_ip_device_map_incremental(s: Source):
    state = lookback.address_state(f"{work_dir(s.spark)}/addresses")
    for days in _days((45, 62), (30, 47)):
        lookback.advance_addresses(state, s.log, days)
    return lookback.ip_device_map(state, s.id_map, P)


@query("downloads_total", "SELECT COUNT(*) AS downloads FROM first", "first")
def q_downloads_total(s: Source):
    return conversions.downloads_total(first(s))


@query("downloads_daily", "SELECT CAST(first_open AS DATE) AS day, COUNT(*) AS downloads FROM first GROUP BY 1", "first")
def q_downloads_daily(s: Source):
    return conversions.downloads_daily(first(s))


@query("downloads_matched", """
    SELECT f.country, f.day, COUNT(DISTINCT u.device_id) AS downloads FROM usage u
    JOIN (SELECT device_id, country, MIN(CAST(usage_time AS DATE)) AS day FROM usage GROUP BY ALL) f
      ON f.device_id = u.device_id AND f.country = u.country AND CAST(u.usage_time AS DATE) = f.day GROUP BY ALL""", "usage")
def q_downloads_matched(s: Source):
    return conversions.downloads_matched(usage(s))


@query("installs_by_country", "SELECT country, COUNT(DISTINCT device_id) AS installs FROM first GROUP BY 1", "first")
def q_installs(s: Source):
    return conversions.installs_by_country(first(s))


@query("app_users", "SELECT country, COUNT(DISTINCT device_id) AS app_users FROM usage GROUP BY 1", "usage")
def q_app_users(s: Source):
    return conversions.app_users(usage(s))


@query("app_usage_hours", "SELECT * FROM hours", "hours")
def q_app_usage_hours(s: Source):
    return conversions.app_usage_hours(s.sessions, s.id_map, s.apps, universe(s), P)


@query("page_visits", "SELECT device_id, country, segment_id, visit_time, COUNT(*) AS n FROM visits GROUP BY ALL", "visits")
def q_page_visits(s: Source):
    return visits(s).groupBy("device_id", "country", "segment_id", "visit_time").agg(F.count("*").alias("n"))


@query("page_visits_daily", """
    SELECT CAST(visit_time AS DATE) AS day, segment_id, COUNT(*) AS visits FROM first_visits GROUP BY ALL""", "first_visits")
def q_page_visits_daily(s: Source):
    return conversions.visits_daily(conversions.first_visit(visits(s), P))


@query("page_visitors_daily", """
    SELECT CAST(visit_time AS DATE) AS day, segment_id, COUNT(DISTINCT device_id) AS visits FROM first_visits GROUP BY ALL""", "first_visits")
def q_page_visitors_daily(s: Source):
    return conversions.visits_daily(conversions.first_visit(visits(s), P), distinct=True)


@query("visits_by_country", """
    SELECT country, CAST(SUM(CASE WHEN segment_id = 0 THEN 1 END) AS BIGINT) AS total_signup_page_visits,
           CAST(SUM(CASE WHEN segment_id = 1 THEN 1 END) AS BIGINT) AS total_homepage_page_visits FROM pixels GROUP BY 1""", "pixels")
def q_visits_by_country(s: Source):
    return conversions.visits_by_country(conversions.pixels(s.log, P), P)


_FLAGS = "CAST(MAX(CASE WHEN datediff('second', start_time, end_time) >= {} THEN 1 ELSE 0 END) AS INTEGER)"


@query("usage_thresholds", f"""
    SELECT device_id, source_id, country, start_time AS usage_time, {_FLAGS.format(15)} AS s15, {_FLAGS.format(60)} AS s60,
           {_FLAGS.format(300)} AS s300 FROM sessions
    WHERE app_id IN (SELECT app_id FROM apps WHERE product_name = 'app_0') AND partition_time BETWEEN {W0} AND {WA}
      AND datediff('second', start_time, end_time) >= 15 GROUP BY ALL""", "sessions", "apps")
def q_usage_thresholds(s: Source):
    return conversions.usage_thresholds(s.sessions, s.id_map, s.apps, P, {"s15": 15, "s60": 60, "s300": 300})


# ---- attribution

@query("interval_join", """
    SELECT device_id, country, campaign_id, creative_id, COUNT(*) AS pairs, CAST(SUM(minutes) AS BIGINT) AS minutes
    FROM pairs GROUP BY ALL""", "pairs")
def q_interval_join(s: Source):
    from adspark.operators.touch import pair_totals
    return pair_totals(shown(s), used(s), KEYS, "exposure_time", "usage_time", IDS, {"minutes": "minutes"},
                       P.attribution_days)


@query("attr_any_7d", """
    SELECT campaign_id, creative_id, COUNT(*) AS conversions, COUNT(DISTINCT device_id) AS devices,
           CAST(SUM(minutes) AS BIGINT) AS minutes FROM pairs GROUP BY ALL""", "pairs")
def q_attr_any_7d(s: Source):
    return attribution.any_touch(shown(s), used(s), IDS, "usage_time", P.attribution_days, KEYS)


@query("attr_any_conversion_day", """
    SELECT campaign_id, creative_id, CAST(usage_time AS DATE) AS conversion_day, COUNT(*) AS conversions,
           COUNT(DISTINCT device_id) AS devices, CAST(SUM(minutes) AS BIGINT) AS minutes FROM pairs GROUP BY ALL""", "pairs")
def q_attr_any_conversion_day(s: Source):
    return attribution.any_touch(shown(s), used(s), IDS, "usage_time", P.attribution_days, KEYS, date_of="conversion")


_UNBOUNDED = """
    SELECT campaign_id, creative_id, {day} COUNT(*) AS conversions, COUNT(DISTINCT s.device_id) AS devices,
           CAST(SUM(minutes) AS BIGINT) AS minutes
    FROM shown s JOIN used u ON u.device_id = s.device_id AND u.country = s.country AND s.exposure_time <= u.usage_time
    GROUP BY ALL"""


@query("attr_any_unbounded", _UNBOUNDED.format(day=""), "shown", "used")
def q_attr_any_unbounded(s: Source):
    return attribution.any_touch(shown(s), used(s), IDS, "usage_time", None, KEYS)


@query("attr_any_unbounded_day", _UNBOUNDED.format(day="CAST(usage_time AS DATE) AS conversion_day,"), "shown", "used")
def q_attr_any_unbounded_day(s: Source):
    return attribution.any_touch(shown(s), used(s), IDS, "usage_time", None, KEYS, date_of="conversion")


@query("attr_any_device_day", """
    SELECT country, campaign_id, creative_id, COUNT(*) AS conversions, COUNT(DISTINCT device_id) AS devices,
           CAST(SUM(minutes) AS BIGINT) AS minutes
    FROM (SELECT DISTINCT s.country, s.campaign_id, s.creative_id, s.device_id, u.day, u.minutes
          FROM shown s JOIN (SELECT device_id, country, CAST(usage_time AS DATE) AS day, SUM(minutes) AS minutes FROM used GROUP BY ALL) u
          ON u.device_id = s.device_id AND u.country = s.country AND CAST(s.exposure_time AS DATE) <= u.day) GROUP BY ALL""", "shown", "used")
def q_attr_any_device_day(s: Source):
    return attribution.any_touch_device_day(shown(s), used(s), ["country", *IDS])


_LAST = """
    SELECT {key}, exposure_time, campaign_id, flight_id, creative_id FROM (
      SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY exposure_time DESC, campaign_id, flight_id, creative_id) AS rn
      FROM {rel}) WHERE rn = 1"""


@query("attr_last_7d", _LAST.format(key="device_id, source_id, country, usage_time, minutes",
                                    part="device_id, source_id, usage_time", rel="pairs"), "pairs")
def q_attr_last_7d(s: Source):
    return attribution.last_touch(shown(s), used(s), "usage_time", P.attribution_days, KEYS)


@query("attr_last_unbounded", _LAST.format(
    key="device_id, country, usage_time, minutes, source_id", part="device_id, source_id, usage_time",
    rel="""(SELECT s.*, u.usage_time, u.minutes, u.source_id FROM shown s JOIN used u ON u.device_id = s.device_id
            AND u.country = s.country AND s.exposure_time <= u.usage_time)"""), "shown", "used")
def q_attr_last_unbounded(s: Source):
    return attribution.last_touch(shown(s), used(s), "usage_time", None, KEYS)


@query("attr_last_first_event", """
    SELECT campaign_id, creative_id, COUNT(*) AS conversions, COUNT(DISTINCT device_id) AS devices FROM (
      SELECT *, row_number() OVER (PARTITION BY device_id, country, first_open
                                   ORDER BY exposure_time DESC, campaign_id, flight_id, creative_id) AS rn FROM first_pairs)
    WHERE rn = 1 GROUP BY ALL""", "first_pairs")
def q_attr_last_first_event(s: Source):
    return attribution.attribute(shown(s), first(s), P, "first_open", "last", IDS, KEYS, per=[*KEYS, "first_open"])


_PER_DEVICE = """
    SELECT device_id, country, first_open, exposure_time, campaign_id, flight_id, creative_id,
           datediff('second', exposure_time, first_open) AS seconds_to_conversion FROM (
      SELECT *, row_number() OVER (PARTITION BY device_id, country ORDER BY {order} campaign_id, flight_id, creative_id) AS rn
      FROM {rel}) WHERE rn = 1"""


@query("attr_last_per_device", _PER_DEVICE.format(order="exposure_time DESC, first_open,", rel="first_pairs"), "first_pairs")
def q_attr_last_per_device(s: Source):
    return attribution.last_touch_per_device(shown(s), first(s), "first_open", P.attribution_days, KEYS).drop("source_id")


@query("attr_nearest", _PER_DEVICE.format(
    order="datediff('second', exposure_time, first_open), exposure_time, first_open,",
    rel="""(SELECT s.*, f.first_open FROM shown s JOIN first f ON f.device_id = s.device_id AND f.country = s.country
            AND s.exposure_time <= f.first_open)"""), "shown", "first")
def q_attr_nearest(s: Source):
    return attribution.nearest_touch(shown(s), first(s), "first_open", KEYS).drop("source_id")


@query("attr_first_touch", """
    SELECT device_id, country, usage_time, minutes, source_id, exposure_time, campaign_id, flight_id, creative_id FROM (
      SELECT *, row_number() OVER (PARTITION BY device_id, source_id, usage_time
                                   ORDER BY exposure_time, campaign_id, flight_id, creative_id) AS rn FROM pairs)
    WHERE rn = 1""", "pairs")
def q_attr_first_touch(s: Source):
    return attribution.first_touch(shown(s), used(s), "usage_time", P.attribution_days, KEYS)


@query("attr_last_day_grain", """
    SELECT country, campaign_id, creative_id, COUNT(DISTINCT device_id) AS devices FROM (
      SELECT s.*, row_number() OVER (PARTITION BY s.device_id, s.country, f.day
                                     ORDER BY CAST(s.exposure_time AS DATE) DESC, s.campaign_id, s.flight_id, s.creative_id) AS rn
      FROM shown s JOIN (SELECT device_id, country, CAST(first_open AS DATE) AS day FROM first) f
      ON f.device_id = s.device_id AND f.country = s.country AND CAST(s.exposure_time AS DATE) <= f.day)
    WHERE rn = 1 GROUP BY ALL""", "shown", "first")
def q_attr_last_day_grain(s: Source):
    rows = attribution.last_touch_daily(shown(s), first(s))
    return rows.groupBy("country", *IDS).agg(F.countDistinct("device_id").alias("devices"))


@query("attr_last_visits", """
    SELECT campaign_id, creative_id, segment_id, COUNT(*) AS visits FROM (
      SELECT s.campaign_id, s.creative_id, v.segment_id, row_number() OVER (
          PARTITION BY v.device_id, v.country, v.segment_id, v.visit_time
          ORDER BY s.exposure_time DESC, s.campaign_id, s.flight_id, s.creative_id) AS rn
      FROM shown s JOIN visits v ON v.device_id = s.device_id AND v.country = s.country
       AND s.exposure_time <= v.visit_time AND datediff('day', s.exposure_time, v.visit_time) <= 7)
    WHERE rn = 1 GROUP BY ALL""", "shown", "visits")
def q_attr_last_visits(s: Source):
    per = ["device_id", "country", "segment_id", "visit_time"]
    rows = attribution.last_touch(shown(s), visits(s), "visit_time", P.attribution_days, KEYS, per=per)
    return rows.groupBy(*IDS, "segment_id").agg(F.count("*").alias("visits"))


@query("attr_last_first_visits", """
    SELECT campaign_id, creative_id, segment_id, COUNT(*) AS visits FROM (
      SELECT s.campaign_id, s.creative_id, v.segment_id, row_number() OVER (
          PARTITION BY v.device_id, v.country, v.segment_id, v.visit_time
          ORDER BY s.exposure_time DESC, s.campaign_id, s.flight_id, s.creative_id) AS rn
      FROM shown s JOIN first_visits v ON v.device_id = s.device_id AND v.country = s.country
       AND s.exposure_time <= v.visit_time AND datediff('day', s.exposure_time, v.visit_time) <= 7)
    WHERE rn = 1 GROUP BY ALL""", "shown", "first_visits")
def q_attr_last_first_visits(s: Source):
    new = conversions.first_visit(visits(s), P)
    return attribution.last_touch(shown(s), new, "visit_time", P.attribution_days, KEYS).groupBy(*IDS, "segment_id").agg(
        F.count("*").alias("visits"))


@query("attr_visit_devices", """
    SELECT campaign_id, creative_id, COUNT(*) AS conversions, COUNT(DISTINCT s.device_id) AS devices
    FROM shown s JOIN visits v ON v.device_id = s.device_id AND v.country = s.country AND s.exposure_time <= v.visit_time
    GROUP BY ALL""", "shown", "visits")
def q_attr_visit_devices(s: Source):
    return attribution.any_touch(shown(s), visits(s), IDS, "visit_time", None, KEYS, minutes=None)


@query("exposed_converters", """
    SELECT DISTINCT s.device_id, s.country FROM shown s JOIN pixels v ON v.device_id = s.device_id AND v.country = s.country
    AND s.exposure_time <= v.visit_time AND datediff('day', s.exposure_time, v.visit_time) <= 7""", "shown", "pixels")
def q_exposed_converters(s: Source):
    return attribution.exposed_converters(shown(s), conversions.pixels(s.log, P), "visit_time", P.attribution_days, KEYS)


_THRESHOLD = """
    SELECT '{label}' AS time_threshold, c.placement_name, COUNT(DISTINCT s.device_id) AS new_converter_count
    FROM shown s JOIN cmap c ON c.campaign_id = s.campaign_id AND c.creative_id = s.creative_id
    JOIN first f ON f.device_id = s.device_id AND f.country = s.country
    JOIN sessions u ON u.device_id = s.device_id AND u.country = s.country AND s.exposure_time <= u.start_time
     AND datediff('day', s.exposure_time, u.start_time) <= 7
    WHERE s.event = 'impression' AND u.app_id IN (SELECT app_id FROM apps WHERE product_name = 'app_0')
      AND u.partition_time BETWEEN {lo} AND {hi} AND datediff('second', u.start_time, u.end_time) >= {n}
    GROUP BY ALL"""
TIME_SQL = (_THRESHOLD.format(label="1min time spent", n=60, lo=W0, hi=WA) + " UNION "
            + _THRESHOLD.format(label="5min time spent", n=300, lo=W0, hi=WA))


@query("threshold_converters", TIME_SQL, "shown", "cmap", "first", "sessions", "apps")
def q_threshold_converters(s: Source):
    long_use = conversions.usage_thresholds(s.sessions, s.id_map, s.apps, P, TIME_THRESHOLDS)
    return attribution.threshold_converters(shown(s), long_use, first(s), cmap(s), P, TIME_LABELS)


@query("exposed_stats", """
    SELECT campaign_id, creative_id, country, COUNT(*) AS exposed_opens, round(AVG(minutes), 6) AS average_minutes,
           COUNT(DISTINCT device_id) AS exposed_openers FROM (
      SELECT *, row_number() OVER (PARTITION BY device_id, source_id, usage_time
        ORDER BY exposure_time DESC, campaign_id, flight_id, creative_id) AS rn FROM pairs)
    WHERE rn = 1 GROUP BY ALL""", "pairs")
def q_exposed_stats(s: Source):
    credited = attribution.last_touch(shown(s), used(s), "usage_time", P.attribution_days, KEYS)
    return rounded(attribution.exposed_stats(credited, [*IDS, "country"]), "average_minutes")


# ---- money

_CPM = """CASE WHEN rate_type = 'CPM' THEN rate WHEN rate_type = 'Flat Rate'
          THEN booked_budget / NULLIF(booked_impressions::DOUBLE / 1000, 0) END"""
_DELIVERED = """(SELECT campaign_id, creative_id, SUM(CASE WHEN event = 'impression' THEN 1 ELSE 0 END)::DOUBLE AS i,
                 SUM(CASE WHEN event = 'click' THEN 1 ELSE 0 END)::DOUBLE AS c FROM shown GROUP BY ALL)"""


def _costed(s: Source) -> DataFrame:
    stats = delivery.delivery_stats(shown(s), IDS)
    return stats.join(cmap(s).drop("flight_id"), IDS)


@query("spend_cpm", f"""
    SELECT campaign_id, creative_id, round({_CPM}, 6) AS cpm, round(i / 1000 * {_CPM}, 6) AS prorated,
           round(CASE WHEN rate_type = 'Flat Rate' THEN booked_budget ELSE i / 1000 * {_CPM} END, 6) AS full_fee
    FROM {_DELIVERED} JOIN cmap USING (campaign_id, creative_id)""", "shown", "cmap")
def q_spend_cpm(s: Source):
    return _costed(s).select(
        *IDS, F.round(finance.effective_cpm(), 6).alias("cpm"), F.round(finance.spend(), 6).alias("prorated"),
        F.round(finance.spend(flat_rate="full"), 6).alias("full_fee"))


@query("ctr_cpc_cpi_cac", f"""
    SELECT campaign_id, creative_id, round(c / NULLIF(i, 0) * 100, 6) AS ctr, round(CASE WHEN i = 0 THEN 0 ELSE c / i END, 6) AS ctr_fraction,
           round(CASE WHEN c = 0 THEN 0 ELSE i / 1000 * {_CPM} / c END, 6) AS cpc, round(i / 1000 * {_CPM} / NULLIF(c, 0), 6) AS cpi
    FROM {_DELIVERED} JOIN cmap USING (campaign_id, creative_id)""", "shown", "cmap")
def q_ctr_cpc(s: Source):
    rows = _costed(s).withColumn("spend", finance.spend())
    return rounded(rows.select(
        *IDS, finance.ctr().alias("ctr"), finance.ctr(percent=False).alias("ctr_fraction"),
        finance.cost_per("spend", "clicks", default=0).alias("cpc"), finance.cost_per("spend", "clicks").alias("cpi")),
        "ctr", "ctr_fraction", "cpc", "cpi")


@query("booked_budget", """
    SELECT p_partkey AS line_item_id, CASE WHEN p_size % 3 = 0 THEN p_size * 1.0::DOUBLE ELSE p_retailprice END AS booked_budget FROM part""")
def q_booked_budget(s: Source):
    return s.book.select("line_item_id", finance.booked_budget().alias("booked_budget"))


# ---- lift

@once
def subscribers(s: Source) -> DataFrame:
    listed = s.customer.where("c_mktsegment = 'MACHINERY'").select(F.lower("c_name").alias("source_id"))
    return audience.subscriber_ids(listed, s.id_map)


@once
def matched(s: Source) -> DataFrame:
    hours = conversions.app_usage_hours(s.sessions, s.id_map, s.apps, universe(s), P)
    return audience.matched_usage(hours, audience.matched_audience(universe(s), subscribers(s)))


def imps(s: Source, *by: str) -> DataFrame:
    return delivery.impressions_per_device(s.log, s.mapping, P, ["order_number", *by])


@query("subscriber_ids", "SELECT * FROM subs", "subs")
def q_subscriber_ids(s: Source):
    return subscribers(s)


@query("matched_audience", "SELECT DISTINCT country, device_id FROM uni WHERE device_id IN (SELECT device_id FROM subs)", "uni", "subs")
def q_matched_audience(s: Source):
    return audience.matched_audience(universe(s), subscribers(s))


@query("matched_usage", "SELECT * FROM matched", "matched")
def q_matched_usage(s: Source):
    return matched(s)


@query("audience_summary", """
    SELECT (SELECT COUNT(DISTINCT device_id) FROM subs) AS listed_devices, 'subscribers' AS audience,
           (SELECT COUNT(DISTINCT device_id) FROM matched) AS matched_devices""", "subs", "matched")
def q_audience_summary(s: Source):
    return lift.audience_summary(subscribers(s), matched(s), "subscribers")


def _lift_sql(by: str, group: str = "") -> str:
    """Rates from separate distinct counts, as a report query would write them."""
    shown_by = f"country, order_number{by}"
    inner = f"SELECT {shown_by}, device_id, SUM(imps) AS imps FROM imps GROUP BY ALL"
    keys = shown_by
    if group:
        inner = f"SELECT country, order_number, CAST(LEAST(imps, 20) AS BIGINT) AS impression_group, device_id, imps FROM ({inner})"
        keys = "country, order_number, impression_group"
    return f"""
    SELECT *, round(exposed_rate_ / NULLIF(unexposed_rate_, 0) - 1, 6) AS lift, round(avg_e / NULLIF(avg_u, 0) - 1, 6) AS lift_time_spent,
           round(exposed_rate_, 6) AS exposed_rate, round(unexposed_rate_, 6) AS unexposed_rate,
           round(avg_e, 6) AS avg_exposed_hours, round(avg_u, 6) AS avg_unexposed_hours FROM (
      SELECT *, total_universe - reach AS unexposed_universe, total_users - exposed_users AS unexposed_users,
             total_hours - exposed_hours AS unexposed_hours, round(imps::DOUBLE / reach, 6) AS freq,
             exposed_users::DOUBLE / reach AS exposed_rate_,
             (total_users - exposed_users)::DOUBLE / NULLIF(total_universe - reach, 0) AS unexposed_rate_,
             exposed_hours::DOUBLE / NULLIF(exposed_users, 0) AS avg_e,
             (total_hours - exposed_hours)::DOUBLE / NULLIF(total_users - exposed_users, 0) AS avg_u
      FROM (SELECT {keys}, COUNT(DISTINCT device_id) AS reach, CAST(SUM(imps) AS BIGINT) AS imps FROM ({inner}) GROUP BY ALL) r
      JOIN (SELECT {', '.join('i.' + k.strip() for k in keys.split(','))}, COUNT(DISTINCT i.device_id) AS exposed_users,
                   CAST(SUM(m.hours) AS BIGINT) AS exposed_hours
            FROM ({inner}) i JOIN matched m ON m.country = i.country AND m.device_id = i.device_id GROUP BY ALL) e USING ({keys})
      JOIN (SELECT country, COUNT(DISTINCT device_id) AS total_users, CAST(SUM(hours) AS BIGINT) AS total_hours FROM matched GROUP BY 1) t USING (country)
      JOIN uni_size USING (country))"""


def _lift_columns(by: str, group: str = "") -> str:
    keys = "country, order_number" + (", impression_group" if group else by)
    return (f"SELECT {keys}, exposed_users, exposed_hours, reach, imps, total_users, total_hours, total_universe, freq, unexposed_universe, "
            "unexposed_users, unexposed_hours, exposed_rate, unexposed_rate, avg_unexposed_hours, avg_exposed_hours, lift, lift_time_spent "
            f"FROM ({_lift_sql(by, group)})")


RATES = ("freq", "exposed_rate", "unexposed_rate", "avg_unexposed_hours", "avg_exposed_hours", "lift", "lift_time_spent")
_LIFT_VIEWS = ("imps", "matched", "uni_size")


@query("lift_overall", _lift_columns(""), *_LIFT_VIEWS)
def q_lift_overall(s: Source):
    return rounded(lift.lift(imps(s), matched(s), identity.universe_size(universe(s))), *RATES)


@query("lift_frequency", _lift_columns("", "frequency"), *_LIFT_VIEWS)
def q_lift_frequency(s: Source):
    return rounded(lift.lift(imps(s), matched(s), identity.universe_size(universe(s)), frequency_cap=20), *RATES)


_CUT_SQL = " UNION ALL BY NAME ".join(
    f"SELECT '{name}' AS cut, CAST({column or 'NULL'} AS VARCHAR) AS value, *{f' EXCLUDE ({column})' if column else ''} FROM ({sql})"
    for name, column, sql in (
        ("overall", None, _lift_columns("")), ("frequency", "impression_group", _lift_columns("", "frequency")),
        *[(name, column, _lift_columns(f", {column}")) for name, column in lift.CUTS.items() if column]))


@query("subscriber_lift", _CUT_SQL, *_LIFT_VIEWS)
def q_subscriber_lift(s: Source):
    size = identity.universe_size(universe(s))
    return rounded(lift.subscriber_lift(s.log, s.mapping, matched(s), size, P, frequency_cap=20), *RATES)


@query("lift_by_placement", _lift_columns(", line_item_name"), *_LIFT_VIEWS)
def q_lift_placement(s: Source):
    return rounded(lift.lift(imps(s, "line_item_name"), matched(s), identity.universe_size(universe(s)), ["line_item_name"]), *RATES)


@query("lift_by_creative", _lift_columns(", creative_id"), *_LIFT_VIEWS)
def q_lift_creative(s: Source):
    return rounded(lift.lift(imps(s, "creative_id"), matched(s), identity.universe_size(universe(s)), ["creative_id"]), *RATES)


@query("lift_by_flight", _lift_columns(", flight_id"), *_LIFT_VIEWS)
def q_lift_flight(s: Source):
    return rounded(lift.lift(imps(s, "flight_id"), matched(s), identity.universe_size(universe(s)), ["flight_id"]), *RATES)


@query("daily_exposure", """
    SELECT i.order_number, a.country, a.day, a.total_users, e.exposed_users, i.reach, i.imps, u.total_universe,
           u.total_universe - i.reach AS unexposed_universe, a.total_users - e.exposed_users AS unexposed_users
    FROM (SELECT country, CAST(usage_time AS DATE) AS day, COUNT(DISTINCT device_id) AS total_users FROM matched GROUP BY ALL) a
    JOIN (SELECT country, order_number, day, COUNT(DISTINCT device_id) AS reach, CAST(SUM(imps) AS BIGINT) AS imps FROM imps GROUP BY ALL) i USING (country, day)
    JOIN (SELECT m.country, i.day, COUNT(DISTINCT m.device_id) AS exposed_users FROM matched m JOIN imps i ON i.country = m.country
          AND i.device_id = m.device_id AND i.day = CAST(m.usage_time AS DATE) GROUP BY ALL) e USING (country, day)
    JOIN uni_size u USING (country)""", *_LIFT_VIEWS)
def q_daily_exposure(s: Source):
    daily = delivery.impressions_per_device(s.log, s.mapping, P, ["order_number"], daily=True)
    return lift.daily_exposure(daily, matched(s), identity.universe_size(universe(s)))


@query("unexposed_rate", """
    SELECT COUNT(*) AS unexposed_devices, CAST(COALESCE(SUM(CASE WHEN device_id IN (SELECT device_id FROM pixels) THEN 1 ELSE 0 END), 0) AS BIGINT) AS unexposed_converters,
           round(SUM(CASE WHEN device_id IN (SELECT device_id FROM pixels) THEN 1 ELSE 0 END)::DOUBLE / NULLIF(COUNT(*), 0), 6) AS unexposed_conversion_rate
    FROM (SELECT DISTINCT device_id FROM uni) WHERE device_id NOT IN (SELECT device_id FROM media)""", "uni", "media", "pixels")
def q_unexposed_rate(s: Source):
    rows = lift.unexposed_rate(universe(s).select("device_id"), s.media, conversions.pixels(s.log, P))
    return rounded(rows, "unexposed_conversion_rate")


_IN = "device_id IN (SELECT device_id FROM media WHERE media = '{}')"
_N, _C, _S = (_IN.format(m) for m in ("native", "ctv", "stvp"))
COMBOS = f"""
    SELECT 'native' AS combo, * FROM media WHERE media = 'native' UNION ALL
    SELECT 'ctv', * FROM media WHERE media = 'ctv' UNION ALL
    SELECT 'stvp', * FROM media WHERE media = 'stvp' UNION ALL
    SELECT 'ctv_and_stvp', * FROM media WHERE media IN ('ctv', 'stvp') AND {_C} AND {_S} UNION ALL
    SELECT 'ctv_or_stvp', * FROM media WHERE media IN ('ctv', 'stvp') UNION ALL
    SELECT 'all_media', * FROM media WHERE {_C} AND {_S} AND {_N} UNION ALL """
COMBO_5 = f"SELECT 'ctv_or_stvp_and_native', * FROM media WHERE {_N} AND ({_C} OR {_S})"
COMBO_5_LITERAL = f"SELECT 'ctv_or_stvp_and_native', * FROM media WHERE media = 'ctv' OR ({_S} AND {_N} AND media IN ('stvp', 'native'))"


@query("media_combos", f"""
    SELECT combo, COUNT(*) AS impressions, COUNT(DISTINCT device_id) AS reach FROM ({COMBOS} {COMBO_5}) GROUP BY 1""", "media")
def q_media_combos(s: Source):
    return lift.media_combos(s.media)


@query("media_combos_exclusive", f"""
    SELECT combo, COUNT(*) AS impressions, COUNT(DISTINCT device_id) AS reach FROM (
      SELECT 'native' AS combo, * FROM media WHERE media = 'native' AND NOT ({_C}) AND NOT ({_S}) UNION ALL
      SELECT 'ctv', * FROM media WHERE media = 'ctv' AND NOT ({_N}) AND NOT ({_S}) UNION ALL
      SELECT 'stvp', * FROM media WHERE media = 'stvp' AND NOT ({_N}) AND NOT ({_C}) UNION ALL
      SELECT 'ctv_and_stvp', * FROM media WHERE media IN ('ctv', 'stvp') AND {_C} AND {_S} UNION ALL
      SELECT 'ctv_or_stvp', * FROM media WHERE (media = 'ctv' AND NOT ({_N}) AND NOT ({_S})) OR (media = 'stvp' AND NOT ({_N}) AND NOT ({_C})) UNION ALL
      SELECT 'all_media', * FROM media WHERE {_C} AND {_S} AND {_N} UNION ALL {COMBO_5}) GROUP BY 1""", "media")
def q_media_combos_exclusive(s: Source):
    return lift.media_combos(s.media, exclusive=True)


def _product_sql(out: str) -> str:
    return f"""
    SELECT combo AS media_ad_type, impressions, reach, conv AS website_conversions,
           round(CASE WHEN reach = 0 THEN 0 ELSE conv::DOUBLE / reach END, 6) AS exposed_conversion_rate,
           round(rate, 6) AS unexposed_conversion_rate,
           round(CASE WHEN reach = 0 THEN 0 ELSE conv::DOUBLE / reach END / NULLIF(rate, 0) - 1, 6) AS website_visitation_lift,
           NULL::BIGINT AS incremental_reach, NULL::DOUBLE AS avg_freq FROM (
      SELECT combo, COUNT(*) AS impressions, COUNT(DISTINCT device_id) AS reach,
        (SELECT COUNT(DISTINCT c2.device_id) FROM conv c2 WHERE c2.combo = c.combo) AS conv,
        (SELECT COUNT(DISTINCT u.device_id)::DOUBLE FROM uni u WHERE u.device_id IN (SELECT device_id FROM pixels)
           AND NOT EXISTS (SELECT 1 FROM {out} o WHERE o.combo = c.combo AND o.device_id = u.device_id)) /
        NULLIF((SELECT COUNT(DISTINCT u.device_id) FROM uni u
           WHERE NOT EXISTS (SELECT 1 FROM {out} o WHERE o.combo = c.combo AND o.device_id = u.device_id)), 0) AS rate
      FROM combos c GROUP BY combo)"""


def _product_views(combo_5: str) -> str:
    return f""", combos AS ({COMBOS} {combo_5}), conv AS (SELECT DISTINCT c.combo, c.device_id FROM combos c JOIN pixels p
      ON p.device_id = c.device_id AND c.exposure_time <= p.visit_time AND datediff('day', c.exposure_time, p.visit_time) <= 7)"""


PRODUCT_RATES = ("exposed_conversion_rate", "unexposed_conversion_rate", "website_visitation_lift")


@query("product_lift", _product_views(COMBO_5) + _product_sql("combos"), "media", "pixels", "uni")
def q_product_lift(s: Source):
    rows = lift.product_lift(s.media, conversions.pixels(s.log, P), universe(s), P.attribution_days)
    return rounded(rows, *PRODUCT_RATES)


@query("product_lift_literal", _product_views(COMBO_5_LITERAL) + _product_sql("conv"), "media", "pixels", "uni")
def q_product_lift_literal(s: Source):
    rows = lift.product_lift(s.media, conversions.pixels(s.log, P), universe(s), P.attribution_days,
                             unexposed="not_converted", literal=True)
    return rounded(rows, *PRODUCT_RATES)


# ---- audiences

APP, GOAL, CATEGORY = "voice.client", "ACTIVATE", "signup"


def voice(s: Source) -> DataFrame:
    """Events as voice events: sign-ups of even creatives carry the goal in part 4 of their payload."""
    payload = F.concat_ws(",", F.concat(F.lit("id-Voice.Client-"), F.col("k")), F.lit("a"), F.lit("b"),
                          F.when(F.col("k") % 2 == 0, "LOGIN_ACTIVATE").otherwise("LOGIN"))
    return s.ev.select("source_id", F.col("event_type").alias("category"), payload.alias("payload"), "country", "partition_time")


_MAPPED = "source_id IN (SELECT c_name FROM customer WHERE c_custkey % 17 <> 0)"
_REG = f"""SELECT DISTINCT country, source_id FROM ev WHERE event_type = 'signup' AND {_MAPPED}
          AND CASE WHEN k % 2 = 0 THEN 'LOGIN_ACTIVATE' ELSE 'LOGIN' END LIKE '%ACTIVATE%'
          AND partition_time BETWEEN TIMESTAMP '{{lo}}' AND TIMESTAMP '2024-01-30 23:00:00'"""
_DAY, _MONTH = _REG.format(lo="2024-01-30 00:00:00"), _REG.format(lo="2023-12-17 00:00:00")
RUN = datetime(2024, 1, 31)
_OLD = "SELECT source_id FROM markets WHERE segment = 'MACHINERY'"
_HELD = f"""SELECT source_id FROM ({_DAY}) WHERE ('0x' || substr(md5('3:' || source_id), 1, 8))::BIGINT % 100 < 10"""


def registered(s: Source, days: int) -> DataFrame:
    lo = datetime(2024, 1, 30) if days == 1 else datetime(2023, 12, 17)
    return audience.registrations(voice(s), lo, datetime(2024, 1, 30, 23), CATEGORY,
                                  audience.payload_match(APP, GOAL), s.id_map)


def old_control(s: Source) -> DataFrame:
    return s.markets.where(F.col("segment") == "MACHINERY").select("source_id")


@query("registrations", _MONTH, "ev")
def q_registrations(s: Source):
    return registered(s, 45)


@query("registrations_json", f"""
    SELECT DISTINCT country, source_id FROM ev WHERE event_type = 'signup' AND k = 7 AND {_MAPPED}
    AND partition_time BETWEEN TIMESTAMP '2023-12-17' AND TIMESTAMP '2024-01-30 23:00:00'""", "ev")
def q_registrations_json(s: Source):
    events = s.ev.select("source_id", F.col("event_type").alias("category"), "country", "partition_time",
                         F.format_string('{"appid": "app", "exe_goal": "%s"}', F.col("k").cast("string")).alias("payload"))
    return audience.registrations(events, datetime(2023, 12, 17), datetime(2024, 1, 30, 23), CATEGORY,
                                  audience.payload_match("app", "7", "json"), s.id_map)


@query("control_group", f"SELECT country, source_id FROM ({_MONTH}) WHERE ('0x' || substr(md5('3:' || source_id), 1, 8))::BIGINT % 100 < 10", "ev")
def q_control_group(s: Source):
    return audience.control_group(registered(s, 45), seed=3)


@query("control_group_exact", f"""
    SELECT source_id FROM (SELECT source_id, ntile(100) OVER (ORDER BY md5('3:' || source_id), source_id) AS tile
      FROM (SELECT DISTINCT source_id FROM ({_MONTH}))) WHERE tile <= 10""", "ev")
def q_control_group_exact(s: Source):
    return audience.control_group(registered(s, 45).select("source_id"), seed=3, exact=True)


@query("roll_control", f"{_HELD} UNION {_OLD}", "ev", "markets")
def q_roll_control(s: Source):
    new = audience.control_group(registered(s, 1), seed=3).select("source_id")
    return audience.roll_control(new, old_control(s))


@query("audience_minus_control", f"""
    SELECT country, source_id FROM ({_MONTH}) WHERE source_id NOT IN ({_HELD} UNION {_OLD})""", "ev", "markets")
def q_audience(s: Source):
    return _audiences(s)[1]


@query("audience_control", f"{_HELD} UNION {_OLD}", "ev", "markets")
def q_audience_control(s: Source):
    return _audiences(s)[0]


_NIGHT = "SELECT country, source_id FROM ({day}) WHERE ('0x' || substr(md5('3:' || source_id), 1, 8))::BIGINT % 100 < 10"
_NIGHTS = f"""{_NIGHT.format(day=_DAY)} UNION {_NIGHT.format(day=_REG.format(lo='2024-01-29 00:00:00').replace('2024-01-30 23', '2024-01-29 23'))}"""


@query("audience_delivery", f"""
    SELECT 'control_' || country || '.csv' AS file_name, source_id FROM ({_NIGHTS})
    UNION ALL SELECT 'segment_' || country || '.csv', source_id FROM ({_MONTH} EXCEPT ({_NIGHTS}))""", "ev")
def q_audience_delivery(s: Source):
    # Two nights: the second adds to the control groups of the first, and replaces the files.
    folder = work_dir(s.spark)
    for night in (RUN - timedelta(days=1), RUN):
        audience.audience_delivery(voice(s), s.id_map, f"{folder}/tables", lambda kind, country: F.concat(
            F.lit(f"{folder}/out/"), kind, F.lit("_"), F.replace(country, F.lit(" "), F.lit("-")), F.lit(".csv")), night.date(),
            CATEGORY, APP, GOAL, seed=3)
    rows = read_csv(s.spark, f"{folder}/out", schema(source_id="str"))
    name = F.replace(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1), F.lit("-"), F.lit(" "))
    return rows.select(name.alias("file_name"), "source_id")


@query("registrations_18_months", """
    SELECT DISTINCT source_id FROM ev WHERE event_type = 'signup' AND k % 10 = 7 AND country = 'AMERICA'
    AND partition_time BETWEEN TIMESTAMP '2022-07-31' AND TIMESTAMP '2024-01-30 23:00:00'""", "ev")
def q_registrations_18_months(s: Source):
    events = s.ev.select("source_id", F.col("event_type").alias("category"), "country", "partition_time", F.format_string(
        '{"appid": "app", "exe_goal": "%s"}', (F.col("k") % 10).cast("string")).alias("payload"))
    listed = audience.registered_months(events, RUN.date(), CATEGORY, audience.payload_match("app", "7", "json"), countries=("AMERICA",))
    path = export_csv(listed, f"{work_dir(s.spark)}/out/registered.csv", ["source_id"])
    return read_csv(s.spark, path, schema(source_id="str"))


def _audiences(s: Source) -> tuple[DataFrame, DataFrame]:
    return audience.audience_job(voice(s), s.id_map, old_control(s), RUN.date(), CATEGORY, APP, GOAL, seed=3)
