"""Order book, creative mapping, campaign metadata, imports and reports."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from adspark.plans import conversions, delivery, imports, mapping, reports
from adspark.schemas import schema
from adspark.sinks import page_of
from adspark.sources import read_csv
from adspark.stage import work_dir, written_counted
from adspark.workload.measurement import TIME_SQL, _CPM, first, rounded, shown, visits
from adspark.workload.registry import query
from adspark.workload.sql import D0, USAGE0, VIEWS, W0, W1, WA
from adspark.workload.tables import MAP_RUN, ORDER_RUN, PARAMS as P, Source

# ---- order book

_VERSION = "o_orderdate + to_seconds(o_orderkey)"
BOOK_VIEWS = f"""
WITH so AS (
    SELECT * FROM (
      SELECT o_custkey AS sales_order_id,
             CASE o_custkey % 3 WHEN 0 THEN 'IO-1 | order ' || o_custkey WHEN 1 THEN 'plain ' || o_custkey ELSE 'IO ' || o_custkey || '|' END AS sales_order_name,
             CAST(o_orderdate AS DATE) AS order_start, CAST(o_orderdate AS DATE) + 60 AS order_end, o_custkey % 10 AS advertiser_id,
             'advertiser ' || (o_custkey % 10) AS advertiser_name,
             CASE WHEN o_orderpriority = '5-LOW' THEN 'Closed Lost' ELSE 'Open' END AS sales_stage,
             CASE WHEN o_orderstatus = 'P' THEN 'deleted' ELSE 'active' END AS order_status,
             row_number() OVER (PARTITION BY o_custkey ORDER BY {_VERSION} DESC) AS rn
      FROM orders WHERE o_custkey % 10 IN (SELECT s_suppkey FROM supplier)) WHERE rn = 1),
nums AS (
    SELECT sales_order_id, TRY_CAST(replace(field_value, 'ORD-', '') AS BIGINT) AS order_number FROM (
      SELECT o_custkey AS sales_order_id, 'ORD-' || o_custkey || CASE WHEN o_custkey % 11 = 0 THEN 'X' ELSE '' END AS field_value,
             row_number() OVER (PARTITION BY 'ORD-' || o_custkey || CASE WHEN o_custkey % 11 = 0 THEN 'X' ELSE '' END ORDER BY {_VERSION} DESC) AS rn
      FROM orders WHERE o_orderstatus <> 'F' AND o_custkey IN (SELECT sales_order_id FROM so)) WHERE rn = 1),
line AS (
    SELECT * FROM (
      SELECT o_custkey AS sales_order_id, l_orderkey * 10 + l_linenumber AS line_item_id, 'line ' || (l_orderkey * 10 + l_linenumber) AS line_item_name,
             'product ' || l_partkey AS product_name, l_partkey AS product_id, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS line_item_start,
             CAST(CAST(l_shipdate AS DATE) + 14 AS TIMESTAMP) + INTERVAL 86399 SECOND AS line_item_end,
             CASE WHEN l_linenumber % 2 = 0 THEN 'CPM' ELSE 'Flat Rate' END AS cost_type, CAST(trunc(l_quantity) AS BIGINT) AS quantity,
             CAST(trunc(l_quantity * 1000) AS BIGINT) AS production_quantity, CASE WHEN l_returnflag = 'N' THEN 'spots' ELSE 'views' END AS unit_type,
             CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END::BIGINT AS is_added_value, l_tax AS added_value_amount,
             l_extendedprice AS net_cost, l_discount AS net_unit_cost, 'live' AS line_item_status,
             CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey * 10 + l_linenumber - 1 END AS parent_line_item_id,
             row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber ORDER BY l_shipdate + to_seconds(l_partkey * 1000 + l_suppkey) DESC) AS rn
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      WHERE NOT (l_linestatus = 'F' AND l_returnflag = 'A') AND o_custkey IN (SELECT sales_order_id FROM so)) WHERE rn = 1),
prod AS (SELECT p_partkey AS product_id, p_type AS creative_spec FROM part WHERE p_size % 10 <> 0),
ctry AS (SELECT p_partkey AS product_id, CASE p_partkey % 7 WHEN 0 THEN 'South Korea' WHEN 2 THEN 'O&O' WHEN 4 THEN 'Canada' WHEN 5 THEN 'France' ELSE 'USA' END AS product_country FROM part)"""
_PACKAGE = ("line_item_name", "product_name", "is_added_value", "added_value_amount", "cost_type", "net_unit_cost", "net_cost",
            "unit_type", "quantity", "production_quantity", "line_item_start", "line_item_end")


@query("order_book", BOOK_VIEWS + f"""
SELECT * FROM (
  SELECT so.sales_order_id, trim(COALESCE(NULLIF(split_part(sales_order_name, '|', 2), ''), NULLIF(split_part(sales_order_name, '|', 1), ''), sales_order_name)) AS sales_order_name,
         order_start, order_end, order_number, advertiser_id, advertiser_name, sales_stage, order_status, ctry.product_country,
         l.line_item_status, COALESCE(l.parent_line_item_id, l.line_item_id) AS line_item_id, COALESCE(pp.creative_spec, lp.creative_spec) AS creative_spec,
         {', '.join(f'COALESCE(p.{c}, l.{c}) AS {c}' for c in _PACKAGE)}
  FROM so LEFT JOIN nums ON nums.sales_order_id = so.sales_order_id LEFT JOIN line l ON l.sales_order_id = so.sales_order_id
  LEFT JOIN line p ON p.line_item_id = l.parent_line_item_id LEFT JOIN prod lp ON lp.product_id = l.product_id
  LEFT JOIN prod pp ON pp.product_id = p.product_id LEFT JOIN ctry ON ctry.product_id = l.product_id
  WHERE order_status NOT IN ('closed_lost', 'deleted') AND sales_stage NOT IN ('Closed Lost'))
WHERE order_start >= DATE '1999-12-01' OR order_start IS NULL OR order_end >= DATE '1999-12-01' OR order_end IS NULL
   OR line_item_start >= DATE '1999-12-01' OR line_item_start IS NULL OR line_item_end >= DATE '1999-12-01' OR line_item_end IS NULL""")
def q_order_book(s: Source):
    advertisers = s.supplier.select(F.col("s_suppkey").alias("advertiser_id"))
    return mapping.order_book(s.sales_orders, s.order_fields, s.order_lines, s.products, s.product_fields, ORDER_RUN,
                              advertisers, prefix="ORD-").drop("last_update")


# ---- creative mapping

VIEWS["book"] = f"""
    SELECT 1000 + p_partkey % 25 AS sales_order_id, 1000 + p_partkey % 25 AS order_number, 'order ' || (p_partkey % 25) AS order_name,
           p_partkey % 10 AS advertiser_id, 'advertiser ' || (p_partkey % 10) AS advertiser_name,
           CASE WHEN p_partkey % 5 = 0 THEN 'USA' WHEN p_partkey % 5 = 1 THEN 'Canada' ELSE 'NATION_' || (p_partkey % 25) END AS product_country,
           p_partkey AS line_item_id, p_brand AS line_item_name, p_size % 3 = 0 AS added, p_size::DOUBLE AS added_value_amount,
           p_retailprice / 100 AS rate, p_retailprice AS net_cost, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size * 1000 AS BIGINT) END AS production_quantity,
           {D0} + to_days(CAST(p_partkey % 15 AS INTEGER)) AS line_item_start, {D0} + to_days(CAST(p_partkey % 15 + 14 AS INTEGER)) AS line_item_end,
           p_partkey % 25 AS campaign_id
    FROM (SELECT *, CASE WHEN p_partkey % 25 = 24 THEN 'archived' ELSE 'live' END AS state FROM part) WHERE state <> 'archived'"""
VIEWS["seen"] = """
    SELECT DISTINCT country, campaign_id, flight_id, creative_id FROM log
    WHERE event IN ('impression', 'click', 'tracker') AND dropped IS NULL"""
VIEWS["seen_abroad"] = """
    SELECT DISTINCT b.line_item_id, l.country, l.campaign_id, CASE WHEN l.creative_id % 7 <> 0 THEN l.flight_id END AS flight_id,
           l.creative_id FROM log l JOIN book b
      ON b.campaign_id = l.campaign_id AND l.event_time BETWEEN b.line_item_start AND b.line_item_end
    WHERE l.event IN ('impression', 'click') AND l.dropped IS NULL"""
_MAPPED = """
    SELECT b.advertiser_name, b.product_country, s.country, CASE WHEN b.product_country = 'USA' THEN 'US' ELSE c.code END AS target_country,
           COALESCE(c.region, '') AS region, b.order_number, b.campaign_id, 'campaign ' || b.campaign_id AS campaign_name, s.flight_id,
           f.flight_name, f.flight_start, f.flight_end, b.line_item_id, b.line_item_name, p.p_name AS creative_name, {creative} AS creative_id,
           b.line_item_start, b.line_item_end, b.advertiser_id, b.order_name, DATE '2024-01-01' AS campaign_start, DATE '2024-01-31' AS campaign_end,
           'CPM' AS rate_type, b.rate, {budget} AS booked_budget, {booked} AS booked_impressions, {delivered} AS budget_delivered
    FROM book b LEFT JOIN {seen} LEFT JOIN part p ON p.p_partkey = s.creative_id
    LEFT JOIN (SELECT n_name, 'N' || n_nationkey AS code, r_name AS region FROM nation JOIN region ON r_regionkey = n_regionkey) c ON c.n_name = b.product_country
    LEFT JOIN (SELECT DISTINCT p_partkey % 50 AS flight_id, 'flight ' || (p_partkey % 50) AS flight_name,
                 TIMESTAMP '2024-01-01' + to_days(CAST((p_partkey % 50) % 15 AS INTEGER)) AS flight_start,
                 TIMESTAMP '2024-01-01' + to_days(CAST((p_partkey % 50) % 15 + 14 AS INTEGER)) AS flight_end FROM part) f ON f.flight_id = s.flight_id
    WHERE b.product_country {where} ('USA', 'Canada', 'Mexico')"""


@query("creative_mapping", _MAPPED.format(
    creative="s.creative_id", seen="seen s ON s.campaign_id = b.campaign_id", where="IN", delivered="0::DOUBLE",
    budget="CASE WHEN b.added THEN b.added_value_amount ELSE b.net_cost END", booked="COALESCE(b.production_quantity, 0)")
    + " UNION " + _MAPPED.format(
    creative="s.creative_id", seen="seen_abroad s ON s.line_item_id = b.line_item_id", where="NOT IN", budget="b.net_cost",
    booked="b.production_quantity", delivered="COALESCE(b.net_cost, b.added_value_amount, 0)"), "book", "seen", "seen_abroad")
def q_creative_mapping(s: Source):
    # Some exposures abroad have no flight.
    regional = s.regional.withColumn("flight_id", F.when(F.col("creative_id") % 7 != 0, F.col("flight_id")))
    return mapping.creative_mapping(s.book, s.campaigns, s.oms, s.log, regional, s.creatives, s.flights,
                                    s.country_map, MAP_RUN).drop("last_update")


@query("active_campaigns", """
    SELECT DISTINCT order_number, campaign_id FROM book
    WHERE line_item_end >= TIMESTAMP '2024-01-01' AND line_item_start <= TIMESTAMP '2024-01-31 23:59:59'""", "book")
def q_active_campaigns(s: Source):
    return mapping.active_campaigns(s.book, s.campaigns, s.oms, MAP_RUN)


# ---- campaign metadata by order number

VIEWS["order_ids"] = "SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'MACHINERY'"
_META_LINES = f"""
    SELECT * FROM (SELECT o_custkey, l_orderkey * 10 + l_linenumber AS line_item_id, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS line_item_start,
        l_partkey AS product_id, row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
                                    ORDER BY l_shipdate + to_seconds(l_partkey * 1000 + l_suppkey) DESC) AS rn
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey IN (SELECT id FROM order_ids)) WHERE rn = 1"""
_META = f"""
    SELECT DISTINCT i.id AS order_number, 'crm ' || i.id AS crm_campaign_id, i.id AS sales_order_id, so.order_start, i.id AS campaign_id,
           r.flight_id, r.creative_id, p.p_name AS creative_name, l.line_item_id, l.line_item_start{{extra}}
    FROM order_ids i JOIN (SELECT * FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_start, row_number() OVER (
        PARTITION BY o_custkey ORDER BY {_VERSION} DESC) AS rn FROM orders) WHERE rn = 1) so ON so.o_custkey = i.id
    JOIN (SELECT DISTINCT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS flight_id,
                 CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS creative_id FROM events {{where}}) r ON r.user_id = i.id
    JOIN part p ON p.p_partkey = r.creative_id
    JOIN ({_META_LINES}) l ON l.o_custkey = i.id{{more}}"""


def _order_meta(s: Source, **kwargs) -> DataFrame:
    numbers = s.customer.where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("order_number"))
    version = F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate"))
    crm = s.orders.select(
        F.concat(F.lit("ORD-"), F.col("o_custkey")).alias("ticket"), F.concat(F.lit("crm "), F.col("o_custkey")).alias("crm_campaign_id"),
        F.col("o_custkey").alias("sales_order_id"), F.lit("order").alias("sales_order_name"), version.alias("last_modified"))
    key = F.col("c_custkey")
    day = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    campaigns = s.customer.select(key.alias("campaign_id"), F.col("c_name").alias("campaign_name"), day.alias("campaign_start"),
                                  F.timestamp_add("DAY", F.lit(9), day).alias("campaign_end"))
    oms = s.order_lines.select(F.col("sales_order_id").alias("campaign_id"), F.col("sales_order_id").alias("order_external_id"),
                               F.col("line_item_id").alias("line_external_id"), F.lit("CPM").alias("rate_type"),
                               F.lit(1.5).alias("net_unit_cost"))
    flights = s.ev.select(F.col("device_id").alias("campaign_id"), (F.col("k") % 5).alias("flight_id")).distinct().select(
        "*", F.concat(F.lit("flight "), F.col("flight_id")).alias("flight_name"), day.alias("flight_start"), day.alias("flight_end"))
    return mapping.campaign_meta_by_order(numbers, crm, s.sales_orders, campaigns, oms, flights, s.creatives, s.order_lines,
                                          prefix="ORD-", **kwargs)


def _ran(s: Source) -> DataFrame:
    return s.ev.select(F.col("device_id").alias("campaign_id"), (F.col("k") % 5).alias("flight_id"),
                       (F.col("k") % 5).alias("creative_id"), F.col("ts").alias("partition_time"))


_META_OUT = ("order_number", "crm_campaign_id", "sales_order_id", "order_start", "campaign_id", "flight_id", "creative_id",
             "creative_name", "line_item_id", "line_item_start")


@query("campaign_meta_by_order", _META.format(extra="", where="", more=""), "order_ids")
def q_meta_by_order(s: Source):
    return _order_meta(s, combinations=_ran(s)).select(*_META_OUT)


@query("campaign_meta_from_log", _META.format(
    extra=", q.p_name AS product_name", where="WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-14'",
    more=" JOIN part q ON q.p_partkey = l.product_id"), "order_ids")
def q_meta_from_log(s: Source):
    return _order_meta(s, log=_ran(s), products=s.products).select(*_META_OUT, "product_name")


# ---- imports

RUN = date(2024, 1, 22)
_HELD = "event = 'impression' AND event_time < TIMESTAMP '2024-01-15'"
_IMPORT = """event IN ('impression', 'click') AND dropped IS NULL AND event_time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-21 23:59:59'"""
_EXPOSED = """SELECT DISTINCT 1000 + campaign_id AS order_number, device_id, event_time AS exposure_time, country, campaign_id, creative_id, flight_id, event
    FROM log WHERE campaign_id <> 24 AND """


@query("import_exposures", f"SELECT *, DATE '2024-01-22' AS date_imported FROM ({_EXPOSED} {_IMPORT} EXCEPT {_EXPOSED} {_HELD})", "log")
def q_import_exposures(s: Source):
    held = s.regional.where((F.col("event") == "impression") & (F.col("event_time") < F.lit("2024-01-15").cast("timestamp_ntz")))
    held = held.select(*imports.EXPOSURE_KEYS, F.lit("2024-01-15").cast("date").alias("date_imported"))
    campaigns = mapping.active_campaigns(s.book, s.campaigns, s.oms, RUN)
    return imports.import_exposures(s.log, campaigns, held, RUN)


@query("import_exposures_nightly", f"""
    SELECT *, CASE WHEN exposure_time < TIMESTAMP '2024-01-15' THEN DATE '2024-01-15' ELSE DATE '2024-01-22' END AS date_imported
    FROM ({_EXPOSED} {_IMPORT.replace("'2024-01-08'", "'2024-01-01'")})""", "log")
def q_import_exposures_nightly(s: Source):
    # Two nights a week apart, the second one twice.
    path = f"{work_dir(s.spark)}/exposures"
    campaigns = mapping.active_campaigns(s.book, s.campaigns, s.oms, RUN)
    for night in (RUN - timedelta(days=7), RUN, RUN):
        imports.import_exposures_into(s.log, campaigns, path, night)
    return s.spark.read.parquet(path)


_USED = """
    SELECT device_id, {at} AS usage_time, country, app_id, {minutes} AS minutes, COUNT(*) AS usage_count, DATE '2024-01-22' AS date_imported
    FROM sessions WHERE app_id IN (SELECT app_id FROM apps WHERE product_name = 'app_0') {more}
      AND partition_time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-21 23:59:59' AND NOT (country = 'ASIA' AND start_time < TIMESTAMP '2024-01-15')
    GROUP BY ALL"""


def _usage_import(s: Source, source: DataFrame, region: str) -> DataFrame:
    old = imports.regional_usage(source, s.id_map, s.apps, P, region, RUN).where(
        (F.col("country") == "ASIA") & (F.col("usage_time") < F.lit("2024-01-15").cast("timestamp_ntz")))
    return imports.import_app_usage(source, s.id_map, s.apps, old, P, region, RUN)


@query("import_app_usage", _USED.format(
    at="start_time", minutes="CAST(SUM(datediff('minute', start_time, end_time)) AS BIGINT)",
    more="AND datediff('second', start_time, end_time) >= 60"), "sessions", "apps")
def q_import_app_usage(s: Source):
    return _usage_import(s, s.sessions, "eu")


@query("import_app_opens", _USED.format(at="start_time", minutes="0::BIGINT", more=""), "sessions", "apps")
def q_import_app_opens(s: Source):
    return _usage_import(s, s.app_opens, "nordics")


# ---- reports

# The weekly report does not restrict devices to the universe.
VIEWS["meta"] = f"SELECT * FROM mapping WHERE line_item_start < {W1} AND line_item_end >= {W0}"
VIEWS["delivered"] = f"""
    SELECT l.device_id, l.country, l.event_time AS exposure_time, l.campaign_id, l.flight_id, l.creative_id, l.event FROM log l
    WHERE l.partition_time BETWEEN {W0} AND {W1} AND l.event IN ('impression', 'click') AND l.dropped IS NULL AND EXISTS (
      SELECT 1 FROM meta c WHERE c.campaign_id = l.campaign_id AND c.flight_id = l.flight_id AND c.creative_id = l.creative_id
        AND c.target_country = l.country)"""
VIEWS["installed"] = f"""
    SELECT device_id, source_id, country, MIN(usage_time) AS first_open FROM usage GROUP BY ALL
    HAVING MIN(usage_time) BETWEEN {W0} AND {WA}"""
VIEWS["first_pixels"] = f"""
    SELECT device_id, country, segment_id, MIN(visit_time) AS visit_time FROM pixels GROUP BY ALL
    HAVING MIN(visit_time) BETWEEN {W0} AND {WA}"""


def _touched(conv: str, ts: str, part: str, cols: str) -> str:
    return f"""
    SELECT * FROM (SELECT i.campaign_id, i.flight_id, i.creative_id, i.country, i.device_id, {cols},
        row_number() OVER (PARTITION BY {part} ORDER BY i.exposure_time DESC, i.campaign_id, i.flight_id, i.creative_id) AS rn
      FROM delivered i JOIN {conv} c ON c.device_id = i.device_id AND c.country = i.country AND i.exposure_time <= c.{ts}
        AND datediff('day', i.exposure_time, c.{ts}) <= 7 WHERE i.event = 'impression') WHERE rn = 1"""


_VISIT_PART = "c.device_id, c.segment_id, c.country, c.visit_time"
VIEWS["opened"] = _touched(f"(SELECT * FROM usage WHERE usage_time BETWEEN {W0} AND {WA})", "usage_time",
                           "c.device_id, c.source_id, c.usage_time", "c.minutes")
VIEWS["converted"] = _touched("installed", "first_open", "c.device_id, c.source_id, c.first_open", "c.source_id")
VIEWS["visited"] = _touched("pixels", "visit_time", _VISIT_PART, "c.segment_id")
VIEWS["first_visited"] = _touched("first_pixels", "visit_time", _VISIT_PART, "c.segment_id")

_BY = "campaign_id, flight_id, creative_id, country"
_ON = " AND ".join(f"x.{k} = m.{k}" for k in ("campaign_id", "flight_id", "creative_id")) + " AND x.country = m.target_country"


def _arm(alias: str, select: str, rel: str, where: str = "TRUE", by: str = _BY, on: str = _ON) -> str:
    return f" LEFT JOIN (SELECT {by}, {select} FROM {rel} WHERE {where} GROUP BY ALL) {alias} ON {on.replace('x.', alias + '.')}"


def _steps(names) -> str:
    return ", ".join(f"CAST(SUM(CASE WHEN tracker IN {tuple(t)} THEN 1 END) AS BIGINT) AS {n}" for n, t in names.items())


_WEEKLY = f"""
    SELECT DISTINCT DATE '2024-01-22' AS report_execution_date, m.advertiser_id, m.advertiser_name AS advertiser, replace(m.order_name, ',', '') AS insertion_order_name,
      m.campaign_id, replace(m.campaign_name, ',', '') AS campaign_name, m.campaign_start AS campaign_start_date, m.campaign_end AS campaign_end_date,
      m.flight_id, m.flight_name, m.line_item_start AS flight_start_date, m.line_item_end AS flight_end_date, m.line_item_id, m.line_item_name,
      m.creative_id, m.creative_name, m.rate_type, m.rate, m.booked_impressions AS placement_impressions_booked, m.booked_budget,
      COALESCE(i.n, 0) AS impressions_delivered,
      round(CASE WHEN rate_type = 'CPM' THEN COALESCE(i.n, 0)::DOUBLE / 1000 * rate WHEN rate_type = 'Flat Rate' THEN booked_budget END, 6) AS budget_delivered,
      COALESCE(k.n, 0) AS clicks, round(CASE WHEN COALESCE(i.n, 0) = 0 THEN 0 ELSE COALESCE(k.n, 0)::DOUBLE / i.n END, 6) AS ctr,
      round(CASE WHEN COALESCE(k.n, 0) = 0 THEN 0 ELSE CASE WHEN rate_type = 'CPM' THEN COALESCE(i.n, 0)::DOUBLE / 1000 * rate ELSE booked_budget END / k.n END, 6) AS cpc,
      COALESCE(i.reach, 0) AS reach, round(CASE WHEN COALESCE(i.n, 0) = 0 THEN 0 ELSE i.n::DOUBLE / NULLIF(i.reach, 0) END, 6) AS frequency,
      ins.installs, round(o.minutes, 6) AS average_exposed_time_spent_minutes, COALESCE(v.video_start, 0) AS video_start, COALESCE(v.video_25, 0) AS video_25,
      COALESCE(v.video_50, 0) AS video_50, COALESCE(v.video_75, 0) AS video_75, COALESCE(v.video_completions, 0) AS video_completions,
      o.openers AS total_exposed_app_openers, o.n AS total_exposed_app_opens, e.n AS first_time_exposed_app_opens,
      tv.signup AS total_signup_page_visit, ev2.signup AS total_exposed_signup_page_visits, fv.signup AS total_first_time_exposed_signup_page_visits,
      tv.homepage AS total_homepage_page_visits, ev2.homepage AS total_exposed_homepage_page_visits, fv.homepage AS total_first_time_exposed_homepage_page_visits,
      m.target_country AS country
    FROM meta m"""
_SEG = ("CAST(SUM(CASE WHEN segment_id = 0 THEN 1 END) AS BIGINT) AS signup, CAST(SUM(CASE WHEN segment_id = 1 THEN 1 END) AS BIGINT) AS homepage")


def _weekly(r: str = "") -> str:
    """The report from the views of the log, or with ``r_`` from those of the regional copies."""
    return (
        _WEEKLY + _arm("i", "COUNT(*) AS n, COUNT(DISTINCT device_id) AS reach", f"{r}delivered", "event = 'impression'")
        + _arm("k", "COUNT(*) AS n", f"{r}delivered", "event = 'click'")
        + _arm("o", "COUNT(*) AS n, AVG(minutes) AS minutes, COUNT(DISTINCT device_id) AS openers", f"{r}opened")
        + _arm("e", "COUNT(DISTINCT device_id) AS n", f"{r}converted")
        + _arm("v", _steps(delivery.VIDEO_STEPS), f"{r}log", f"event = 'tracker' AND partition_time BETWEEN {W0} AND {WA}")
        + _arm("ev2", _SEG, f"{r}visited") + _arm("fv", _SEG, f"{r}first_visited")
        + _arm("ins", "COUNT(DISTINCT device_id) AS installs", f"{r}installed", by="country", on="x.country = m.target_country")
        + _arm("tv", _SEG, f"{r}pixels", by="country", on="x.country = m.target_country"))


WEEKLY_SQL = _weekly()
_WEEKLY_VIEWS = ("meta", "delivered", "opened", "converted", "visited", "first_visited", "installed", "pixels", "log")
_WEEKLY_ROUND = ("budget_delivered", "ctr", "cpc", "frequency", "average_exposed_time_spent_minutes")


@query("partner_weekly_report", WEEKLY_SQL, *_WEEKLY_VIEWS)
def q_partner_weekly_report(s: Source):
    return rounded(reports.partner_weekly_report(s.report_tables, P), *_WEEKLY_ROUND)


_SHARED = "CASE WHEN device_id % 17 <> 0 THEN device_id - device_id % 2 END AS device_id"
VIEWS["r_log"] = f"""
    SELECT event, event_time, {_SHARED}, country, campaign_id, flight_id, creative_id, CAST(NULL AS BIGINT) AS segment_id,
           CAST(NULL AS VARCHAR) AS tracker, dropped, event_time AS partition_time FROM log WHERE dropped IS NULL"""
VIEWS["r_usage"] = f"""
    SELECT * REPLACE (CASE WHEN device_id % 17 <> 0 THEN device_id - device_id % 2 END AS device_id) FROM (
      SELECT device_id, country, start_time AS usage_time, datediff('minute', start_time, end_time) AS m FROM sessions
      WHERE start_time BETWEEN {USAGE0} AND {WA})"""
VIEWS["r_used"] = "SELECT device_id, country, usage_time, CAST(SUM(m) AS BIGINT) AS minutes FROM r_usage GROUP BY ALL"
VIEWS["r_delivered"] = VIEWS["delivered"].replace("FROM log l", "FROM r_log l")
VIEWS["r_installed"] = f"""
    SELECT device_id, country, MIN(usage_time) AS first_open FROM r_used GROUP BY ALL HAVING MIN(usage_time) BETWEEN {W0} AND {WA}"""
VIEWS["r_pixels"] = VIEWS["pixels"].replace("FROM log", "FROM r_log")
VIEWS["r_first_pixels"] = VIEWS["first_pixels"].replace("FROM pixels", "FROM r_pixels")
for _name, _conv, _ts, _part, _col in (
        ("opened", f"(SELECT * FROM r_used WHERE usage_time BETWEEN {W0} AND {WA})", "usage_time", "c.device_id, c.usage_time", "c.minutes"),
        ("converted", "r_installed", "first_open", "c.device_id, c.first_open", "c.first_open"),
        ("visited", "r_pixels", "visit_time", _VISIT_PART, "c.segment_id"),
        ("first_visited", "r_first_pixels", "visit_time", _VISIT_PART, "c.segment_id")):
    VIEWS[f"r_{_name}"] = _touched(_conv, _ts, _part, _col).replace("FROM delivered i", "FROM r_delivered i").replace(
        "i.creative_id) AS rn", "i.creative_id, i.country) AS rn")
_REGIONAL_VIEWS = ("meta", *[f"r_{v}" for v in _WEEKLY_VIEWS if v != "meta"])


@query("partner_weekly_report_regional", _weekly("r_"), *_REGIONAL_VIEWS)
def q_partner_weekly_report_regional(s: Source):
    return rounded(reports.partner_weekly_report(s.report_tables, P, "regional"), *_WEEKLY_ROUND)


_REGIONS = {"na": ("AMERICA",), "eu": ("EUROPE",), "rest": ("ASIA", "AFRICA", "MIDDLE EAST")}


@query("partner_weekly_reports", f"""
    SELECT *, CASE country WHEN 'AMERICA' THEN 'na' WHEN 'EUROPE' THEN 'eu' ELSE 'rest' END AS region FROM ({WEEKLY_SQL})""", *_WEEKLY_VIEWS)
def q_partner_weekly_reports(s: Source):
    return rounded(reports.partner_weekly_reports(s.report_tables, _REGIONS, P), *_WEEKLY_ROUND)


_MIXED = f"""
    SELECT * FROM ({WEEKLY_SQL}) WHERE country = 'AMERICA' UNION ALL SELECT * FROM ({_weekly("r_")}) WHERE country <> 'AMERICA'"""


@query("partner_weekly_reports_mixed", f"""
    SELECT *, CASE country WHEN 'AMERICA' THEN 'na' WHEN 'EUROPE' THEN 'eu' ELSE 'rest' END AS region FROM ({_MIXED})""",
       *_WEEKLY_VIEWS, *_REGIONAL_VIEWS)
def q_partner_weekly_reports_mixed(s: Source):
    return rounded(reports.partner_weekly_reports(s.report_tables, _REGIONS, P, home=["na"]), *_WEEKLY_ROUND)


_IN_COUNTRY = "rank() OVER (PARTITION BY country ORDER BY advertiser, campaign_id, flight_id, line_item_id, creative_id, impressions_delivered)"
_FILED = ("campaign_id", "flight_id", "line_item_id", "creative_id", "impressions_delivered", "clicks", "reach", "installs",
          "total_exposed_app_openers", "total_exposed_app_opens", "total_signup_page_visit", "budget_delivered")
_OUT = "'international/weekly/brand_' || lower({}) || '_weekly_campaign_2024-01-08_2024-01-14_'"


@query("weekly_delivery", f"""
    SELECT report_execution_date, advertiser, {', '.join(_FILED)},
           {_OUT.format('country')} || right('000' || CAST(ceil({_IN_COUNTRY} / 20.0) AS BIGINT), 3) || '.csv' AS file_name
    FROM ({_MIXED})
    UNION ALL SELECT DATE '2024-01-22', NULL, {', '.join(['NULL'] * len(_FILED))}, {_OUT.format("'nowhere'")} || '001.csv'""",
       *_WEEKLY_VIEWS, *_REGIONAL_VIEWS)
def q_weekly_delivery(s: Source):
    # Files of all countries, one of which has no data, read back.
    folder = work_dir(s.spark)
    reports.weekly_delivery(s.report_tables, {**_REGIONS, "none": ("NOWHERE",)}, P, "brand_", f"{folder}/us",
                            f"{folder}/international", home=["na"], max_rows=20)
    numbers = {"budget_delivered": "float"}
    columns = schema(**{c: "date" if c == "report_execution_date" else "int" if c in _FILED else "str"
                        for c in reports.REPORT_COLUMNS} | numbers)
    rows = read_csv(s.spark, f"{folder}/*/weekly", columns)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/weekly/[^/]+)$", 1)
    rows = rows.select("report_execution_date", "advertiser", *_FILED, F.replace(name, F.lit("%20"), F.lit(" ")).alias("file_name"))
    return rounded(rows, "budget_delivered")


_RANK = "rank() OVER (ORDER BY advertiser, country, campaign_id, flight_id, line_item_id, creative_id, impressions_delivered)"


@query("ranked_pages", f"""
    SELECT advertiser, country, campaign_id, flight_id, line_item_id, creative_id, impressions_delivered, {_RANK} AS row_num,
           CAST(ceil({_RANK} / 100.0) AS BIGINT) AS page FROM (
      SELECT m.advertiser_name AS advertiser, m.target_country AS country, m.campaign_id, m.flight_id, m.line_item_id, m.creative_id,
             COALESCE(i.n, 0) AS impressions_delivered FROM meta m {_arm("i", "COUNT(*) AS n", "delivered", "event = 'impression'")})""", "meta", "delivered")
def q_ranked_pages(s: Source):
    meta = mapping.campaign_meta(s.mapping, P)
    stats = delivery.delivery_stats(delivery.delivery(s.log, mapping.report_creatives(meta), P), reports.BY_COUNTRY)
    rows = meta.withColumn("country", F.col("target_country")).join(stats, list(reports.BY_COUNTRY), "left").select(
        F.col("advertiser_name").alias("advertiser"), "country", "campaign_id", "flight_id", "line_item_id", "creative_id",
        F.coalesce("impressions", F.lit(0)).alias("impressions_delivered"))
    return reports.ranked_report(rows).withColumn("page", page_of(F.col("row_num"), 100))


CREATIVE_SQL = f"""
    SELECT 'app_0' AS campaign_name, m.campaign_id, m.placement_id, m.creative_id, m.creative_name, m.placement_name, m.line_item_start, m.line_item_end,
      COALESCE(i.i, 0) AS impression, COALESCE(i.c, 0) AS click, o.n AS count_exposed_app_opens, f.n AS count_exposed_first_app_opens,
      o.minutes AS total_time_spent_min, round(o.minutes / 60, 2) AS total_time_spent_hour, (SELECT COUNT(*) FROM fresh) AS downloads,
      round(COALESCE(i.c, 0)::DOUBLE / NULLIF(i.i, 0) * 100, 6) AS ctr,
      round(COALESCE(i.i, 0)::DOUBLE / 1000 * {_CPM} / NULLIF(o.n, 0), 6) AS cpi, round(COALESCE(i.i, 0)::DOUBLE / 1000 * {_CPM} / NULLIF(f.n, 0), 6) AS cac,
      round(COALESCE(i.i, 0)::DOUBLE / 1000 * {_CPM}, 6) AS spend
    FROM cmap m
    LEFT JOIN (SELECT campaign_id, creative_id, CAST(SUM(CASE WHEN event = 'impression' THEN 1 ELSE 0 END) AS BIGINT) AS i,
                 CAST(SUM(CASE WHEN event = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS c FROM shown GROUP BY ALL) i
      ON i.campaign_id = m.campaign_id AND i.creative_id = m.creative_id
    LEFT JOIN (SELECT campaign_id, creative_id, COUNT(*) AS n, CAST(SUM(minutes) AS BIGINT) AS minutes FROM pairs GROUP BY ALL) o
      ON o.campaign_id = m.campaign_id AND o.creative_id = m.creative_id
    LEFT JOIN (SELECT campaign_id, creative_id, COUNT(*) AS n FROM (
        SELECT s.campaign_id, s.creative_id, row_number() OVER (PARTITION BY f.device_id, f.country, f.first_open
            ORDER BY s.exposure_time DESC, s.campaign_id, s.flight_id, s.creative_id) AS rn
        FROM shown s JOIN (SELECT * FROM fresh WHERE first_open >= (SELECT MIN(line_item_start) FROM cmap)) f
          ON f.device_id = s.device_id AND f.country = s.country AND s.exposure_time <= f.first_open
         AND datediff('day', s.exposure_time, f.first_open) <= 7) WHERE rn = 1 GROUP BY ALL) f
      ON f.campaign_id = m.campaign_id AND f.creative_id = m.creative_id"""
VIEWS["fresh"] = f"""
    SELECT u.device_id, u.source_id, u.country, MIN(u.usage_time) AS first_open
    FROM usage u JOIN uni ON uni.device_id = u.device_id AND uni.country = u.country
    GROUP BY ALL HAVING MIN(u.usage_time) >= {W0}"""


@query("creative_report", CREATIVE_SQL, "cmap", "shown", "pairs", "fresh")
def q_creative_report(s: Source):
    return rounded(reports.creative_report(s.report_tables, P), "ctr", "cpi", "cac", "spend")


_DAYS = "SELECT CAST(first_open AS DATE) AS day, COUNT(*) AS n FROM first GROUP BY 1"
_SEGMENT = "SELECT CAST(visit_time AS DATE) AS day, COUNT(*) AS n FROM first_visits WHERE segment_id = {} GROUP BY 1"


@query("download_table", f"""
    SELECT d.day, d.n AS app_downloads, COALESCE(a.n, 0) AS daily_visits_signup, COALESCE(b.n, 0) AS daily_visits_homepage
    FROM ({_DAYS}) d LEFT JOIN ({_SEGMENT.format(0)}) a ON a.day = d.day LEFT JOIN ({_SEGMENT.format(1)}) b ON b.day = d.day""", "first", "first_visits")
def q_download_table(s: Source):
    return reports.download_table(first(s), conversions.first_visit(visits(s), P), P)


@query("download_table_all_days", f"""
    SELECT day, CAST(SUM(a) AS BIGINT) AS app_downloads, CAST(SUM(b) AS BIGINT) AS daily_visits_signup, CAST(SUM(c) AS BIGINT) AS daily_visits_homepage FROM (
      SELECT day, n AS a, 0 AS b, 0 AS c FROM ({_DAYS}) UNION ALL SELECT day, 0, n, 0 FROM ({_SEGMENT.format(0)})
      UNION ALL SELECT day, 0, 0, n FROM ({_SEGMENT.format(1)})) GROUP BY day""", "first", "first_visits")
def q_download_table_all(s: Source):
    return reports.download_table(first(s), conversions.first_visit(visits(s), P), P, only_download_days=False)


VIEWS["placed"] = """
    SELECT s.*, c.creative_name, c.placement_id, c.placement_name FROM shown s
    JOIN (SELECT DISTINCT campaign_id, creative_id, creative_name, placement_id, placement_name FROM cmap) c
      ON c.campaign_id = s.campaign_id AND c.creative_id = s.creative_id"""


def _placed(conv: str, ts: str, part: str, order: str) -> str:
    return f"""SELECT creative_name, placement_name, segment_id, CAST(t AS DATE) AS day FROM (
        SELECT s.creative_name, s.placement_name, c.segment_id, c.{ts} AS t, row_number() OVER (PARTITION BY {part}
            ORDER BY s.exposure_time DESC, {order} s.campaign_id, s.flight_id, s.creative_id) AS rn
        FROM placed s JOIN {conv} c ON c.device_id = s.device_id AND c.country = s.country AND s.exposure_time <= c.{ts}
          AND datediff('day', s.exposure_time, c.{ts}) <= 7) WHERE rn = 1"""


_PIVOT = "CAST(SUM(CASE WHEN segment_id = 0 THEN 1 ELSE 0 END) AS BIGINT) AS a, CAST(SUM(CASE WHEN segment_id = 1 THEN 1 ELSE 0 END) AS BIGINT) AS b"
_JOIN = "ON {0}.day = i.day AND {0}.creative_name = i.creative_name AND {0}.placement_name = i.placement_name"


@query("campaign_table", f"""
    SELECT 'app_0' AS campaign_name, i.campaign_id, i.placement_id, i.creative_id, i.creative_name, i.placement_name, i.day AS date_of_delivery,
      c.line_item_start, c.line_item_end, i.i AS impressions, i.c AS clicks, COALESCE(o.n, 0) AS exposed_app_open_count,
      COALESCE(f.n, 0) AS exposed_first_app_open_count, COALESCE(round(o.minutes / o.n, 6), 0) AS avg_min_spent_among_exposed,
      COALESCE(v.a, 0) AS exposed_page_visits_count_signup, COALESCE(w.a, 0) AS exposed_first_page_visits_count_signup,
      COALESCE(v.b, 0) AS exposed_page_visits_count_homepage, COALESCE(w.b, 0) AS exposed_first_page_visits_count_homepage,
      round({_CPM}, 6) AS cpm, round(i.i / 1000 * {_CPM}, 6) AS cost, round(i.i / 1000 * {_CPM} / NULLIF(COALESCE(o.n, 0), 0), 6) AS cpi
    FROM (SELECT campaign_id, placement_id, creative_id, creative_name, placement_name, CAST(exposure_time AS DATE) AS day,
            CAST(SUM(CASE WHEN event = 'impression' THEN 1 ELSE 0 END) AS BIGINT) AS i,
            CAST(SUM(CASE WHEN event = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS c FROM placed GROUP BY ALL) i
    JOIN cmap c ON c.campaign_id = i.campaign_id AND c.creative_id = i.creative_id AND c.placement_id = i.placement_id
    LEFT JOIN (SELECT creative_name, placement_name, CAST(usage_time AS DATE) AS day, COUNT(*) AS n, CAST(SUM(minutes) AS BIGINT) AS minutes
        FROM placed s JOIN used u ON u.device_id = s.device_id AND u.country = s.country AND s.exposure_time <= u.usage_time
        AND datediff('day', s.exposure_time, u.usage_time) <= 7 GROUP BY ALL) o {_JOIN.format("o")}
    LEFT JOIN (SELECT creative_name, placement_name, day, COUNT(*) AS n FROM ({_placed("(SELECT *, 0 AS segment_id FROM first)", "first_open",
        "c.device_id, c.country", "c.first_open,")}) GROUP BY ALL) f {_JOIN.format("f")}
    LEFT JOIN (SELECT creative_name, placement_name, day, {_PIVOT} FROM ({_placed("visits", "visit_time", _VISIT_PART, "")}) GROUP BY ALL) v {_JOIN.format("v")}
    LEFT JOIN (SELECT creative_name, placement_name, day, {_PIVOT} FROM ({_placed("first_visits", "visit_time", _VISIT_PART, "")}) GROUP BY ALL) w {_JOIN.format("w")}""",
    "cmap", "placed", "used", "first", "visits", "first_visits")
def q_campaign_table(s: Source):
    return rounded(reports.campaign_table(s.report_tables, P), "avg_min_spent_among_exposed", "cpm", "cost", "cpi")


@query("time_table", TIME_SQL, "shown", "cmap", "first", "sessions", "apps")
def q_time_table(s: Source):
    return reports.time_table(s.report_tables, P)


_DAILY = "SELECT device_id, country, CAST(usage_time AS DATE) AS day, SUM({}) AS minutes FROM {} WHERE usage_time < TIMESTAMP '2024-01-15' GROUP BY ALL"
VIEWS["market_shown"] = f"""
    SELECT l.device_id, l.country, l.campaign_id, l.flight_id, l.creative_id, l.event, CAST(l.event_time AS DATE) AS day FROM log l
    WHERE l.partition_time BETWEEN {W0} AND {W1} AND l.event IN ('impression', 'click') AND l.dropped IS NULL AND EXISTS (SELECT 1 FROM cmap c
      WHERE c.campaign_id = l.campaign_id AND c.creative_id = l.creative_id AND c.target_country = l.country)"""
VIEWS["market_days"] = _DAILY.format("minutes", "usage")
VIEWS["open_days"] = f"""
    SELECT device_id, country, CAST(start_time AS DATE) AS day, 0 AS minutes FROM sessions
    WHERE app_id IN (SELECT app_id FROM apps WHERE product_name = 'app_0') AND partition_time BETWEEN {USAGE0} AND {WA}
      AND start_time < TIMESTAMP '2024-01-15' GROUP BY ALL"""


def _regional_sql(days: str) -> str:
    key = "country, campaign_id, creative_id"
    return f"""
    SELECT i.country, 'app_0' AS campaign_name, i.campaign_id, c.placement_id, i.creative_id, c.creative_name, c.placement_name, c.line_item_start,
           c.line_item_end, i.impression, i.click, o.n AS count_exposed_app_open, f.n AS count_exposed_first_app_open, o.minutes AS time_spent_min,
           round(o.minutes / 60, 6) AS time_spent_hr, d.n AS daily_downloads
    FROM (SELECT {key}, CAST(SUM(CASE WHEN event = 'impression' THEN 1 ELSE 0 END) AS BIGINT) AS impression,
            CAST(SUM(CASE WHEN event = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS click FROM market_shown GROUP BY ALL) i
    JOIN cmap c ON c.target_country = i.country AND c.campaign_id = i.campaign_id AND c.creative_id = i.creative_id
    LEFT JOIN (SELECT {key}, COUNT(DISTINCT device_id) AS n, CAST(SUM(minutes) AS BIGINT) AS minutes FROM (
        SELECT DISTINCT s.country, s.campaign_id, s.creative_id, s.device_id, u.day, u.minutes FROM market_shown s JOIN {days} u
          ON u.device_id = s.device_id AND u.country = s.country AND s.day <= u.day
        WHERE u.day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14') GROUP BY ALL) o
      ON o.country = i.country AND o.campaign_id = i.campaign_id AND o.creative_id = i.creative_id
    LEFT JOIN (SELECT {key}, COUNT(DISTINCT device_id) AS n FROM (
        SELECT s.*, row_number() OVER (PARTITION BY s.device_id, s.country ORDER BY s.day DESC, s.campaign_id, s.flight_id, s.creative_id) AS rn
        FROM market_shown s JOIN (SELECT device_id, country, MIN(day) AS day FROM {days} GROUP BY ALL) g
          ON g.device_id = s.device_id AND g.country = s.country AND s.day <= g.day
        WHERE g.day >= (SELECT MIN(CAST(line_item_start AS DATE)) FROM cmap)) WHERE rn = 1 GROUP BY ALL) f
      ON f.country = i.country AND f.campaign_id = i.campaign_id AND f.creative_id = i.creative_id
    LEFT JOIN (SELECT country, COUNT(DISTINCT device_id) AS n FROM (SELECT device_id, country, MIN(day) AS day FROM {days} GROUP BY ALL)
        WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY 1) d ON d.country = i.country
    WHERE i.impression > 0"""


@query("regional_creative_report", _regional_sql("market_days"), "cmap", "market_shown", "market_days")
def q_regional_creative_report(s: Source):
    return rounded(reports.regional_creative_report(s.report_tables, P), "time_spent_hr")


@query("regional_creative_report_opens", _regional_sql("open_days"), "cmap", "market_shown", "open_days")
def q_regional_opens(s: Source):
    return rounded(reports.regional_creative_report(s.report_tables, P, opens_only=True), "time_spent_hr")


@query("downloads_vs_exposures", """
    SELECT d.day, d.campaign_id, d.creative_id, d.downloads, COALESCE(e.imps, 0) AS imps FROM (
      SELECT CAST(first_open AS DATE) AS day, campaign_id, creative_id, COUNT(*) AS downloads FROM (
        SELECT s.*, f.first_open, row_number() OVER (PARTITION BY s.device_id, s.country ORDER BY datediff('second', s.exposure_time, f.first_open),
            s.exposure_time, f.first_open, s.campaign_id, s.flight_id, s.creative_id) AS rn
        FROM shown s JOIN first f ON f.device_id = s.device_id AND f.country = s.country AND s.exposure_time <= f.first_open) WHERE rn = 1 GROUP BY ALL) d
    LEFT JOIN (SELECT CAST(s.exposure_time AS DATE) AS day, s.campaign_id, s.creative_id, COUNT(*) AS imps FROM shown s JOIN first f
        ON f.device_id = s.device_id AND f.country = s.country AND s.exposure_time <= f.first_open GROUP BY ALL) e USING (day, campaign_id, creative_id)""", "shown", "first")
def q_downloads_vs_exposures(s: Source):
    return reports.downloads_vs_exposures(shown(s), first(s), ["campaign_id", "creative_id"], reports.KEYS)


@query("profile_counts", """
    SELECT 'shown' AS stage, COUNT(*) AS rows FROM media UNION ALL SELECT 'native', COUNT(*) FROM media WHERE media = 'native'
    UNION ALL SELECT 'ctv', COUNT(*) FROM media WHERE media = 'ctv' UNION ALL SELECT 'stvp', COUNT(*) FROM media WHERE media = 'stvp'""", "media")
def q_profile_counts(s: Source):
    return _profile(s)


@query("profile_additive", """
    SELECT CAST(COUNT(*) AS BIGINT) AS whole, CAST(COUNT(*) FILTER (media IN ('native', 'ctv', 'stvp')) AS BIGINT) AS parts,
           COUNT(*) = COUNT(*) FILTER (media IN ('native', 'ctv', 'stvp')) AS additive FROM media""", "media")
def q_profile_additive(s: Source):
    return reports.profile_additive(_profile(s), "shown")


def _profile(s: Source) -> DataFrame:
    # Counted while the step is written for its readers.
    return written_counted(s.media, "shown", {m: F.col("media") == m for m in ("native", "ctv", "stvp")})[1]
