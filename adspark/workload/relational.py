"""Scans, projections, filters, joins, aggregates, windows, set operations and column functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from adspark.functions import columns as C, time as T
from adspark.operators import relational as R, windows as W
from adspark.operators.intervals import point_in_interval as in_interval
from adspark.params import default_window, mapping_window, window_edges
from adspark.schemas import conform, schema
from adspark.sources import map_rows, scan_between_dim, scan_events, split_column
from adspark.sinks import page_of, report_path, rows_to_append, route, with_placeholder
from adspark.sinks.export import dated_path
from adspark.stage import work_dir
from adspark.workload.registry import query
from adspark.workload.tables import PARAMS, Source


def count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def day(text: str):
    return T.date_literal(text)


# ---- scans

@query("scan_window", """
    SELECT l_returnflag, COUNT(*) AS n, round(SUM(l_extendedprice), 2) AS price FROM lineitem
    WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1999-06-30' GROUP BY l_returnflag""")
def scan_window(s: Source):
    rows = scan_events(s.lineitem, datetime(1998, 1, 1), datetime(1999, 6, 30), partition_col="l_shipdate")
    return rows.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("scan_partition_text", """
    SELECT event_type, COUNT(*) AS n FROM events
    WHERE strftime(ts, '%Y%m%d%H') BETWEEN '2024010800' AND '2024011423' GROUP BY event_type""")
def scan_partition_text(s: Source):
    # A copy of the events kept by hour: only the folders of the hours wanted are listed and read.
    folder = f"{work_dir(s.spark)}/events"
    hourly = s.events.withColumn("partition_hour", T.fmt("ts", "yyyyMMddHH"))
    hourly.repartition("partition_hour").write.partitionBy("partition_hour").parquet(folder)
    rows = s.spark.read.schema(hourly.schema).parquet(folder)
    rows = scan_events(rows, datetime(2024, 1, 8), datetime(2024, 1, 14, 23), partition_col="partition_hour",
                       partition_format="%Y%m%d%H")
    return count(rows, "event_type")


@query("scan_between_dim", """
    SELECT l_linestatus, COUNT(*) AS n FROM lineitem
    WHERE l_shipdate >= (SELECT MIN(o_orderdate) FROM orders WHERE o_totalprice > 490000)
      AND l_shipdate <= (SELECT MAX(o_orderdate) FROM orders WHERE o_totalprice > 490000) GROUP BY l_linestatus""")
def scan_dim(s: Source):
    big = s.orders.where("o_totalprice > 490000")
    return count(scan_between_dim(s.lineitem, "l_shipdate", big, "o_orderdate", "o_orderdate"), "l_linestatus")


@query("split_to_rows", """
    SELECT word, COUNT(*) AS n FROM (SELECT trim(unnest(string_split(p_name, ' '))) AS word FROM part)
    WHERE word <> '' GROUP BY word""")
def split_rows(s: Source):
    return count(split_column(s.part, "p_name", " ", "word"), "word")


@query("map_rows", "SELECT DISTINCT country, segment FROM markets", "markets")
def q_map_rows(s: Source):
    # Country -> its segments as one map column, then a row per entry.
    lists = R.collect_distinct_text(s.markets, ["country"], "segment", "segments")
    as_map = lists.select(F.create_map("country", "segments").alias("m"))
    return split_column(map_rows(as_map, "m", "country", "segments"), "segments", ",", "segment").select(
        "country", "segment")


@query("conform_types", """
    SELECT o_orderkey AS sales_order_id, CAST(o_orderdate AS DATE) AS order_start, o_totalprice AS net_cost,
           CAST(NULL AS VARCHAR) AS note FROM orders""")
def conform_types(s: Source):
    # All-text staging, then the declared types; a column the input lacks is NULL.
    staged = s.orders.select(*[F.col(c).cast("string").alias(n) for c, n in (
        ("o_orderkey", "sales_order_id"), ("o_orderdate", "order_start"), ("o_totalprice", "net_cost"))])
    return conform(staged, schema(sales_order_id="int", order_start="date", net_cost="float", note="str"))


# ---- projections

@query("derive_alias_reuse", """
    SELECT l_orderkey, l_linenumber::BIGINT AS line, round(SUM(l_extendedprice * (1 - l_discount)), 4) AS net,
           round(round(SUM(l_extendedprice * (1 - l_discount)), 4) / 7, 6) AS net_7
    FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def derive_alias(s: Source):
    net = s.lineitem.groupBy("l_orderkey", F.col("l_linenumber").cast("long").alias("line")).agg(
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("net"))
    return R.derive(net, net_7=F.round(F.col("net") / 7, 6))


@query("alias_in_filter_and_window", """
    SELECT o_custkey, quarter, o_orderkey FROM (
      SELECT o_custkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, o_orderkey,
             row_number() OVER (PARTITION BY o_custkey, CAST(date_trunc('quarter', o_orderdate) AS DATE)
                                ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE quarter >= DATE '1999-01-01' AND rn = 1""")
def alias_filter_window(s: Source):
    rows = R.derive(s.orders, quarter=T.quarter_start("o_orderdate")).where(F.col("quarter") >= day("1999-01-01"))
    return W.latest_per_key(rows, ["o_custkey", "quarter"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "quarter", "o_orderkey")


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(s: Source):
    return R.distinct_rows(s.lineitem, ["l_partkey", "l_suppkey"])


@query("label_codes", """
    SELECT CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS state, 'all' AS scope,
           CAST(NULL AS BIGINT) AS segment_id, COUNT(*) AS n FROM orders GROUP BY 1""")
def label_codes(s: Source):
    rows = s.orders.select(C.label("o_orderstatus", {"O": "open", "F": "filled"}).alias("state"))
    rows = R.with_nulls(R.with_const(rows, scope="all"), {"segment_id": "bigint"})
    return count(rows, "state", "scope", "segment_id")


@query("normalise_values", """
    SELECT product_id, CASE WHEN v = 'United States' THEN 'USA' ELSE v END AS country FROM (
      SELECT p_partkey AS product_id, CASE p_partkey % 7 WHEN 0 THEN 'South Korea' WHEN 1 THEN 'United States'
        WHEN 2 THEN 'O&O' WHEN 3 THEN 'United States' WHEN 4 THEN 'Canada' WHEN 5 THEN 'France'
        ELSE 'United States' END AS v FROM part)""")
def normalise_values(s: Source):
    from adspark.plans.mapping import product_countries
    return product_countries(s.product_fields).withColumnRenamed("product_country", "country")


# ---- filters

@query("not_dropped", "SELECT event, COUNT(*) AS n FROM log WHERE NOT COALESCE(dropped, FALSE) GROUP BY event", "log")
def not_dropped(s: Source):
    return count(R.not_dropped(s.log), "event")


@query("in_list", """
    SELECT o_orderpriority, COUNT(*) AS n FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') GROUP BY 1""")
def in_list(s: Source):
    rows = R.in_list(s.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return count(R.in_list(rows, "o_orderstatus", ["P"], negate=True), "o_orderpriority")


@query("optional_in", "SELECT segment_id, COUNT(*) AS n FROM log WHERE segment_id IN (1) GROUP BY 1", "log")
def optional_in(s: Source):
    unset = R.optional_in(s.log, "segment_id", [None, ""])
    return count(R.union_all(R.optional_in(s.log, "segment_id", [1, None]), unset), "segment_id")


@query("semi_in", """
    SELECT c_mktsegment, COUNT(*) AS n FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) GROUP BY 1""")
def semi_in(s: Source):
    big = s.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return count(R.in_rel(s.customer, big, "c_custkey"), "c_mktsegment")


@query("anti_not_in", """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""")
def anti_not_in(s: Source):
    # A NULL in the list must not empty the result.
    listed = s.events.select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("c_custkey"))
    listed = R.union_all(listed, s.events.select(F.col("user_id").alias("c_custkey")))
    return R.not_in_rel(s.customer, listed, "c_custkey").select("c_custkey", "c_name")


@query("anti_not_exists", """
    SELECT p.p_partkey, s.s_suppkey FROM (SELECT DISTINCT l_partkey AS p_partkey, l_suppkey AS s_suppkey FROM lineitem
      WHERE l_returnflag = 'R') p JOIN supplier s ON s.s_suppkey = p.s_suppkey
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_suppkey = s.s_suppkey
                      AND l.l_returnflag = 'N')""")
def anti_not_exists(s: Source):
    pairs = s.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"), "l_returnflag")
    returned = pairs.where("l_returnflag = 'R'").drop("l_returnflag").distinct()
    returned = R.in_rel(returned, s.supplier, "s_suppkey")
    return R.not_exists(returned, pairs.where("l_returnflag = 'N'"), ["p_partkey", "s_suppkey"])


@query("like_filters", """
    SELECT p_type, COUNT(*) AS n FROM part
    WHERE lower(p_name) LIKE '%ring%' OR NOT (p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#2') GROUP BY 1""")
def like_filters(s: Source):
    brand = R.like_any("p_brand", ["Brand#1%", "Brand#2"])
    return count(s.part.where(R.any_of(R.contains("p_name", "RING", ignore_case=True), ~brand)), "p_type")


@query("equal_ignoring_case", "SELECT c_mktsegment, COUNT(*) AS n FROM customer WHERE lower(c_mktsegment) = 'machinery' GROUP BY 1")
def equal_ignoring_case(s: Source):
    return count(s.customer.where(R.eq_ci("c_mktsegment", F.lit("Machinery"))), "c_mktsegment")


@query("scalar_min_filter", """
    SELECT o_orderstatus, COUNT(*) AS n FROM orders
    WHERE o_orderdate >= (SELECT MIN(l_shipdate) FROM lineitem WHERE l_returnflag = 'N') GROUP BY 1""")
def scalar_min(s: Source):
    return count(R.since_min(s.orders, "o_orderdate", s.lineitem.where("l_returnflag = 'N'"), "l_shipdate"),
                 "o_orderstatus")


@query("active_overlap", """
    SELECT o_orderstatus, CAST(SUM(CASE WHEN s <= DATE '1999-03-31' AND e >= DATE '1999-01-01' THEN 1 ELSE 0 END) AS BIGINT) AS both_ends,
           CAST(SUM(CASE WHEN s < DATE '1999-03-31' AND e >= DATE '1999-01-01' THEN 1 ELSE 0 END) AS BIGINT) AS left_open,
           CAST(SUM(CASE WHEN s < DATE '1999-03-31' AND e > DATE '1999-01-01' THEN 1 ELSE 0 END) AS BIGINT) AS strict
    FROM (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 60 AS e FROM orders) GROUP BY 1""")
def active_overlap(s: Source):
    rows = s.orders.select("o_orderstatus", T.day_of("o_orderdate").alias("s"),
                           F.date_add(T.day_of("o_orderdate"), 60).alias("e"))
    lo, hi = day("1999-01-01"), day("1999-03-31")
    return R.cond_sum(rows, ["o_orderstatus"], {
        "both_ends": R.overlaps("s", "e", lo, hi), "left_open": R.overlaps("s", "e", lo, hi, "left"),
        "strict": R.overlaps("s", "e", lo, hi, "neither")})


@query("session_length", """
    SELECT country, CAST(SUM(CASE WHEN datediff('second', start_time, end_time) >= 60 THEN 1 ELSE 0 END) AS BIGINT) AS at_least,
           CAST(SUM(CASE WHEN datediff('second', start_time, end_time) > 60 THEN 1 ELSE 0 END) AS BIGINT) AS more_than,
           CAST(SUM(CASE WHEN end_time - start_time > INTERVAL 300 SECOND THEN 1 ELSE 0 END) AS BIGINT) AS by_interval
    FROM sessions GROUP BY country""", "sessions")
def session_length(s: Source):
    return R.cond_sum(s.sessions, ["country"], {
        "at_least": R.min_seconds("start_time", "end_time", 60),
        "more_than": R.min_seconds("start_time", "end_time", 60, inclusive=False),
        "by_interval": R.longer_than("start_time", "end_time", 300)})


@query("recent_or_null", """
    SELECT o_orderstatus, COUNT(*) AS n FROM (
      SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS s, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 60 END AS e
      FROM orders)
    WHERE s >= DATE '1999-12-01' OR s IS NULL OR e >= DATE '1999-12-01' OR e IS NULL GROUP BY 1""")
def recent_or_null(s: Source):
    start = T.day_of("o_orderdate")
    rows = s.orders.select("o_orderstatus", start.alias("s"),
                           F.when(F.col("o_orderstatus") != "P", F.date_add(start, 60)).alias("e"))
    return count(rows.where(R.recent_or_null(["s", "e"], T.shift_date("month", -18, day("2001-06-01")))), "o_orderstatus")


@query("present_values", """
    SELECT event, COUNT(*) AS n FROM log WHERE segment_id IS NOT NULL AND ip <> '' GROUP BY 1""", "log")
def present_values(s: Source):
    return count(R.present(s.log, ["segment_id", "ip"]), "event")


@query("json_path", """
    SELECT event_type, COUNT(*) AS n, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total,
           CAST(SUM(CASE WHEN json_extract_string(props, '$.k') = '7' THEN 1 ELSE 0 END) AS BIGINT) AS sevens FROM events GROUP BY 1""")
def json_path(s: Source):
    return s.events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(C.variant_path("props", "$.k", "bigint")).alias("total"),
        F.count_if(C.json_path("props", "$.k") == "7").alias("sevens"))


@query("having_alias", """
    SELECT o_custkey, MIN(o_orderdate) AS first_order FROM orders GROUP BY 1
    HAVING MIN(o_orderdate) BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""")
def having_alias(s: Source):
    within = F.col("first_order").between(T.ts_literal("1996-01-01"), T.ts_literal("1996-12-31"))
    return R.agg_where(s.orders, ["o_custkey"], {"first_order": F.min("o_orderdate")}, within)


# ---- joins

@query("join_two_keys", """
    SELECT m.country, a.campaign_id, COUNT(*) AS n FROM log a
    JOIN mapping b ON a.campaign_id = b.campaign_id AND a.creative_id = b.creative_id AND a.country = b.target_country
    JOIN markets m ON m.device_id = a.device_id GROUP BY ALL""", "log", "mapping", "markets")
def join_two_keys(s: Source):
    wanted = s.mapping.select("campaign_id", "creative_id", F.col("target_country").alias("country"))
    rows = R.inner(s.log, wanted, ["campaign_id", "creative_id", "country"])
    return count(rows, "country", "campaign_id")


@query("join_on_expression", """
    SELECT n.n_name, COUNT(*) AS n FROM supplier s JOIN nation n ON lower(n.n_name) = 'nation_' || s.s_nationkey GROUP BY 1""")
def join_on_expression(s: Source):
    rows = R.join_expr(s.supplier, s.nation, F.concat(F.lit("nation_"), F.col("s_nationkey")), F.lower("n_name"))
    return count(rows, "n_name")


@query("left_star", """
    SELECT n.n_name, c.customers, s.suppliers, COALESCE(c.customers, 0) + COALESCE(s.suppliers, 0) AS parties
    FROM nation n LEFT JOIN (SELECT c_nationkey, COUNT(*) AS customers FROM customer GROUP BY 1) c ON c.c_nationkey = n.n_nationkey
    LEFT JOIN (SELECT s_nationkey, COUNT(*) AS suppliers FROM supplier GROUP BY 1) s ON s.s_nationkey = n.n_nationkey""")
def left_star(s: Source):
    key = "n_nationkey"
    customers = s.customer.groupBy(F.col("c_nationkey").alias(key)).agg(F.count("*").alias("customers"))
    suppliers = s.supplier.groupBy(F.col("s_nationkey").alias(key)).agg(F.count("*").alias("suppliers"))
    rows = R.left_star(s.nation, [(customers, [key]), (suppliers, [key])])
    parties = F.coalesce("customers", F.lit(0)) + F.coalesce("suppliers", F.lit(0))
    return rows.select("n_name", "customers", "suppliers", parties.alias("parties"))


@query("self_parent", """
    WITH d AS (SELECT * FROM (SELECT l_orderkey * 10 + l_linenumber AS id, l_linenumber, l_orderkey, l_extendedprice,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
        FROM lineitem) WHERE rn = 1)
    SELECT d.id AS line_item_id, COALESCE(p.id, d.id) AS package_id, COALESCE(p.l_extendedprice, d.l_extendedprice) AS net_cost
    FROM d LEFT JOIN d p ON p.id = CASE WHEN d.l_linenumber % 2 = 0 THEN d.id - 1 END""")
def self_parent(s: Source):
    rows = W.latest_per_key(s.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = rows.select(line.alias("id"), F.col("l_extendedprice").alias("net"),
                       F.when(F.col("l_linenumber") % 2 == 0, line - 1).alias("parent"))
    rows = R.with_parent(rows, "parent", "id", ["id", "net"])
    return rows.select(F.col("id").alias("line_item_id"), F.coalesce("parent_id", "id").alias("package_id"),
                       F.coalesce("parent_net", "net").alias("net_cost"))


@query("point_in_interval", """
    SELECT l.campaign_id, m.line_item_id, COUNT(*) AS n, MIN(l.event_time) AS first_seen FROM log l
    JOIN mapping m ON m.campaign_id = l.campaign_id AND m.creative_id = l.creative_id
     AND l.event_time BETWEEN m.line_item_start AND m.line_item_end
    GROUP BY ALL""", "log", "mapping")
def point_in_interval(s: Source):
    spans = s.mapping.select("campaign_id", "creative_id", "line_item_id", "line_item_start", "line_item_end")
    rows = in_interval(s.log, spans, ["campaign_id", "creative_id"], "event_time", "line_item_start", "line_item_end")
    return rows.groupBy("campaign_id", "line_item_id").agg(
        F.count("*").alias("n"), F.min("event_time").alias("first_seen"))


@query("point_in_interval_left", """
    SELECT l.campaign_id, i.name, COUNT(*) AS n, MIN(l.event_time) AS first_seen FROM log l
    LEFT JOIN (SELECT campaign_id, name, line_item_start AS lo, line_item_end + to_days(days) AS hi
               FROM mapping, (VALUES ('as booked', 0), ('with a day after', 1)) v(name, days) WHERE line_item_id % 2 = 0) i
      ON i.campaign_id = l.campaign_id AND l.event_time BETWEEN i.lo AND i.hi
    GROUP BY ALL""", "log", "mapping")
def point_in_interval_left(s: Source):
    # Overlapping intervals of one campaign, and campaigns with none.
    rows = s.mapping.where("line_item_id % 2 = 0")
    spans = [rows.select("campaign_id", F.lit(name).alias("name"), F.col("line_item_start").alias("lo"),
                         F.expr(f"line_item_end + INTERVAL {days} DAY").alias("hi"))
             for name, days in (("as booked", 0), ("with a day after", 1))]
    rows = in_interval(s.log, spans[0].unionByName(spans[1]), ["campaign_id"], "event_time", "lo", "hi", how="left",
                       count="intervals")
    return rows.groupBy("campaign_id", "name").agg(F.sum("intervals").alias("n"), F.min("event_time").alias("first_seen"))


@query("same_day_join", """
    SELECT DISTINCT a.user_id, CAST(a.ts AS DATE) AS day FROM events a JOIN events b
    ON a.user_id = b.user_id AND date_trunc('day', a.ts) = date_trunc('day', b.ts)
    WHERE a.event_type = 'view' AND b.event_type = 'purchase'""")
def same_day_join(s: Source):
    kind = F.col("event_type")
    return R.same_day_keys(s.events.where(kind == "view"), s.events.where(kind == "purchase"), ["user_id"], "ts", "ts")


@query("cross_one_row", """
    SELECT c_mktsegment, COUNT(*) AS n, (SELECT COUNT(*) FROM customer) AS total,
           (SELECT MAX(c_acctbal) FROM customer) AS top FROM customer GROUP BY 1""")
def cross_one_row(s: Source):
    whole = s.customer.agg(F.count("*").alias("total"), F.max("c_acctbal").alias("top"))
    return R.attach_scalar(count(s.customer, "c_mktsegment"), whole)


@query("fan_out_distinct", """
    SELECT DISTINCT o.o_custkey, l.l_suppkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    JOIN (SELECT DISTINCT s_suppkey, s_name FROM supplier) s ON s.s_suppkey = l.l_suppkey""")
def fan_out_distinct(s: Source):
    orders = s.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # Deduplicated on the order key before the join, so each pair is made once per order.
    lines = R.distinct_rows(s.lineitem, ["l_orderkey", "l_suppkey"])
    lines = R.in_rel(lines, s.supplier.select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey")
    return R.inner(orders, lines, "l_orderkey").select("o_custkey", "l_suppkey").distinct()


@query("rejoin_first", """
    SELECT f.day, COUNT(DISTINCT e.user_id) AS users FROM events e
    JOIN (SELECT user_id, MIN(CAST(ts AS DATE)) AS day FROM events GROUP BY 1) f
    ON f.user_id = e.user_id AND CAST(e.ts AS DATE) = f.day GROUP BY 1""")
def rejoin_first(s: Source):
    from adspark.plans.conversions import downloads_matched
    usage = s.events.select(F.col("user_id").alias("device_id"), F.col("ts").alias("usage_time"))
    return downloads_matched(usage, ["device_id"], ["day"]).withColumnRenamed("downloads", "users")


# ---- aggregates

@query("count_distinct_reach", """
    SELECT l_suppkey, COUNT(*) AS impressions, COUNT(DISTINCT l_orderkey) AS reach,
           round(COUNT(*)::DOUBLE / COUNT(DISTINCT l_orderkey), 6) AS frequency FROM lineitem GROUP BY 1""")
def count_distinct_reach(s: Source):
    from adspark.plans.delivery import reach_frequency
    rows = s.lineitem.select("l_suppkey", F.col("l_orderkey").alias("device_id"), F.lit("impression").alias("event"))
    return reach_frequency(rows, ["l_suppkey"]).withColumn("frequency", F.round("frequency", 6))


@query("basic_aggregates", """
    SELECT l_returnflag, COUNT(*) AS n, COUNT(CASE WHEN l_tax > 0 THEN 1 END) AS taxed, round(SUM(l_quantity), 2) AS quantity,
           round(AVG(l_discount), 6) AS discount, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship,
           round(SUM(l_extendedprice) / SUM(l_quantity), 4) AS unit_price FROM lineitem GROUP BY 1""")
def basic_aggregates(s: Source):
    return s.lineitem.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("l_tax") > 0, 1)).alias("taxed"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.avg("l_discount"), 6).alias("discount"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        F.round(F.sum("l_extendedprice") / F.sum("l_quantity"), 4).alias("unit_price"))


_COND = """
    SELECT country, campaign_id, {a} AS impressions, {b} AS clicks FROM log GROUP BY ALL"""


@query("conditional_sums", _COND.format(
    a="CAST(SUM(CASE WHEN event = 'impression' THEN 1 ELSE 0 END) AS BIGINT)",
    b="CAST(SUM(CASE WHEN event = 'click' THEN 1 ELSE 0 END) AS BIGINT)"), "log")
def conditional_sums(s: Source):
    return R.cond_sum(s.log, ["country", "campaign_id"], {
        "impressions": F.col("event") == "impression", "clicks": F.col("event") == "click"})


@query("conditional_sums_null", """
    SELECT device_id, CAST(SUM(CASE WHEN event = 'impression' THEN 1 END) AS BIGINT) AS impressions,
           CAST(SUM(CASE WHEN segment_id = 1 THEN 1 END) AS BIGINT) AS homepage FROM log GROUP BY 1""", "log")
def conditional_sums_null(s: Source):
    return R.cond_sum(s.log, ["device_id"], {"impressions": F.col("event") == "impression",
                                             "homepage": F.col("segment_id") == 1}, zero=False)


@query("segment_pivot", """
    SELECT country, CAST(SUM(CASE WHEN segment_id = 0 THEN n ELSE 0 END) AS BIGINT) AS signup,
           CAST(SUM(CASE WHEN segment_id = 1 THEN n ELSE 0 END) AS BIGINT) AS homepage
    FROM (SELECT country, segment_id, COUNT(*) AS n FROM log WHERE event = 'segment' GROUP BY ALL) GROUP BY 1""", "log")
def segment_pivot(s: Source):
    counts = count(s.log.where("event = 'segment'"), "country", "segment_id")
    return R.pivot_counts(counts, ["country"], "segment_id", {0: "signup", 1: "homepage"}, "n")


@query("listagg_sellers", """
    SELECT campaign_id, string_agg(DISTINCT seller_id, ',' ORDER BY seller_id) AS sellers FROM log
    WHERE event = 'impression' GROUP BY 1""", "log")
def listagg_sellers(s: Source):
    return R.collect_distinct_text(s.log.where("event = 'impression'"), ["campaign_id"], "seller_id", "sellers")


@query("two_level_freq", """
    SELECT LEAST(imps, 20) AS impression_group, COUNT(*) AS reach, CAST(SUM(imps) AS BIGINT) AS imps
    FROM (SELECT device_id, COUNT(*) AS imps FROM log WHERE event = 'impression' GROUP BY 1) GROUP BY 1""", "log")
def two_level_freq(s: Source):
    per_device = s.log.where("event = 'impression'").groupBy("device_id").agg(F.count("*").alias("imps"))
    return per_device.groupBy(C.bucket_cap("imps", 20).alias("impression_group")).agg(
        F.count("*").alias("reach"), F.sum("imps").alias("imps"))


@query("re_aggregation", """
    SELECT CAST(date_trunc('quarter', day) AS DATE) AS quarter, CAST(SUM(n) AS BIGINT) AS n
    FROM (SELECT CAST(l_shipdate AS DATE) AS day, COUNT(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1""")
def re_aggregation(s: Source):
    daily = s.lineitem.groupBy(T.day_of("l_shipdate").alias("day")).agg(F.count("*").alias("n"))
    return daily.groupBy(T.quarter_start("day").alias("quarter")).agg(F.sum("n").alias("n"))


@query("count_of_distinct", """
    SELECT COUNT(*) AS converters FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')""")
def count_of_distinct(s: Source):
    users = R.distinct_rows(s.events.where("event_type = 'purchase'"), ["user_id"])
    return users.agg(F.count("*").alias("converters"))


@query("ratio_to_total", """
    SELECT country, n, round(n::DOUBLE / (SELECT COUNT(*) FROM log), 6) AS share
    FROM (SELECT country, COUNT(*) AS n FROM log GROUP BY 1)""", "log")
def ratio_to_total(s: Source):
    rows = R.ratio_to_total(count(s.log, "country"), "n", s.log.agg(F.count("*").alias("total")), "total", "share")
    return rows.withColumn("share", F.round("share", 6))


@query("guarded_ratios", """
    SELECT country, campaign_id, CASE WHEN i = 0 OR c = 0 THEN 0 ELSE round(c::DOUBLE / i, 6) END AS ctr,
           round(i::DOUBLE / NULLIF(g, 0), 6) AS per_segment
    FROM (SELECT country, campaign_id, SUM(CASE WHEN event = 'impression' THEN 1 ELSE 0 END) AS i,
                 SUM(CASE WHEN event = 'click' THEN 1 ELSE 0 END) AS c,
                 SUM(CASE WHEN event = 'segment' THEN 1 ELSE 0 END) AS g FROM log GROUP BY ALL)""", "log")
def guarded_ratios(s: Source):
    rows = R.cond_sum(s.log, ["country", "campaign_id"], {
        n: F.col("event") == e for n, e in (("i", "impression"), ("c", "click"), ("g", "segment"))})
    return rows.select("country", "campaign_id", F.round(C.safe_ratio("c", "i", default=0), 6).alias("ctr"),
                       F.round(C.safe_ratio("i", "g"), 6).alias("per_segment"))


# ---- windows

@query("row_number_latest", """
    SELECT device_id, ts, event_type FROM (SELECT device_id, ts, event_type,
      row_number() OVER (PARTITION BY device_id ORDER BY ts DESC) AS rn FROM ev) WHERE rn = 1""", "ev")
def row_number_latest(s: Source):
    return W.latest_per_key(s.ev, ["device_id"], ["ts"]).select("device_id", "ts", "event_type")


@query("row_number_tiebreak", """
    SELECT l_orderkey, l_linenumber::BIGINT AS line, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
    WHERE rn = 1""")
def row_number_tiebreak(s: Source):
    rows = W.latest_per_key(s.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return rows.select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), "l_partkey", "l_suppkey")


@query("latest_order_version", """
    SELECT o_custkey AS sales_order_id, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_order_version(s: Source):
    rows = W.latest_per_key(s.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return rows.select(F.col("o_custkey").alias("sales_order_id"), "o_orderkey", "o_orderstatus")


@query("ntile_control", """
    SELECT c_custkey, ntile(100) OVER (ORDER BY md5('7:' || c_custkey), c_custkey) AS tile FROM customer""")
def ntile_control(s: Source):
    return W.random_ntile(s.customer.select("c_custkey"), "c_custkey", 100, seed=7)


@query("rank_pages", """
    SELECT o_orderkey, rank() OVER (ORDER BY o_custkey, o_orderpriority) AS row_num,
           CAST(ceil(rank() OVER (ORDER BY o_custkey, o_orderpriority) / 500.0) AS BIGINT) AS page FROM orders""")
def rank_pages(s: Source):
    rows = s.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    rows = W.row_rank(rows, ["o_custkey", "o_orderpriority"])
    return rows.select("o_orderkey", "row_num", page_of(F.col("row_num"), 500).alias("page"))


@query("min_over_partition", """
    SELECT DISTINCT device_id, event, CAST(event_time AS DATE) AS day,
           MIN(CAST(event_time AS DATE)) OVER (PARTITION BY device_id, event) AS first_day FROM log""", "log")
def min_over_partition(s: Source):
    days = s.log.select("device_id", "event", T.day_of("event_time").alias("day")).distinct()
    return W.with_group_min(days, ["device_id", "event"], "day", "first_day")


# ---- order, limit, sets

@query("sort_limit", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def sort_limit(s: Source):
    rows = s.orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)
    return rows.select("o_orderkey", "o_totalprice")


@query("union_distinct", """
    SELECT n_nationkey AS nation FROM nation UNION SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
def union_distinct(s: Source):
    return R.union_distinct(*[d.select(F.col(c).alias("nation")) for d, c in (
        (s.nation, "n_nationkey"), (s.customer, "c_nationkey"), (s.supplier, "s_nationkey"))])


@query("union_all", """
    SELECT nation, COUNT(*) AS n FROM (SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY 1""")
def union_all(s: Source):
    return count(R.union_all(s.customer.select(F.col("c_nationkey").alias("nation")),
                             s.supplier.select(F.col("s_nationkey").alias("nation"))), "nation")


@query("intersect_devices", """
    SELECT user_id FROM events WHERE event_type = 'view' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase'
    INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def intersect_devices(s: Source):
    kind = F.col("event_type")
    return R.intersect_keys(
        s.events.where(kind == "view"), s.events.where(kind == "purchase"),
        s.customer.where("c_mktsegment <> 'MACHINERY'").withColumnRenamed("c_custkey", "user_id"), key="user_id")


# ---- column functions

@query("text_functions", """
    SELECT p_partkey, replace(p_name || ', ' || p_brand, ',', ' ') AS plain, left(p_type, 3) AS short,
           right('000' || CAST(p_size AS VARCHAR), 3) AS seq, upper(trim(p_type)) AS shout,
           split_part(p_name, ' ', 2) AS second, split_part(p_name, ' ', 9) AS ninth FROM part""")
def text_functions(s: Source):
    return s.part.select(
        "p_partkey", C.without_commas(F.concat("p_name", F.lit(", "), "p_brand")).alias("plain"),
        F.left("p_type", F.lit(3)).alias("short"), F.lpad(F.col("p_size").cast("string"), 3, "0").alias("seq"),
        F.upper(F.trim("p_type")).alias("shout"), C.split_part("p_name", " ", 2).alias("second"),
        C.split_part("p_name", " ", 9).alias("ninth"))


@query("split_part_try_number", """
    SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS level,
           TRY_CAST(replace(o_orderpriority, '5-', '') AS BIGINT) AS not_a_number,
           COALESCE(NULLIF(split_part(o_orderpriority, '|', 2), ''), o_orderpriority) AS fallback FROM orders""")
def split_part_try_number(s: Source):
    return s.orders.select(
        "o_orderkey", C.try_number(C.split_part("o_orderpriority", "-", 1)).alias("level"),
        C.try_number("o_orderpriority", "5-").alias("not_a_number"),
        F.coalesce(C.text_part("o_orderpriority", "|", 2), "o_orderpriority").alias("fallback"))


@query("number_functions", """
    SELECT l_orderkey, l_linenumber::BIGINT AS line, l_partkey, l_suppkey, round(l_extendedprice / 7, 2) AS r,
           CAST(floor(l_extendedprice) AS BIGINT) AS f, CAST(ceil(l_extendedprice) AS BIGINT) AS c, abs(l_discount - l_tax) < 0.001 AS near,
           LEAST(l_discount, l_tax) AS lo, GREATEST(l_discount, l_tax) AS hi, l_shipdate FROM lineitem""")
def number_functions(s: Source):
    price = F.col("l_extendedprice")
    return s.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("line"), "l_partkey", "l_suppkey",
        F.round(price / 7, 2).alias("r"), F.floor(price).alias("f"), F.ceil(price).alias("c"),
        (F.abs(F.col("l_discount") - F.col("l_tax")) < 0.001).alias("near"),
        F.least("l_discount", "l_tax").alias("lo"), F.greatest("l_discount", "l_tax").alias("hi"), "l_shipdate")


@query("datediff_boundaries", """
    SELECT device_id, start_time, datediff('second', start_time, end_time) AS seconds, datediff('minute', start_time, end_time) AS minutes,
           datediff('hour', start_time, end_time) AS hours, datediff('day', start_time, end_time + INTERVAL 20 HOUR) AS days FROM sessions WHERE device_id IS NOT NULL""", "sessions")
def datediff_boundaries(s: Source):
    rows = s.sessions.join(s.id_map, "source_id")
    end = T.shift("hour", 20, "end_time")
    return rows.select("device_id", "start_time", *[
        T.diff_units(u, "start_time", e).alias(n) for u, e, n in (
            ("second", F.col("end_time"), "seconds"), ("minute", F.col("end_time"), "minutes"),
            ("hour", F.col("end_time"), "hours"), ("day", end, "days"))])


@query("date_shifts", """
    SELECT o_orderkey, o_orderdate + INTERVAL 7 DAY AS plus_week, o_orderdate - INTERVAL 12 MONTH AS year_back,
           CAST(o_orderdate AS DATE) - 45 AS days_back, CAST(CAST(o_orderdate AS DATE) + INTERVAL 6 MONTH AS DATE) AS half_year FROM orders""")
def date_shifts(s: Source):
    d = "o_orderdate"
    return s.orders.select(
        "o_orderkey", T.shift("week", 1, d).alias("plus_week"), T.shift("month", -12, d).alias("year_back"),
        T.shift_date("day", -45, d).alias("days_back"), T.shift_date("month", 6, d).alias("half_year"))


@query("date_trunc_quarter", """
    SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, COUNT(*) AS n FROM orders GROUP BY 1""")
def date_trunc_quarter(s: Source):
    return count(s.orders.withColumn("quarter", T.quarter_start("o_orderdate")), "quarter")


@query("date_formats", """
    SELECT event_id, strftime(ts, '%Y%m%d%H') AS hour_text, CAST(strptime(strftime(ts, '%Y%m%d%H'), '%Y%m%d%H') AS TIMESTAMP) AS hour,
           CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_start, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 86399 SECOND AS day_end FROM events""")
def date_formats(s: Source):
    text = T.fmt("ts", "yyyyMMddHH")
    return s.events.select("event_id", text.alias("hour_text"), T.parse_ts(text, "yyyyMMddHH").alias("hour"),
                           T.day_start("ts").alias("day_start"), T.day_end("ts").alias("day_end"))


@query("timestamp_from_parts", """
    SELECT event_id, CAST(strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M:%S') AS TIMESTAMP) AS at_second FROM events""")
def timestamp_from_parts(s: Source):
    return s.events.select("event_id", T.ts_from_parts(T.day_of("ts"), T.fmt("ts", "HH:mm:ss")).alias("at_second"))


# The week holding the last Sunday at least a week before the given day.
_SUNDAY = "(d - CAST(CASE WHEN isodow(d) = 7 THEN 7 ELSE isodow(d) END AS INTEGER) - 7)"


@query("previous_day_window", f"""
    SELECT DISTINCT d AS run_date, {_SUNDAY} - 6 AS start_day, {_SUNDAY} AS end_day
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def previous_day_window(s: Source):
    runs = s.orders.select(T.day_of("o_orderdate").alias("run_date")).distinct()
    start, end = default_window(F.col("run_date"))
    return runs.select("run_date", start.alias("start_day"), end.alias("end_day"))


@query("report_window_edges", """
    SELECT DISTINCT CAST(d AS TIMESTAMP) AS window_start, CAST(d + 6 AS TIMESTAMP) + INTERVAL 86399 SECOND AS window_end,
           CAST(d + 13 AS TIMESTAMP) + INTERVAL 86399 SECOND AS attribution_end, CAST(d AS TIMESTAMP) - INTERVAL 12 MONTH AS usage_lookback,
           CAST(d - 30 AS TIMESTAMP) AS page_lookback FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def report_window_edges(s: Source):
    days = s.orders.select(T.day_of("o_orderdate").alias("d")).distinct()
    edges = window_edges(F.col("d"), F.date_add("d", 6), 7, 12, 30)
    return days.select(*[c.alias(n) for n, c in edges.items()])


@query("mapping_window", """
    SELECT DISTINCT d AS run_date, CAST(LEAST(CAST(d - INTERVAL 6 MONTH AS DATE), CAST(date_trunc('quarter', d) AS DATE)) AS TIMESTAMP) AS lo,
           CAST(d AS TIMESTAMP) - INTERVAL 1 SECOND AS hi FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)""")
def mapping_windows(s: Source):
    days = s.lineitem.select(T.day_of("l_shipdate").alias("run_date")).distinct()
    lo, hi = mapping_window(F.col("run_date"))
    return days.select("run_date", lo.alias("lo"), hi.alias("hi"))


@query("campaign_window", """
    SELECT MIN(line_item_start) AS campaign_start, TIMESTAMP '2024-01-20 23:59:59' AS campaign_end FROM mapping""", "mapping")
def campaign_window(s: Source):
    from adspark.params import campaign_window as window
    meta = s.mapping.select(F.col("line_item_start").alias("campaign_start"), F.col("line_item_end").alias("campaign_end"))
    return window(meta, end="2024-01-20")


@query("epoch_seconds", """
    SELECT event_id, date_trunc('second', ts) AS at_second FROM events""")
def epoch_seconds(s: Source):
    epoch = T.diff_units("second", T.ts_literal(T.EPOCH), "ts").cast("string")
    return s.events.select("event_id", T.epoch_ts(F.concat(epoch, F.lit(".75"))).alias("at_second"))


@query("array_first", """
    SELECT event, COUNT(*) AS n, CAST(SUM(device_id) AS BIGINT) AS ids, 0::BIGINT AS found_in_empty FROM log GROUP BY 1""", "log")
def array_first(s: Source):
    empty = F.filter("device_ids", lambda x: x.isNull())
    return s.log.groupBy("event").agg(
        F.count("*").alias("n"), F.sum(C.first_of("device_ids").cast("long")).alias("ids"),
        F.count(C.first_of(empty)).alias("found_in_empty"))


@query("array_functions", """
    SELECT p_partkey, p_name || '/' || p_type || '/' || p_brand AS path, 3::BIGINT AS parts FROM part""")
def array_functions(s: Source):
    parts = F.array_append(F.array("p_name", "p_type"), F.col("p_brand"))
    return s.part.select("p_partkey", F.array_join(parts, "/").alias("path"), F.size(parts).cast("long").alias("parts"))


# ---- delivery of results

@query("append_rows", """
    SELECT DISTINCT o_orderkey, o_custkey, DATE '2024-01-22' AS date_imported FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_orderkey = o.o_orderkey AND t.o_custkey = o.o_custkey)""")
def append_rows(s: Source):
    # The batch holds every row twice; the target already has the filled orders.
    keys = ["o_orderkey", "o_custkey"]
    batch = R.union_all(s.orders, s.orders).select(*keys)
    return rows_to_append(batch, s.orders.where("o_orderstatus = 'F'"), keys, day("2024-01-22"))


@query("placeholder_row", """
    SELECT DATE '2024-01-22' AS report_execution_date, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY 2
    UNION ALL SELECT DATE '2024-01-22', NULL, NULL""")
def placeholder_row(s: Source):
    report = count(s.lineitem, "l_returnflag")
    nothing = report.where("l_returnflag = '-'")
    return R.union_all(with_placeholder(report, day("2024-01-22")), with_placeholder(nothing, day("2024-01-22")))


@query("report_paths", """
    SELECT DISTINCT c_mktsegment AS market, page, 'weekly/adv_' || lower(c_mktsegment) || '_weekly_campaign_2024-01-08_2024-01-14_' ||
           CASE WHEN page < 1000 THEN right('000' || page, 3) ELSE CAST(page AS VARCHAR) END || '.csv' AS path,
           CASE WHEN lower(c_mktsegment) = 'us' THEN 'home' ELSE 'abroad' END AS destination, 'mapping/20240122_map.csv' AS dated
    FROM (SELECT c_mktsegment, c_custkey // 100 + 1 AS page FROM customer)""")
def report_paths(s: Source):
    pages = s.customer.select(F.col("c_mktsegment").alias("market"), (F.floor(F.col("c_custkey") / 100) + 1).alias("page")).distinct()
    return pages.select(
        "market", "page", report_path("adv_", F.col("market"), PARAMS, F.col("page")).alias("path"),
        route(F.col("market"), "home", "abroad").alias("destination"),
        dated_path("mapping/<date>_map.csv", day("2024-01-22")).alias("dated"))
