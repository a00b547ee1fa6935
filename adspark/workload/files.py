"""Sources and sinks: results written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from adspark.functions.time import date_literal
from adspark.plans import mapping
from adspark.schemas import MAPPING_CSV, conform, empty_like, schema
from adspark.sinks import append_new, current, export_csv, export_paged, refresh_table
from adspark.sinks.export import CSV_DIALECT
from adspark.sources import read_csv, read_csv_tolerant, read_table, report_manifest
from adspark.stage import stage, work_dir
from adspark.workload.registry import query
from adspark.workload.sql import VIEWS
from adspark.workload.tables import PARAMS as P, Source

ORDERS = schema(order_id="int", customer_id="int", status="str", price="float", ordered="ts")
_ORDERS_SQL = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS ordered FROM orders"""


def orders(s: Source):
    return conform(s.orders.withColumnsRenamed({
        "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status", "o_totalprice": "price",
        "o_orderdate": "ordered"}), ORDERS)


@query("csv_conform", _ORDERS_SQL)
def csv_conform(s: Source):
    folder = work_dir(s.spark)
    orders(s).write.options(**CSV_DIALECT).csv(f"{folder}/orders")
    return read_csv(s.spark, f"{folder}/orders", ORDERS, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")


@query("csv_single_file", "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS note FROM supplier")
def csv_single_file(s: Source):
    # A list, delivered as one named file.
    rows = s.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                             F.lit(None).cast("string").alias("note"))
    path = export_csv(rows, f"{work_dir(s.spark)}/out/advertisers.csv", ["id"])
    return read_csv(s.spark, path, schema(id="int", name="str", note="str"))


@query("csv_tolerant", _ORDERS_SQL + " WHERE o_totalprice <= 499000")
def csv_tolerant(s: Source):
    return _tolerant(s)[0]


@query("csv_rejected", """
    SELECT '"' || o_orderkey || '","' || o_custkey || '","' || o_orderstatus || '","n/a","' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"' AS rejected
    FROM orders WHERE o_totalprice > 499000""")
def csv_rejected(s: Source):
    return _tolerant(s)[1]


def _tolerant(s: Source):
    # Rows with an unreadable price are set aside, as long as they are few.
    folder = work_dir(s.spark)
    price = F.when(F.col("price") > 499000, "n/a").otherwise(F.col("price").cast("string"))
    orders(s).withColumn("price", price).write.options(**CSV_DIALECT).csv(f"{folder}/orders")
    budget = s.orders.count() // 100
    return read_csv_tolerant(s.spark, f"{folder}/orders", ORDERS, max_errors=budget)


@query("creative_map_csv", """
    SELECT target_country AS country, campaign_id, campaign_name, creative_id, creative_name, line_item_id AS placement_id,
           line_item_name AS placement_name, line_item_start, line_item_end
    FROM mapping WHERE CAST(line_item_start AS DATE) <= DATE '2024-01-14' AND CAST(line_item_end AS DATE) >= DATE '2024-01-08'""", "mapping")
def creative_map_csv(s: Source):
    folder = work_dir(s.spark)
    rows = s.mapping.withColumns({
        "campaign_start": F.col("line_item_start").cast("string"), "campaign_end": F.col("line_item_end").cast("string")})
    conform(rows, MAPPING_CSV).write.options(**CSV_DIALECT).csv(f"{folder}/mapping")
    return mapping.creative_map_from_csv(s.spark, f"{folder}/mapping", P, max_errors=250)[0]


@query("table_by_name", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def table_by_name(s: Source):
    stage(s.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")), "adspark_order_states")
    return read_table(s.spark, "adspark_order_states")


@query("refresh_table", _ORDERS_SQL + " WHERE o_orderstatus <> 'P'")
def refreshed(s: Source):
    # The second refresh reads the version it replaces.
    folder = f"{work_dir(s.spark)}/orders"
    refresh_table(orders(s), folder)
    refresh_table(current(s.spark, folder).where("status <> 'P'"), folder)
    return current(s.spark, folder)


@query("append_new", """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, CASE WHEN o_orderstatus = 'F' THEN DATE '2024-01-21' ELSE DATE '2024-01-22' END AS date_imported
    FROM orders""")
def appended(s: Source):
    # Filled orders one night, all orders the next, and the second batch twice.
    path = f"{work_dir(s.spark)}/orders"
    keys = ["order_id", "customer_id"]
    append_new(orders(s).where("status = 'F'").select(*keys), path, keys, date_literal("2024-01-21"))
    for _ in range(2):
        append_new(orders(s).select(*keys), path, keys, date_literal("2024-01-22"))
    return s.spark.read.parquet(path)


VIEWS["daily_stats"] = """
    SELECT campaign_id, creative_id, event, COUNT(*) AS n FROM log GROUP BY ALL"""


def daily_stats(s: Source):
    return s.log.groupBy("campaign_id", "creative_id", "event").agg(F.count("*").alias("n"))


_PAGE = "CAST(ceil(rank() OVER (ORDER BY campaign_id, creative_id, event) / 100.0) AS BIGINT)"


@query("paged_export", f"SELECT *, 'page_' || right('000' || {_PAGE}, 3) || '.csv' AS file_name FROM daily_stats", "daily_stats")
def paged_export(s: Source):
    folder = work_dir(s.spark)
    export_paged(daily_stats(s), f"{folder}/out", ["campaign_id", "creative_id", "event"],
                 lambda page: f"page_{page:03d}.csv", max_rows=100)
    rows = read_csv(s.spark, f"{folder}/out", schema(campaign_id="int", creative_id="int", event="str", n="int"))
    return rows.withColumn("file_name", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1))


@query("report_manifest", 
    "SELECT 'out' AS destination, CAST(ceil(COUNT(*) / 100.0) AS BIGINT) AS files FROM daily_stats", "daily_stats")
def manifest(s: Source):
    folder = work_dir(s.spark)
    export_paged(daily_stats(s), f"{folder}/out", ["campaign_id", "creative_id", "event"],
                 lambda page: f"page_{page:03d}.csv", max_rows=100)
    return report_manifest(s.spark, folder, "page_*.csv").drop("bytes")


@query("typed_empty_table", "SELECT * FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders)")
def typed_empty(s: Source):
    # A reset table takes its first batch whole.
    target = empty_like(s.spark, schema(order_id="int", customer_id="int"))
    return target.unionByName(orders(s).select("order_id", "customer_id"))
