"""The test tables seen as advertising data.

Users are devices, event types are kinds of ad events, ``k`` in the event's properties is the
creative, parts are line items and regions are the markets ("countries").
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adspark.functions.columns import json_path, label
from adspark.functions.time import date_literal, diff_units, ts_literal
from adspark.params import ReportParams
from adspark.plans.identity import with_ad_id
from adspark.plans.reports import Tables
from adspark.schemas import (
    APP_OPENS, CREATIVE_MAPPING, DELIVERY, HARDWARE, REGIONAL_EXPOSURE, REGIONAL_USAGE, SESSIONS, conform)

# Sellers with resolved device ids, and the own exchange and seller.
SELLERS = {"known_sellers": ("86", "88", "1", "256027", "237147", "escg8-6k2bc", "amgyk-mxvjr"), "own_exchange": 6,
           "own_seller": "86"}
PARAMS = ReportParams(
    start=date(2024, 1, 8), end=date(2024, 1, 14), attribution_days=7, lookback_months=1,
    page_lookback_days=7, app_name="app_0", run_date=date(2024, 1, 22), signup_segment=0,
    homepage_segment=1, **SELLERS)
ORDER_RUN = date(2001, 6, 1)
MAP_RUN = date(2024, 2, 1)
EPOCH_DAY = "2024-01-01 00:00:00"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
MEDIA = {0: "native", 1: "ctv", 2: "stvp"}
TRACKERS = {0: "start", 1: "first_quartile", 2: "midpoint", 3: "third_quartile", 4: "complete"}


def later(days, ts=None):
    return F.timestamp_add("DAY", days.cast("long") if hasattr(days, "cast") else F.lit(days),
                           ts if ts is not None else ts_literal(EPOCH_DAY))


@dataclass(frozen=True)
class Source:
    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = table  # the schema is read from the file once
        return table

    @cached_property
    def markets(self) -> DataFrame:
        """Customers with their market."""
        nation = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return (self.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("device_id"), F.col("c_name").alias("source_id"),
                        F.col("c_mktsegment").alias("segment"), F.col("r_name").alias("country")))

    @cached_property
    def ev(self) -> DataFrame:
        k = json_path("props", "$.k").cast("long")
        return (self.events.select("ts", F.col("user_id").alias("device_id"), "event_type", "value", k.alias("k"))
                .join(self.markets.drop("segment"), "device_id")
                .withColumn("partition_time", F.date_trunc("HOUR", "ts").cast("timestamp_ntz")))

    @cached_property
    def log(self) -> DataFrame:
        kind, k = F.col("event_type"), F.col("k")
        names = (F.when(kind == "view", F.array(F.lit("impression"), F.lit("tracker")))
                 .when(kind == "click", F.array(F.lit("click")))
                 .when(kind == "signup", F.array(F.lit("segment"))).otherwise(F.array(F.lit("impression"))))
        rows = self.ev.where(kind != "purchase").withColumn("event", F.explode(names))
        rows = rows.withColumns({
            "event_time": F.col("ts"), "device_ids": F.array(F.col("device_id").cast("string")),
            "ip": k.cast("string"), "campaign_id": k % 25, "flight_id": k % 50, "creative_id": k,
            "segment_id": F.when(kind == "signup", k % 2),
            "tracker": F.when(F.col("event") == "tracker", label(k % 5, TRACKERS)),
            "dropped": F.when(kind == "error", True), "exchange_id": F.when(k % 2 == 0, 6).otherwise(1),
            "seller_id": k.cast("string")})
        return conform(rows, DELIVERY)

    @cached_property
    def sessions(self) -> DataFrame:
        length = F.round(F.col("value") * 60).cast("long")
        rows = self.ev.where(F.col("event_type") == "purchase").withColumns({
            "app_id": F.col("k").cast("string"), "start_time": F.col("ts"),
            "end_time": F.timestamp_add("SECOND", length, F.col("ts"))})
        return conform(rows, SESSIONS)

    @cached_property
    def app_opens(self) -> DataFrame:
        rows = self.ev.where(F.col("event_type") == "purchase").withColumns(
            {"app_id": F.col("k").cast("string"), "event_time": F.col("ts")})
        return conform(rows, APP_OPENS)

    @cached_property
    def hardware(self) -> DataFrame:
        rows = self.markets.withColumn("partition_time", later(F.col("device_id") % 30))
        return conform(rows, HARDWARE)

    @cached_property
    def id_map(self) -> DataFrame:
        """Some devices have two source ids, some source ids no device."""
        key = F.col("c_custkey")
        device = F.when(key % 5 == 1, key - 1).otherwise(key)
        return self.customer.where(key % 17 != 0).select(F.col("c_name").alias("source_id"), device.alias("device_id"))

    @cached_property
    def apps(self) -> DataFrame:
        return self.part.select(F.concat(F.lit("app_"), F.col("p_size") % 2).alias("product_name"),
                                F.col("p_partkey").cast("string").alias("app_id"))

    @cached_property
    def mapping(self) -> DataFrame:
        key = F.col("p_partkey")
        rows = (self.part.withColumn("_region", (key % 5).cast("int")).withColumn("_advertiser", key % 10)
                .join(self.region, F.col("_region") == F.col("r_regionkey"))
                .join(self.supplier, F.col("_advertiser") == F.col("s_suppkey")))
        start = later(key % 15)
        rows = rows.withColumns({
            "advertiser_name": F.col("s_name"), "advertiser_id": F.col("s_suppkey"),
            "product_country": F.col("r_name"), "country": F.col("r_name"), "target_country": F.col("r_name"),
            "region": F.col("r_name"), "order_number": 1000 + key % 25,
            "order_name": F.concat(F.lit("order, "), key % 25), "campaign_id": key % 25,
            "campaign_name": F.concat(F.lit("campaign, "), key % 25), "flight_id": key % 50,
            "flight_name": F.concat(F.lit("flight "), key % 50), "flight_start": start,
            "flight_end": later(14, start), "line_item_id": key, "line_item_name": F.col("p_brand"),
            "creative_id": key, "creative_name": F.col("p_name"), "line_item_start": start,
            "line_item_end": later(14, start), "campaign_start": date_literal("2024-01-01"),
            "campaign_end": date_literal("2024-01-31"),
            "rate_type": F.when(F.col("p_size") % 2 == 0, "CPM").otherwise("Flat Rate"),
            "rate": F.col("p_retailprice") / 100, "booked_budget": F.col("p_retailprice"),
            "booked_impressions": F.col("p_size") * 1000, "budget_delivered": F.lit(0.0),
            "last_update": ts_literal("2024-01-20 00:00:00")})
        return conform(rows, CREATIVE_MAPPING)

    @cached_property
    def report_tables(self) -> Tables:
        return Tables(delivery=self.log, sessions=self.sessions, id_map=self.id_map, apps=self.apps,
                      mapping=self.mapping, hardware=self.hardware, app_opens=self.app_opens,
                      regional_exposures=self.regional_copy, regional_usage=self.regional_use)

    # ---- order system

    @cached_property
    def sales_orders(self) -> DataFrame:
        key, day = F.col("o_custkey"), F.to_date("o_orderdate")
        version = F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate"))
        name = (F.when(key % 3 == 0, F.concat(F.lit("IO-1 | order "), key))
                .when(key % 3 == 1, F.concat(F.lit("plain "), key)).otherwise(F.concat(F.lit("IO "), key, F.lit("|"))))
        return self.orders.select(
            key.alias("sales_order_id"), name.alias("sales_order_name"), day.alias("order_start"),
            F.date_add(day, 60).alias("order_end"), (key % 10).alias("advertiser_id"),
            F.concat(F.lit("advertiser "), key % 10).alias("advertiser_name"),
            F.when(F.col("o_orderpriority") == "5-LOW", "Closed Lost").otherwise("Open").alias("sales_stage"),
            F.when(F.col("o_orderstatus") == "P", "deleted").otherwise("active").alias("order_status"),
            version.alias("last_modified"), version.alias("partition_time"))

    @cached_property
    def order_fields(self) -> DataFrame:
        key = F.col("o_custkey")
        version = F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate"))
        return self.orders.select(
            key.alias("sales_order_id"), F.lit("JIRA ID").alias("field_name"),
            F.concat(F.lit("ORD-"), key, F.when(key % 11 == 0, "X").otherwise("")).alias("field_value"),
            F.when(F.col("o_orderstatus") == "F", "inactive").otherwise("active").alias("field_status"),
            version.alias("last_modified"), version.alias("partition_time"))

    @cached_property
    def order_lines(self) -> DataFrame:
        number, day = F.col("l_linenumber").cast("long"), F.to_date("l_shipdate")
        line = F.col("l_orderkey") * 10 + number
        version = F.timestamp_add("SECOND", F.col("l_partkey") * 1000 + F.col("l_suppkey"), F.col("l_shipdate"))
        rows = self.lineitem.join(self.orders.select("o_orderkey", "o_custkey"),
                                  F.col("l_orderkey") == F.col("o_orderkey"))
        return rows.select(
            F.col("o_custkey").alias("sales_order_id"), line.alias("line_item_id"),
            F.concat(F.lit("line "), line).alias("line_item_name"),
            F.concat(F.lit("product "), F.col("l_partkey")).alias("product_name"),
            F.col("l_partkey").alias("product_id"), day.alias("start_date"), F.lit("00:00:00").alias("start_clock"),
            F.date_add(day, 14).alias("end_date"), F.lit("23:59:59").alias("end_clock"),
            F.when(number % 2 == 0, "CPM").otherwise("Flat Rate").alias("cost_type"),
            F.col("l_quantity").cast("long").alias("quantity"),
            (F.col("l_quantity") * 1000).cast("long").alias("production_quantity"),
            F.when(F.col("l_returnflag") == "N", "spots").otherwise("views").alias("unit_type"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("is_added_value"),
            F.col("l_tax").alias("added_value_amount"), F.col("l_extendedprice").alias("net_cost"),
            F.col("l_discount").alias("net_unit_cost"),
            F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A"), "deleted")
            .otherwise("live").alias("line_item_status"),
            F.when(number % 2 == 0, line - 1).alias("parent_line_item_id"),
            version.alias("last_modified"), version.alias("partition_time"))

    @cached_property
    def products(self) -> DataFrame:
        version = ts_literal("2000-01-01 00:00:00")
        return self.part.select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("creative_spec"),
            F.when(F.col("p_size") % 10 == 0, "Not Bookable").otherwise("Bookable").alias("booking_types"),
            version.alias("last_modified"), version.alias("partition_time"))

    @cached_property
    def product_fields(self) -> DataFrame:
        """Two custom fields per product; the platform is newer than the country."""
        country = label(F.col("p_partkey") % 7, {0: "Korea", 1: "None", 2: "O&amp;O", 3: "United States",
                                                 4: "Canada", 5: "France"})
        both = F.explode(F.array(
            F.struct(F.lit(72).alias("field_id"), country.alias("field_value"),
                     ts_literal("2000-01-01 00:00:00").alias("last_modified")),
            F.struct(F.lit(28).alias("field_id"), F.lit("CTV").alias("field_value"),
                     ts_literal("2000-06-01 00:00:00").alias("last_modified"))))
        return self.part.select(F.col("p_partkey").alias("product_id"), both.alias("f")).select(
            "product_id", "f.*", F.col("f.last_modified").alias("partition_time"))

    # ---- creative mapping and campaign metadata

    @cached_property
    def book(self) -> DataFrame:
        """An order book whose lines are parts, for the mapping of what the log shows."""
        key = F.col("p_partkey")
        country = (F.when(key % 5 == 0, "USA").when(key % 5 == 1, "Canada")
                   .otherwise(F.concat(F.lit("NATION_"), key % 25)))
        start = later(key % 15)
        return self.part.select(
            (1000 + key % 25).alias("sales_order_id"), F.concat(F.lit("order "), key % 25).alias("sales_order_name"),
            date_literal("2024-01-01").alias("order_start"), date_literal("2024-01-31").alias("order_end"),
            (1000 + key % 25).alias("order_number"), (key % 10).alias("advertiser_id"),
            F.concat(F.lit("advertiser "), key % 10).alias("advertiser_name"), country.alias("product_country"),
            key.alias("line_item_id"), F.col("p_brand").alias("line_item_name"),
            F.when(F.col("p_size") % 3 == 0, 1).otherwise(0).alias("is_added_value"),
            (F.col("p_size") * 1.0).alias("added_value_amount"), F.lit("CPM").alias("cost_type"),
            (F.col("p_retailprice") / 100).alias("net_unit_cost"), F.col("p_retailprice").alias("net_cost"),
            F.when(F.col("p_size") % 4 != 0, F.col("p_size") * 1000).cast("long").alias("production_quantity"),
            start.alias("line_item_start"), later(14, start).alias("line_item_end"))

    @cached_property
    def campaigns(self) -> DataFrame:
        key = F.col("p_partkey") % 25
        return self.part.select(key.alias("campaign_id"), F.concat(F.lit("campaign "), key).alias("campaign_name"),
                                F.when(key == 24, "archived").otherwise("live").alias("state")).distinct()

    @cached_property
    def oms(self) -> DataFrame:
        key = F.col("p_partkey") % 25
        return self.part.select(key.alias("campaign_id"), (1000 + key).alias("order_external_id"),
                                F.col("p_partkey").alias("line_external_id"))

    @cached_property
    def creatives(self) -> DataFrame:
        return self.part.select(F.col("p_partkey").alias("creative_id"), F.col("p_name").alias("creative_name"))

    @cached_property
    def flights(self) -> DataFrame:
        key = F.col("p_partkey") % 50
        return self.part.select(
            key.alias("flight_id"), (key % 25).alias("campaign_id"), F.concat(F.lit("flight "), key).alias("flight_name"),
            later(key % 15).alias("flight_start"), later(14, later(key % 15)).alias("flight_end")).distinct()

    @cached_property
    def country_map(self) -> DataFrame:
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("country_name"), F.concat(F.lit("N"), F.col("n_nationkey")).alias("country_code"),
            F.col("r_name").alias("region"))

    @cached_property
    def regional(self) -> DataFrame:
        seen = self.log.where(F.col("event").isin("impression", "click") & F.col("dropped").isNull())
        return seen.withColumn("order_number", 1000 + F.col("campaign_id")).withColumn("exposure_time", F.col("event_time"))

    def _shared(self, device) -> Column:
        """Two source ids on a device, some without a device."""
        return F.when(device % 17 != 0, device - device % 2)

    @cached_property
    def regional_copy(self) -> DataFrame:
        seen = self.log.where(F.col("dropped").isNull()).withColumns({
            "order_number": 1000 + F.col("campaign_id"), "exposure_time": F.col("event_time"),
            "device_id": self._shared(F.col("device_id"))})
        return conform(seen, REGIONAL_EXPOSURE)

    @cached_property
    def regional_use(self) -> DataFrame:
        rows = with_ad_id(self.sessions, self.id_map).withColumns({
            "device_id": self._shared(F.col("device_id")), "usage_time": F.col("start_time"),
            "minutes": diff_units("minute", "start_time", "end_time")})
        return conform(rows, REGIONAL_USAGE)

    # ---- lift and cross-media

    @cached_property
    def media(self) -> DataFrame:
        shown = self.log.where((F.col("event") == "impression") & F.col("dropped").isNull()
                               & PARAMS.in_window(F.col("partition_time")))
        return shown.select("device_id", F.col("event_time").alias("exposure_time"), "event",
                            label(F.col("creative_id") % 3, MEDIA).alias("media"))
