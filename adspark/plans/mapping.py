"""Sales order book, creative mapping and campaign metadata."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from adspark.functions.columns import normalise, text_part, try_number, without_commas
from adspark.functions.time import date_literal, shift_date, ts_from_parts, ts_literal
from adspark.operators.relational import (
    distinct_rows, in_rel, inner, lookup, not_dropped, overlaps, present, recent_or_null,
    union_all, with_parent)
from adspark.operators.touch import next_touch
from adspark.operators.windows import latest_per_key
from adspark.params import ReportParams, mapping_window
from adspark.plans.finance import booked_budget
from adspark.schemas import CREATIVE_MAPPING, MAPPING_CSV, conform
from adspark.sources.files import read_csv_tolerant
from adspark.sources.scan import scan_between_dim
from adspark.stage import stage

# Fixed values of the order system.
ORDER_NUMBER_FIELD = "JIRA ID"
COUNTRY_FIELD = 72
DEAD_LINES = ("deleted", "In Sales Module Only")
DEAD_ORDERS = ("closed_lost", "deleted")
DEAD_STAGES = ("Closed Lost",)
NOT_BOOKABLE = "Not Bookable"
ORDER_MONTHS = 18
FIELD_VALUES = {"O&amp;O": "O&O", "Korea": "South Korea", "None": "United States"}
DEFAULT_COUNTRY = "United States"
NORTH_AMERICA = ("USA", "Canada", "Mexico")
MAX_MAP_AGE_DAYS = 7
#: What the creative mapping takes from the logs; all else is of the line.
SHOWN = ("country", "flight_id", "flight_name", "flight_start", "flight_end", "creative_id", "creative_name")

VERSION = ("last_modified", "partition_time")
PACKAGE = ("line_item_name", "product_name", "creative_spec", "is_added_value", "added_value_amount",
           "cost_type", "net_unit_cost", "net_cost", "unit_type", "quantity", "production_quantity",
           "line_item_start", "line_item_end")


class StaleMappingError(RuntimeError):
    """The creative mapping is too old, or empty, to report on."""


def assert_fresh(mapping: DataFrame, run_date: date | None, max_age_days: int = MAX_MAP_AGE_DAYS,
                 ts_col: str = "last_update") -> None:
    """Fail if the mapping was last updated ``max_age_days`` or more days before the run (today, if the run
    has no date), or holds nothing."""
    run = F.current_date() if run_date is None else date_literal(run_date)
    age = mapping.agg(F.date_diff(run, F.max(ts_col)).alias("age")).first()["age"]
    if age is None or age >= max_age_days:
        raise StaleMappingError(f"mapping age in days: {age}")


def latest_orders(orders: DataFrame, advertiser_ids: DataFrame | None = None,
                  version: Sequence[str] = VERSION) -> DataFrame:
    if advertiser_ids is not None:
        orders = in_rel(orders, advertiser_ids, "advertiser_id")
    return latest_per_key(orders, ["sales_order_id"], version)


def latest_lines(line_items: DataFrame, orders: DataFrame, version: Sequence[str] = VERSION,
                 live_only: bool = True) -> DataFrame:
    lines = in_rel(line_items, orders, "sales_order_id")
    if live_only:
        lines = lines.where(~F.col("line_item_status").isin(*DEAD_LINES))
    lines = latest_per_key(lines, ["line_item_id"], version)
    return (lines.withColumn("line_item_start", ts_from_parts("start_date", "start_clock"))
            .withColumn("line_item_end", ts_from_parts("end_date", "end_clock")))


def order_numbers(custom_fields: DataFrame, orders: DataFrame, prefix: str) -> DataFrame:
    """The order that last used each order number."""
    fields = in_rel(custom_fields, orders, "sales_order_id").where(
        (F.col("field_name") == ORDER_NUMBER_FIELD) & (F.col("field_status") == "active")
        & F.col("field_value").isNotNull())
    return latest_per_key(fields, ["field_value"], VERSION).select(
        "sales_order_id", try_number("field_value", prefix).alias("order_number"))


def product_countries(product_fields: DataFrame) -> DataFrame:
    """The latest country of each product; the other custom fields do not compete with it."""
    country = latest_per_key(product_fields.where(F.col("field_id") == COUNTRY_FIELD), ["product_id"], VERSION)
    named = normalise("field_value", FIELD_VALUES, DEFAULT_COUNTRY)
    return country.select("product_id", normalise(named, {DEFAULT_COUNTRY: "USA"}).alias("product_country"))


def _book_lines(line_items: DataFrame, live: DataFrame) -> DataFrame:
    """:func:`latest_lines` that the book needs: those of shown orders, and those that a line of a shown order names as its package.

    A line that names a package leaves a narrow row with the package's key, so the one shuffle that finds the latest lines also finds
    which of them are packages. Both are cut to one row per key in every map task.
    """
    terms = [c for c in PACKAGE if c not in ("creative_spec", "line_item_start", "line_item_end")]
    lines = inner(line_items, live.select("sales_order_id", "_shown"), "sales_order_id").where(~F.col("line_item_status").isin(*DEAD_LINES))
    line = F.struct("sales_order_id", "line_item_status", "parent_line_item_id", "product_id", *terms,
                    "start_date", "start_clock", "end_date", "end_clock", "_shown")
    none, parent = F.lit(None), F.col("parent_line_item_id")
    own = F.struct(F.col("line_item_id").alias("line_item_id"), F.struct(*VERSION).alias("_version"), line.alias("_line"), F.lit(False).alias("_package"))
    named = F.struct(parent.alias("line_item_id"), none.alias("_version"), none.alias("_line"), F.lit(True).alias("_package"))
    rows = lines.select(F.inline(F.when(F.col("_shown") & parent.isNotNull(), F.array(own, named)).otherwise(F.array(own))))
    latest = rows.groupBy("line_item_id").agg(F.max_by("_line", "_version").alias("_line"), F.max("_package").alias("_package"))
    latest = latest.where(F.col("_line").isNotNull() & (F.col("_line._shown") | F.col("_package")))
    return (latest.select("line_item_id", "_line.*", "_package").withColumn("line_item_start", ts_from_parts("start_date", "start_clock"))
            .withColumn("line_item_end", ts_from_parts("end_date", "end_clock")))


def order_book(orders: DataFrame, custom_fields: DataFrame, line_items: DataFrame, products: DataFrame,
               product_fields: DataFrame, run_date: date, advertiser_ids: DataFrame | None = None,
               prefix: str = "", last_update: Column | None = None) -> DataFrame:
    """Live line items of the advertisers' current orders, with their package's terms.

    A line item that belongs to a package takes each value from the package line, and its own
    value where the package has none.
    """
    dead = F.col("order_status").isin(*DEAD_ORDERS) | F.col("sales_stage").isin(*DEAD_STAGES)
    live = stage(latest_orders(orders, advertiser_ids).withColumn("_shown", F.coalesce(~dead, F.lit(False))))
    lines = _book_lines(line_items, live)
    bookable = latest_per_key(products.where(F.col("booking_types") != NOT_BOOKABLE), ["product_id"], VERSION)
    lines = lookup(lines, bookable.select("product_id", "creative_spec"), "product_id")
    lines = lookup(lines, product_countries(product_fields), "product_id")
    line = ["sales_order_id", "product_country", "line_item_status", "parent_line_item_id", "line_item_id"]
    lines = stage(lines.select(*line, *PACKAGE, "_shown", "_package"))
    # Only lines in a package, and packages, are shuffled to meet. Each term once, before the lines meet the orders: those are wide rows, and many.
    shown = lines.where("_shown")
    packed = with_parent(shown.where(F.col("parent_line_item_id").isNotNull()), "parent_line_item_id", "line_item_id", PACKAGE,
                         parents=lines.where("_package"))
    packed = packed.select(*line, *[F.coalesce(F.col("parent_" + c), F.col(c)).alias(c) for c in PACKAGE])
    lines = union_all(shown.where(F.col("parent_line_item_id").isNull()).select(*line, *PACKAGE), packed)

    book = lookup(live.where("_shown").select(
        "sales_order_id", "sales_order_name", "order_start", "order_end", "advertiser_id", "advertiser_name",
        "sales_stage", "order_status"), order_numbers(custom_fields, live, prefix), "sales_order_id")
    book = lookup(book, lines, "sales_order_id")
    name = F.coalesce(text_part("sales_order_name", "|", 2), text_part("sales_order_name", "|", 1),
                      F.col("sales_order_name"))
    book = book.select(
        "sales_order_id", F.trim(name).alias("sales_order_name"), "order_start", "order_end", "order_number",
        "advertiser_id", "advertiser_name", "sales_stage", "order_status", "product_country", "line_item_status",
        F.coalesce("parent_line_item_id", "line_item_id").alias("line_item_id"),
        *PACKAGE,
        (last_update if last_update is not None else ts_literal(run_date)).alias("last_update"))
    since = shift_date("month", -ORDER_MONTHS, date_literal(run_date))
    return book.where(recent_or_null(["order_start", "order_end", "line_item_start", "line_item_end"], since))


def running_campaigns(campaigns: DataFrame, oms: DataFrame) -> DataFrame:
    """Campaigns that are not archived, with the order line they were booked as."""
    booked = oms.select("campaign_id", F.col("order_external_id").alias("sales_order_id"),
                        F.col("line_external_id").alias("line_item_id")).distinct()
    live = campaigns.where(F.col("state") != "archived").select("campaign_id", "campaign_name").distinct()
    return inner(live, booked, "campaign_id")


def _named_lines(book: DataFrame, running: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Order book lines that ran in the window, with their campaigns."""
    lines = present(book.where(F.col("line_item_end").cast("timestamp_ntz") >= lo)
                    .where(F.col("line_item_start").cast("timestamp_ntz") <= hi),
                    ["order_number", "sales_order_name"])
    return inner(lines, running.drop("sales_order_id").distinct(), "line_item_id")


def active_campaigns(book: DataFrame, campaigns: DataFrame, oms: DataFrame, run_date: date,
                     months: int = 1) -> DataFrame:
    """Order number and campaign of lines that ran recently: what the regional pull asks for."""
    today = date_literal(run_date)
    _, hi = mapping_window(today)
    lo = F.least(shift_date("month", -months, today), F.trunc(today, "quarter")).cast("timestamp_ntz")
    lines = _named_lines(book, running_campaigns(campaigns, oms), lo, hi)
    return lines.select("order_number", "campaign_id").distinct()


def ran_for_lines(spans: DataFrame, regional: DataFrame) -> DataFrame:
    """Each line (order number, campaign, start, end and any other columns) with every combination of country, flight
    and creative that the regional copy shows in its time. NULL is a value of a combination.

    The copy is read between the first start and the last end, and reduced to the first and last
    exposure of a combination and day. A combination ran for a line if the first of these times at or
    after the line's start is within the line: exact, unless the line lies inside one day. If there are
    such lines, the exposures of their campaigns and days join these times one by one; one pass serves all lines.
    """
    order = ["order_number", "campaign_id"]
    at = F.col("exposure_time")
    edges = spans.agg(F.min("line_item_start").alias("lo"), F.max("line_item_end").alias("hi"))
    shown = regional.where((at >= edges.select("lo").scalar()) & (at <= edges.select("hi").scalar())).select(
        *order, F.struct("country", "flight_id", "creative_id").alias("_ran"), "exposure_time")
    keys = [*order, "_ran"]
    within_day = F.to_date("line_item_start") == F.to_date("line_item_end")

    days = stage(in_rel(shown, spans.select(*order).distinct(), order).groupBy(*keys, F.to_date(at).alias("_day")).agg(
        F.min(at).alias("_first"), F.max(at).alias("_last")))
    times = days.select(*keys, F.explode(F.array("_first", "_last")).alias("exposure_time"))
    short = spans.where(within_day)
    if not short.isEmpty():  # decided from the staged lines; without such lines the copy is read once
        busy = short.select(*order, F.to_date("line_item_start").alias("_day")).distinct()
        times = times.unionByName(in_rel(shown.withColumn("_day", F.to_date(at)), busy, [*order, "_day"]).drop("_day"))
    candidates = inner(spans, times.select(*keys).distinct(), order)
    found = next_touch(times, candidates, keys, "exposure_time", "line_item_start")
    found = found.where(at <= F.col("line_item_end")).drop("exposure_time")
    return found.select("*", "_ran.*").drop("_ran")


def creative_mapping(book: DataFrame, campaigns: DataFrame, oms: DataFrame, log: DataFrame,
                     regional: DataFrame, creatives: DataFrame, flights: DataFrame, countries: DataFrame,
                     run_date: date, last_update: Column | None = None) -> DataFrame:
    """Which campaign, flight and creative ran for which order line, per country.

    North America takes what was seen from the delivery log, other countries from the regional
    copy, there only exposures within the line item's time (:func:`ran_for_lines`). Both logs are
    reduced in the map tasks before they meet the order book.
    """
    today = date_literal(run_date)
    lo, hi = mapping_window(today)
    updated = last_update if last_update is not None else ts_literal(run_date)
    running = stage(running_campaigns(campaigns, oms))
    lines = stage(_named_lines(book, running, lo, hi))
    home = lines.where(F.col("product_country").isin(*NORTH_AMERICA))
    abroad = lines.where(~F.col("product_country").isin(*NORTH_AMERICA))
    ran = ["campaign_id", "flight_id", "creative_id"]
    order, span = ["order_number", "campaign_id"], ["line_item_start", "line_item_end"]

    logged = not_dropped(log).where(
        F.col("event").isin("impression", "click", "tracker") & F.col("country").isNotNull()
        & (F.col("partition_time") >= lo) & (F.col("partition_time") <= hi))
    logged = in_rel(logged.select("country", *ran).distinct(), running.select("campaign_id").distinct(), "campaign_id")
    ordered = inner(running.select("campaign_id", "sales_order_id").distinct(),
                    book.select("sales_order_id", "order_number").distinct(), "sales_order_id")
    ordered = ordered.drop("sales_order_id").distinct()

    spans = stage(abroad.select(*order, *span).distinct())
    seen_abroad = ran_for_lines(spans, regional)

    code = F.when(F.col("product_country") == "USA", "US").otherwise(F.col("country_code"))
    flight = flights.select("flight_id", "campaign_id", "flight_name", "flight_start", "flight_end")

    # A line meets each combination that ran for it. Names are looked up, and rows made distinct, on both sides
    # before they meet: distinct lines and distinct combinations give distinct rows, without a shuffle of those.
    shown = [f for f in CREATIVE_MAPPING if f.name in SHOWN]
    booked_as = [f for f in CREATIVE_MAPPING if f.name not in SHOWN]

    def named(seen: DataFrame) -> DataFrame:
        seen = lookup(seen, creatives.select("creative_id", "creative_name").distinct(), "creative_id")
        return lookup(seen, flight, ["flight_id", "campaign_id"])

    def joined(lines: DataFrame, seen: DataFrame, keys: Sequence[str], budget: Column, booked: Column, delivered: Column) -> DataFrame:
        lines = lookup(lines, countries.select(F.col("country_name").alias("product_country"), "country_code", "region"),
                       "product_country")
        lines = lines.select(
            "*", code.alias("target_country"), budget.cast("double").alias("booked_budget"),
            booked.cast("long").alias("booked_impressions"), delivered.cast("double").alias("budget_delivered"),
            updated.alias("last_update_at"))
        lines = lines.drop("last_update").withColumnsRenamed({
            "last_update_at": "last_update", "sales_order_name": "order_name", "order_start": "campaign_start",
            "order_end": "campaign_end", "cost_type": "rate_type", "net_unit_cost": "rate"})
        lines = conform(lines.withColumn("region", F.coalesce("region", F.lit(""))), StructType(booked_as)).distinct()
        seen = seen.select(*keys, *[F.col(f.name).cast(f.dataType) for f in shown]).distinct()
        return conform(lookup(lines, seen, keys), CREATIVE_MAPPING)

    home_rows = joined(home, inner(named(logged), ordered, "campaign_id"), order,
                       booked_budget(), F.coalesce("production_quantity", F.lit(0)), F.lit(0))
    abroad_rows = joined(abroad, named(seen_abroad), [*order, *span],
                         F.col("net_cost"), F.col("production_quantity"),
                         F.coalesce("net_cost", "added_value_amount", F.lit(0)))
    return union_all(home_rows, abroad_rows)  # of different countries


def creative_map(mapping: DataFrame, p: ReportParams) -> DataFrame:
    """Distinct creatives of line items active in the report window, without commas in names."""
    active = overlaps(F.to_date("line_item_start"), F.to_date("line_item_end"),
                      date_literal(p.start), date_literal(p.end))
    return mapping.where(active & p.in_country(F.col("target_country"))).select(
        "target_country", "campaign_id", without_commas("campaign_name").alias("campaign_name"),
        "flight_id", "creative_id", without_commas("creative_name").alias("creative_name"),
        F.col("line_item_id").alias("placement_id"), without_commas("line_item_name").alias("placement_name"),
        "line_item_start", "line_item_end", "rate_type", "rate", "booked_impressions", "booked_budget").distinct()


def creative_map_from_csv(spark: SparkSession, path: str, p: ReportParams, max_errors: int) -> tuple[DataFrame, DataFrame]:
    """The same from a delivered mapping file, in which a limited number of rows may be broken; and those rows."""
    rows, rejected = read_csv_tolerant(spark, path, MAPPING_CSV, max_errors)
    rows = (rows.withColumn("line_item_start", F.col("campaign_start").cast("timestamp_ntz"))
            .withColumn("line_item_end", F.col("campaign_end").cast("timestamp_ntz")))
    active = overlaps(F.to_date("line_item_start"), F.to_date("line_item_end"),
                      date_literal(p.start), date_literal(p.end))
    rows = rows.where(active & p.in_country(F.col("country"))).select(
        "country", "campaign_id", "campaign_name", "creative_id", "creative_name",
        F.col("line_item_id").alias("placement_id"), F.col("line_item_name").alias("placement_name"),
        "line_item_start", "line_item_end").distinct()
    return rows, rejected


META_COLUMNS = ("target_country", "country", "order_number", "advertiser_id", "advertiser_name", "order_name",
                "campaign_id", "campaign_name", "campaign_start", "campaign_end", "flight_id", "flight_name",
                "flight_start", "flight_end", "line_item_id", "line_item_name", "creative_id", "creative_name",
                "rate_type", "rate", "line_item_start", "line_item_end", "booked_impressions", "booked_budget",
                "budget_delivered")


def campaign_meta(mapping: DataFrame, p: ReportParams) -> DataFrame:
    """Line items with an open end of the report window (start before it, end on or after its start)."""
    active = overlaps("line_item_start", "line_item_end", ts_literal(p.window_start), ts_literal(p.window_end),
                      inclusive="left")
    rows = mapping.where(active)
    if p.countries:
        rows = rows.where(F.lower("target_country").isin(*[c.lower() for c in p.countries]))
    return rows.select(*META_COLUMNS, date_literal(p.run_date or p.end).alias("report_execution_date")).distinct()


def report_creatives(meta: DataFrame) -> DataFrame:
    return distinct_rows(meta, ["target_country", "campaign_id", "campaign_name", "creative_id", "creative_name",
                                "flight_id", "line_item_id", "line_item_name"])


def campaign_meta_by_order(order_numbers: DataFrame, opportunities: DataFrame, orders: DataFrame,
                           campaigns: DataFrame, oms: DataFrame, flights: DataFrame, creatives: DataFrame,
                           line_items: DataFrame, combinations: DataFrame | None = None,
                           log: DataFrame | None = None, products: DataFrame | None = None,
                           prefix: str = "") -> DataFrame:
    """Campaign metadata from order numbers, through CRM, sales order, campaign, flight and creative.

    What ran comes from ``combinations`` (campaign, flight, creative), or, if a delivery ``log`` is
    given, from the log between the first campaign start and the last campaign end. With
    ``products`` each line also has its product.
    """
    crm = opportunities.withColumn("order_number", try_number("ticket", prefix))
    crm = latest_per_key(in_rel(crm, order_numbers, "order_number"), ["order_number"], ["last_modified"])
    # Written: orders, bookings and lines are all reduced by it, and its measured size lets Spark choose how.
    crm = stage(crm.select("order_number", "crm_campaign_id", "sales_order_id", "sales_order_name"))
    order = latest_orders(orders.join(crm.select("sales_order_id").distinct(), "sales_order_id", "left_semi"),
                          version=["last_modified"]).select("sales_order_id", "order_start", "order_end")
    booked = in_rel(oms.withColumn("sales_order_id", F.col("order_external_id")), crm, "sales_order_id")
    booked = booked.select("sales_order_id", F.col("line_external_id").alias("line_item_id"), "campaign_id",
                           "rate_type", "net_unit_cost").distinct()
    running = inner(campaigns.select("campaign_id", "campaign_name", "campaign_start", "campaign_end").distinct(),
                    booked, "campaign_id")
    if log is not None:
        running = stage(running)  # read for both bounds, for the campaigns and for their lines, but booked lines are found once
        seen = scan_between_dim(log, "partition_time", running.select("campaign_start", "campaign_end"),
                                "campaign_start", "campaign_end")
        combinations = in_rel(seen, running.select("campaign_id").distinct(), "campaign_id")
    ran = combinations.select("campaign_id", "flight_id", "creative_id").distinct()
    lines = latest_lines(line_items, crm, version=["last_modified"], live_only=False)
    line_cols = ["sales_order_id", "line_item_id", "line_item_name", "line_item_start", "line_item_end"]
    if products is not None:
        line_cols.append("product_id")
    meta = inner(crm, order, "sales_order_id")
    meta = inner(meta, running, "sales_order_id")
    meta = inner(meta, ran, "campaign_id")
    meta = inner(meta, flights.select("campaign_id", "flight_id", "flight_name", "flight_start", "flight_end").distinct(),
                 ["campaign_id", "flight_id"])
    meta = inner(meta, creatives.select("creative_id", "creative_name").distinct(), "creative_id")
    meta = inner(meta, lines.select(*line_cols), ["sales_order_id", "line_item_id"])
    if products is not None:
        meta = inner(meta, products.select("product_id", "product_name").distinct(), "product_id")
    return meta.distinct()
