"""First events and addresses from state kept per day, in place of a scan of the whole lookback for every report.

Three states: the first usage of each source id and app, the first visit of each device and segment, and the last time each
device was seen behind an address. They hold no device of the identity map and no universe, which are those of the
report that reads them. A night calls :func:`advance` with the days that :func:`nightly_days` names.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, functions as F

from adspark.functions.time import day_of
from adspark.operators.relational import in_rel, min_seconds, not_dropped
from adspark.params import ReportParams
from adspark.plans.conversions import first_event
from adspark.plans.identity import last_behind, with_ad_id, with_sources
from adspark.sinks.daily import DailyState, days_between
from adspark.sources.scan import scan_events

REREAD_DAYS = 14


def usage_state(folder: str) -> DailyState:
    return DailyState(folder, ("source_id", "country", "app_id"), {"usage_time": "min"})


def visit_state(folder: str) -> DailyState:
    return DailyState(folder, ("device_id", "country", "segment_id"), {"visit_time": "min"})


def address_state(folder: str) -> DailyState:
    return DailyState(folder, ("ip", "country", "device_id"), {"event_time": "max"})


def nightly_days(state: DailyState, spark, run_date: date, lookback_days: int, reread_days: int = REREAD_DAYS) -> list[date]:
    """Days of the lookback that were never taken, and those that late rows may have changed, to the end of yesterday."""
    last = run_date - timedelta(days=1)
    again = days_between(run_date - timedelta(days=reread_days), last)
    return sorted({*again, *state.missing(spark, run_date - timedelta(days=lookback_days), last)})


def _scan(df: DataFrame, days: Sequence[date]) -> DataFrame:
    """The partitions of these days, by literals on the raw column."""
    return scan_events(df, datetime.combine(min(days), time()), datetime.combine(max(days), time.max)) if days else df


def advance_usage(state: DailyState, sessions: DataFrame, p: ReportParams, days: Sequence[date], inclusive: bool = True) -> None:
    """Sessions that are long enough, by the day of their partition."""
    long = _scan(sessions, days).where(min_seconds("start_time", "end_time", p.min_seconds, inclusive))
    state.take(long.withColumn("usage_time", F.col("start_time")), day_of("partition_time"), days)


def advance_visits(state: DailyState, log: DataFrame, days: Sequence[date]) -> None:
    seen = not_dropped(_scan(log, days)).where(F.col("event") == "segment")
    state.take(seen.withColumn("visit_time", F.col("event_time")), day_of("partition_time"), days)


def advance_addresses(state: DailyState, log: DataFrame, days: Sequence[date]) -> None:
    """All devices seen behind an address, so that any identity map may choose among them."""
    seen = not_dropped(_scan(log, days)).where((F.col("event") == "impression") & F.col("ip").isNotNull())
    state.take(seen, day_of("partition_time"), days)


def first_app_open(state: DailyState, id_map: DataFrame, apps: DataFrame, p: ReportParams, universe: DataFrame | None = None,
                   open_ended: bool = False) -> DataFrame:
    """:func:`adspark.plans.conversions.first_app_open` from the state."""
    rows = state.read(id_map.sparkSession, p.usage_lookback.date(), p.attribution_end.date())
    if p.countries:
        rows = rows.where(F.col("country").isin(*p.countries))
    if p.app_name is not None:
        apps = apps.where(F.col("product_name") == p.app_name)
    rows = with_ad_id(in_rel(rows, apps.select("app_id"), "app_id"), id_map)
    if universe is not None:
        rows = in_rel(rows, universe, ["country", "device_id"])
    return first_event(rows, ["device_id", "source_id", "country"], "usage_time", "first_open",
                       p.window_start, None if open_ended else p.attribution_end)


def first_visit(state: DailyState, spark, p: ReportParams) -> DataFrame:
    """:func:`adspark.plans.conversions.first_visit` of pixel events that carry the device, from the state."""
    rows = state.read(spark, p.page_lookback.date(), p.attribution_end.date())
    if p.countries:
        rows = rows.where(F.col("country").isin(*p.countries))
    wanted = [s for s in (p.signup_segment, p.homepage_segment) if s is not None]
    rows = rows.where(F.col("segment_id").isin(*wanted) if wanted else F.lit(False))
    return first_event(rows, ["device_id", "country", "segment_id"], "visit_time", "visit_time", p.window_start, p.attribution_end)


def app_users(state: DailyState, id_map: DataFrame, apps: DataFrame, p: ReportParams) -> DataFrame:
    """:func:`adspark.plans.conversions.app_users` over the lookback and the report, from the state."""
    rows = state.read(id_map.sparkSession, p.usage_lookback.date(), p.attribution_end.date())
    if p.countries:
        rows = rows.where(F.col("country").isin(*p.countries))
    if p.app_name is not None:
        apps = apps.where(F.col("product_name") == p.app_name)
    users = with_ad_id(in_rel(rows, apps.select("app_id"), "app_id"), id_map)
    return users.groupBy("country").agg(F.countDistinct("device_id").alias("app_users"))


def ip_device_map(state: DailyState, id_map: DataFrame, p: ReportParams) -> DataFrame:
    """:func:`adspark.plans.identity.ip_device_map` from the state."""
    rows = state.read(id_map.sparkSession, p.window_start.date(), p.attribution_end.date()).where(p.in_country(F.col("country")))
    return with_sources(last_behind(rows, id_map), id_map)
