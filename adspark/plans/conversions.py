"""App usage, downloads and page visits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from adspark.functions.time import day_of, diff_units, ts_literal
from adspark.operators.relational import (
    cond_sum, in_rel, inner, min_seconds, not_dropped, optional_in, since_min)
from adspark.params import ReportParams
from adspark.plans.identity import with_ad_id
from adspark.sources.scan import scan_events


def app_sessions(sessions: DataFrame, apps: DataFrame, p: ReportParams, lo: datetime, hi: datetime) -> DataFrame:
    """Sessions of the report's app between two times."""
    sessions = scan_events(sessions, lo, hi, p.countries)
    if p.app_name is not None:
        apps = apps.where(F.col("product_name") == p.app_name)
    return in_rel(sessions, apps.select("app_id"), "app_id")


def app_usage(sessions: DataFrame, id_map: DataFrame, apps: DataFrame, p: ReportParams,
              grain: str = "start", inclusive: bool = True) -> DataFrame:
    """Minutes per device and session start (``grain='day'``: and day), lookback included.

    Minutes are summed per source id before the identity lookup, so the lookup handles one row per
    result row.
    """
    rows = app_sessions(sessions, apps, p, p.usage_lookback, p.attribution_end)
    rows = rows.where(min_seconds("start_time", "end_time", p.min_seconds, inclusive))
    at = F.col("start_time") if grain == "start" else day_of("start_time")
    per_source = rows.groupBy("source_id", "country", at.alias("usage_time")).agg(
        F.sum(diff_units("minute", "start_time", "end_time")).alias("minutes"))
    return with_ad_id(per_source, id_map)


def regional_app_usage(copy: DataFrame, p: ReportParams) -> DataFrame:
    """Minutes per device and time from the regional copy, which knows devices and no source ids."""
    rows = scan_events(copy, p.usage_lookback, p.attribution_end, p.countries, partition_col="usage_time")
    rows = rows.groupBy("device_id", "country", "usage_time").agg(F.sum("minutes").alias("minutes"))
    return rows.withColumn("source_id", F.lit(None).cast("string"))


def app_opens(opens: DataFrame, id_map: DataFrame, apps: DataFrame, p: ReportParams) -> DataFrame:
    """Usage where only openings are logged: one row per day, no duration."""
    rows = app_sessions(opens, apps, p, p.usage_lookback, p.attribution_end)
    per_source = rows.groupBy("source_id", "country", day_of("event_time").alias("usage_time")).agg(
        F.count("*").alias("opens"))
    return with_ad_id(per_source, id_map).withColumn("minutes", F.lit(0).cast("long"))


def app_usage_hours(sessions: DataFrame, id_map: DataFrame, apps: DataFrame, universe: DataFrame,
                    p: ReportParams) -> DataFrame:
    """Opens and hours per universe device and start time, within the campaign and its window."""
    rows = app_sessions(sessions, apps, p, p.window_start, p.attribution_end)
    rows = rows.where(min_seconds("start_time", "end_time", p.min_seconds))
    per_source = rows.groupBy("source_id", "country", F.col("start_time").alias("usage_time")).agg(
        F.count("*").alias("opens"),
        F.sum(diff_units("hour", "start_time", "end_time")).alias("hours"))
    per_device = with_ad_id(per_source, id_map).groupBy("country", "device_id", "usage_time").agg(
        F.sum("opens").alias("opens"), F.sum("hours").alias("hours"))
    return in_rel(per_device, universe, ["country", "device_id"])


def usage_in_window(usage: DataFrame, p: ReportParams) -> DataFrame:
    return usage.where(p.in_attribution(F.col("usage_time")))


def usage_since_first_line(usage: DataFrame, creative_map: DataFrame, ts: str = "usage_time") -> DataFrame:
    """Usage on or after the first line item start: leaves the lookback out."""
    return since_min(usage, ts, creative_map, "line_item_start")


def first_event(df: DataFrame, keys: Sequence[str], ts: str, name: str, lo: datetime | None = None,
                hi: datetime | None = None) -> DataFrame:
    """The first event per key over all rows given, kept only if it falls between ``lo`` and ``hi``.

    A key whose first event lies in the lookback is not new and disappears.
    """
    first = df.groupBy(*keys).agg(F.min(ts).alias(name))
    first = first if lo is None else first.where(F.col(name) >= ts_literal(lo))
    return first if hi is None else first.where(F.col(name) <= ts_literal(hi))


def first_app_open(usage: DataFrame, p: ReportParams, universe: DataFrame | None = None,
                   open_ended: bool = False) -> DataFrame:
    """New users: first usage in the report or its attribution window."""
    if universe is not None:
        usage = in_rel(usage, universe, ["country", "device_id"])
    return first_event(usage, ["device_id", "source_id", "country"], "usage_time", "first_open",
                       p.window_start, None if open_ended else p.attribution_end)


def downloads_total(first: DataFrame) -> DataFrame:
    return first.agg(F.count("*").alias("downloads"))


def downloads_daily(first: DataFrame, by: Sequence[str] = (), distinct: bool = False) -> DataFrame:
    """First opens (``distinct``: devices with a first open) per day."""
    n = F.countDistinct("device_id") if distinct else F.count("*")
    return first.groupBy(day_of("first_open").alias("day"), *by).agg(n.alias("downloads"))


def downloads_matched(usage: DataFrame, keys: Sequence[str] = ("device_id", "country"),
                      by: Sequence[str] = ("country", "day")) -> DataFrame:
    """Devices whose usage day is their first day. The first day per key is all that is needed."""
    first = usage.groupBy(*keys).agg(F.min(day_of("usage_time")).alias("day"))
    return first.groupBy(*by).agg(F.countDistinct("device_id").alias("downloads"))


def installs_by_country(first: DataFrame) -> DataFrame:
    return first.groupBy("country").agg(F.countDistinct("device_id").alias("installs"))


def app_users(usage: DataFrame) -> DataFrame:
    return usage.groupBy("country").agg(F.countDistinct("device_id").alias("app_users"))


def _segments(p: ReportParams) -> list:
    return [p.signup_segment, p.homepage_segment]


def page_visits(log: DataFrame, ip_map: DataFrame, universe: DataFrame, p: ReportParams,
                segments: Sequence[int] | None = None) -> DataFrame:
    """Web pixel events, mapped from the address to a universe device. A device with several source ids counts once."""
    hits = scan_events(log.where(F.col("event") == "segment"), p.page_lookback, p.attribution_end, p.countries)
    hits = optional_in(hits, "segment_id", _segments(p) if segments is None else segments)
    return visits_behind(hits, ip_map.select("ip", "device_id").distinct(), universe)


def visits_behind(hits: DataFrame, ip_map: DataFrame, universe: DataFrame) -> DataFrame:
    """:func:`page_visits` from the pixel events of the report's segments, with one device for each address."""
    hits = hits.select("ip", "country", "segment_id", F.col("event_time").alias("visit_time"))
    return in_rel(inner(hits, ip_map.select("ip", "device_id"), "ip"), universe, ["country", "device_id"])


def pixels(log: DataFrame, p: ReportParams, segments: Sequence[int] | None = None) -> DataFrame:
    """Web pixel events that carry the device id. No segment set: no events."""
    hits = scan_events(not_dropped(log).where(F.col("event") == "segment"),
                       p.page_lookback, p.attribution_end, p.countries)
    hits = optional_in(hits, "segment_id", _segments(p) if segments is None else segments)
    return hits.select("device_id", "country", "segment_id", F.col("event_time").alias("visit_time"))


def visits_of(events: DataFrame) -> DataFrame:
    """The pixel events among the events of a report."""
    return events.where(F.col("event") == "segment").select(
        "device_id", "country", "segment_id", F.col("event_time").alias("visit_time"))


def first_visit(visits: DataFrame, p: ReportParams) -> DataFrame:
    return first_event(visits, ["device_id", "country", "segment_id"], "visit_time", "visit_time",
                       p.window_start, p.attribution_end)


def visits_daily(first: DataFrame, distinct: bool = False) -> DataFrame:
    n = F.countDistinct("device_id") if distinct else F.count("*")
    return first.groupBy(day_of("visit_time").alias("day"), "segment_id").agg(n.alias("visits"))


def by_segment(p: ReportParams, signup: str, homepage: str) -> dict[str, Column]:
    """One test per named segment; a segment that is not set matches nothing."""
    return {n: F.col("segment_id") == F.lit(s).cast("long")
            for n, s in ((signup, p.signup_segment), (homepage, p.homepage_segment))}


def visits_by_country(visits: DataFrame, p: ReportParams) -> DataFrame:
    return cond_sum(visits, ["country"],
                    by_segment(p, "total_signup_page_visits", "total_homepage_page_visits"), zero=False)


def usage_thresholds(sessions: DataFrame, id_map: DataFrame, apps: DataFrame, p: ReportParams,
                     thresholds: Mapping[str, int], inclusive: bool = True) -> DataFrame:
    """Sessions in the report window with a 0/1 flag per length, from a single scan."""
    rows = app_sessions(sessions, apps, p, p.window_start, p.attribution_end)
    flags = {n: min_seconds("start_time", "end_time", s, inclusive).cast("int") for n, s in thresholds.items()}
    rows = rows.withColumns(flags).where(F.greatest(*thresholds, F.lit(0)) == 1)
    per_start = rows.groupBy("source_id", "country", F.col("start_time").alias("usage_time")).agg(
        *[F.max(n).alias(n) for n in thresholds])
    return with_ad_id(per_start, id_map)


def usage_with_thresholds(sessions: DataFrame, id_map: DataFrame, apps: DataFrame, p: ReportParams,
                          thresholds: Mapping[str, int]) -> DataFrame:
    """:func:`app_usage` (rows with ``used``) and :func:`usage_thresholds` (rows with a flag) from one read of the sessions."""
    rows = app_sessions(sessions, apps, p, p.usage_lookback, p.attribution_end)
    used = min_seconds("start_time", "end_time", p.min_seconds)
    in_report = p.in_attribution(F.col("partition_time"))
    flags = {n: (min_seconds("start_time", "end_time", s) & in_report).cast("int") for n, s in thresholds.items()}
    rows = rows.withColumns({"used": used, **flags}).where(F.col("used") | (F.greatest(*thresholds, F.lit(0)) == 1))
    per_source = rows.groupBy("source_id", "country", F.col("start_time").alias("usage_time")).agg(
        F.bool_or("used").alias("used"), F.sum(F.when(F.col("used"), diff_units("minute", "start_time", "end_time"))).alias("minutes"),
        *[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in thresholds])
    return with_ad_id(per_source, id_map)
