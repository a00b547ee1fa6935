"""Delivered impressions and clicks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from adspark.functions.columns import safe_ratio
from adspark.functions.time import day_of, ts_literal
from adspark.operators.relational import cond_sum, in_rel, inner, lookup, not_dropped
from adspark.operators.windows import with_group_min
from adspark.params import ReportParams
from adspark.plans import identity
from adspark.schemas import DELIVERY, conform
from adspark.sources.scan import scan_events
from adspark.stage import stage

IN_CAMPAIGN = ("campaign_id", "flight_id", "creative_id")
BY_CREATIVE = ("campaign_id", "flight_id", "creative_id", "country")

# Video progress columns and the tracker names that count for each.
VIDEO_STEPS = {
    "video_start": ("autoplay_start", "start"),
    "video_25": ("autoplay_first_quartile", "first_quartile"),
    "video_50": ("autoplay_midpoint_quartile", "midpoint"),
    "video_75": ("autoplay_third_quartile", "third_quartile"),
    "video_completions": ("autoplay_complete", "complete"),
}


def _delivered(log: DataFrame, p: ReportParams, events: Sequence[str], when: Column,
               keep_dropped: bool = False) -> DataFrame:
    log = log if keep_dropped else not_dropped(log)
    return log.where(when & F.col("event").isin(*events) & p.in_country(F.col("country")))


def exposures(log: DataFrame, creative_map: DataFrame, p: ReportParams, universe: DataFrame | None = None,
              keys: Sequence[str] = ("campaign_id", "creative_id"), attach: Sequence[str] = (),
              keep_dropped: bool = False) -> DataFrame:
    """Impressions and clicks of mapped campaigns in the report window, on universe devices.

    A semi join on the map, so an exposure appears once however many line items share its creative;
    with ``attach`` it appears once per combination of those map columns. The map goes first: it is
    small and takes out most of the log before the universe asks for a shuffle.
    """
    shown = _delivered(log, p, ("impression", "click"), p.in_window(F.col("partition_time")), keep_dropped)
    shown = shown.select("device_id", "country", F.col("event_time").alias("exposure_time"),
                         "campaign_id", "flight_id", "creative_id", "event")
    if attach:
        shown = inner(shown, creative_map.select(*keys, *attach).distinct(), list(keys))
    else:
        shown = in_rel(shown, creative_map.select(*keys), list(keys))
    return shown if universe is None else in_rel(shown, universe, ["country", "device_id"])


def delivery(log: DataFrame, creative_map: DataFrame, p: ReportParams) -> DataFrame:
    """Exposures whose campaign, flight, creative and country are all in the map."""
    by_country = creative_map.withColumn("country", F.col("target_country"))
    return exposures(log, by_country, p, keys=BY_CREATIVE)


def only(exposed: DataFrame, event: str) -> DataFrame:
    return exposed.where(F.col("event") == event)


def exposure_log(exposed: DataFrame, event: str | None = None) -> DataFrame:
    """Day grain, one row per event."""
    rows = only(exposed, event) if event else exposed
    return rows.withColumn("exposure_day", day_of("exposure_time")).drop("exposure_time")


def exposures_daily(exposed: DataFrame, event: str | None = None) -> DataFrame:
    """Distinct device, creative and day, with the first time each device saw each kind of event."""
    days = exposure_log(exposed, event).distinct()
    return with_group_min(days, ["device_id", "event"], "exposure_day", "first_day")


def delivery_stats(exposed: DataFrame, keys: Sequence[str], daily: bool = False,
                   clicks_on_impression_days: bool = False) -> DataFrame:
    """Impressions and clicks per group in one pass.

    ``clicks_on_impression_days`` leaves out groups that have clicks but no impression, as a left
    join from impressions to clicks does.
    """
    keys = list(keys)
    if daily:
        exposed = exposed.withColumn("exposure_day", day_of("exposure_time"))
        keys.append("exposure_day")
    stats = cond_sum(exposed, keys, {"impressions": F.col("event") == "impression",
                                     "clicks": F.col("event") == "click"})
    return stats.where(F.col("impressions") > 0) if clicks_on_impression_days else stats


def reach_frequency(exposed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Impressions, distinct devices and impressions per device.

    First per group and device (combined in the map tasks), then per group, so that a large group
    is spread over its devices.
    """
    per_device = (only(exposed, "impression").groupBy(*keys, "device_id")
                  .agg(F.count("*").alias("impressions")))
    return (per_device.groupBy(*keys)
            .agg(F.sum("impressions").alias("impressions"), F.count("device_id").alias("reach"))
            .withColumn("frequency", safe_ratio("impressions", "reach")))


def impressions_per_device(log: DataFrame, meta: DataFrame, p: ReportParams, by: Sequence[str] = (),
                           daily: bool = False) -> DataFrame:
    """Impressions per device, with columns of the campaign metadata; also per day if asked."""
    keys = ("campaign_id", "flight_id", "creative_id")
    shown = _delivered(log, p, ("impression",), p.in_attribution(F.col("partition_time")), keep_dropped=True)
    dims = meta.select(*keys, *[c for c in by if c not in keys]).distinct()
    shown = inner(shown.withColumn("day", day_of("event_time")), dims, list(keys))
    group = ["country", "device_id", *by] + (["day"] if daily else [])
    return shown.groupBy(*group).agg(F.count("*").alias("imps"))


def creative_impressions_per_device(log: DataFrame, meta: DataFrame, p: ReportParams) -> DataFrame:
    """Impressions per device and creative of the campaign metadata, for several cuts to share."""
    shown = _delivered(log, p, ("impression",), p.in_attribution(F.col("partition_time")), keep_dropped=True)
    shown = in_rel(shown, meta.select(*IN_CAMPAIGN).distinct(), list(IN_CAMPAIGN))
    return shown.groupBy("country", "device_id", *IN_CAMPAIGN).agg(F.count("*").alias("imps"))


def cut_impressions(counts: DataFrame, meta: DataFrame, by: Sequence[str]) -> DataFrame:
    """These counts by columns of the metadata: the same as :func:`impressions_per_device` with ``by``."""
    dims = meta.select(*IN_CAMPAIGN, *[c for c in by if c not in IN_CAMPAIGN]).distinct()
    return inner(counts, dims, list(IN_CAMPAIGN)).groupBy("country", "device_id", *by).agg(F.sum("imps").alias("imps"))


def video_counts(seen: DataFrame) -> DataFrame:
    """How far videos played. A step nobody reached is NULL here and 0 in the report."""
    return cond_sum(seen.where(F.col("event") == "tracker"), BY_CREATIVE,
                    {n: F.col("tracker").isin(*names) for n, names in VIDEO_STEPS.items()}, zero=False)


def video_tiles(log: DataFrame, creative_map: DataFrame, p: ReportParams) -> DataFrame:
    """Video progress of mapped creatives in the report and its attribution window."""
    seen = _delivered(log, p, ("tracker",), p.in_attribution(F.col("partition_time")))
    wanted = creative_map.select("campaign_id", "flight_id", "creative_id",
                                 F.col("target_country").alias("country"))
    return video_counts(in_rel(seen, wanted, list(BY_CREATIVE)))


def report_events(log: DataFrame, creative_map: DataFrame, p: ReportParams) -> DataFrame:
    """All rows of the log that a report needs, in one scan: mapped impressions, clicks and video
    progress, and the pixel events of the report's segments, each in its own window.
    """
    kind, at = F.col("event"), F.col("partition_time")
    segments = [v for v in (p.signup_segment, p.homepage_segment) if v is not None]
    pixel = (kind == "segment") & F.col("segment_id").isin(*segments) if segments else F.lit(False)
    rows = scan_events(not_dropped(log), min(p.page_lookback, p.window_start), p.attribution_end, p.countries)
    rows = rows.where((kind.isin("impression", "click") & p.in_window(at))
                      | ((kind == "tracker") & p.in_attribution(at))
                      | (pixel & at.between(ts_literal(p.page_lookback), ts_literal(p.attribution_end))))
    wanted = creative_map.select("campaign_id", "flight_id", "creative_id",
                                 F.col("target_country").alias("country")).distinct()
    rows = rows.select("event", "event_time", "device_id", "country", "campaign_id", "flight_id", "creative_id",
                       "segment_id", "tracker")
    rows = lookup(rows, wanted.withColumn("_mapped", F.lit(True)), list(BY_CREATIVE))
    return rows.where((kind == "segment") | F.col("_mapped")).drop("_mapped")


# Roles of a row of the log in a report with a device universe, each a bit.
SELLER, OWN, EXPOSURE, ADDRESS, VISIT = (1 << k for k in range(5))


def universe_log(log: DataFrame, creative_map: DataFrame, p: ReportParams, roles: int) -> DataFrame:
    """All that a report with a device universe asks of the log, in one scan: each row with a bit for each of its ``roles``.

    The scan covers the widest range that any role may ask for. How far back our own impressions count is
    known only from the sellers among these very rows, so that bound is applied to what was read.
    A row's tests on the event, time and country come before the map is joined, and rows without a role go.
    """
    kind, at, kept = F.col("event"), F.col("partition_time"), ~F.coalesce(F.col("dropped"), F.lit(False))
    segments = [v for v in (p.signup_segment, p.homepage_segment) if v is not None]
    shown, in_country = kind == "impression", p.in_country(F.col("country"))
    between = lambda lo, hi: at.between(ts_literal(lo), ts_literal(hi))
    mapped = {SELLER: F.col("_creatives").isNotNull(), EXPOSURE: F.array_contains("_creatives", F.col("creative_id"))}
    tests = {
        SELLER: shown & p.in_window(at) & in_country,
        OWN: kept & identity.own_impression(p) & between(p.window_start - timedelta(days=identity.EXTRA_DAYS), p.window_end) & in_country,
        EXPOSURE: kept & kind.isin("impression", "click") & p.in_window(at) & in_country,
        ADDRESS: kept & shown & p.in_attribution(at) & in_country & F.col("ip").isNotNull(),
        VISIT: (kind == "segment") & F.col("segment_id").isin(*segments) & between(p.page_lookback, p.attribution_end)
               & (F.col("country").isin(*p.countries) if p.countries else F.lit(True)) if segments else F.lit(False),
    }
    tests = {k: F.coalesce(v, F.lit(False)) for k, v in tests.items() if k & roles}
    lo = min([p.window_start, *([p.window_start - timedelta(days=identity.EXTRA_DAYS)] if roles & OWN else []),
              *([p.page_lookback] if roles & VISIT else [])])
    rows = log.where(between(lo, p.attribution_end if roles & (ADDRESS | VISIT) else p.window_end))

    def bits(found: dict) -> Column:
        return reduce(lambda a, b: a.bitwiseOR(b), [F.when(v, k).otherwise(0) for k, v in found.items()])

    columns = ["event", "event_time", "partition_time", "country", "device_id", "campaign_id", "flight_id", "creative_id", "seller_id"]
    columns += [c for role, c in ((ADDRESS | VISIT, "ip"), (VISIT, "segment_id")) if role & roles]
    rows = rows.select(*columns, identity.shown_device().alias("own_device_id"), bits(tests).alias("roles")).where(F.col("roles") > 0)
    # A row for each campaign, staged: its size is known, so that Spark sends it to the log and not the log to it.
    campaigns = stage(creative_map.where(F.col("campaign_id").isNotNull()).groupBy("campaign_id").agg(F.collect_set("creative_id").alias("_creatives")))
    rows = lookup(rows, campaigns, ["campaign_id"])
    unmapped = bits({k: (F.col("roles").bitwiseAND(F.lit(k)) > 0) & ~F.coalesce(v, F.lit(False)) for k, v in mapped.items() if k & roles})
    return rows.withColumn("roles", F.col("roles").bitwiseAND(F.bitwise_not(unmapped))).where(F.col("roles") > 0).drop("_creatives")


def with_role(rows: DataFrame, role: int) -> DataFrame:
    return rows.where(F.col("roles").bitwiseAND(F.lit(role)) > 0)


def exposed(rows: DataFrame, creative_map: DataFrame, universe: DataFrame, attach: Sequence[str] = ()) -> DataFrame:
    """:func:`exposures` from the rows of :func:`universe_log`."""
    shown = with_role(rows, EXPOSURE).select("device_id", "country", F.col("event_time").alias("exposure_time"),
                                             "campaign_id", "flight_id", "creative_id", "event")
    keys = ["campaign_id", "creative_id"]
    if attach:
        shown = inner(shown, creative_map.select(*keys, *attach).distinct(), keys)
    return in_rel(shown, universe, ["country", "device_id"])


def regional_log(copy: DataFrame) -> DataFrame:
    """The regional copy in the shape of the log; what it does not hold is NULL."""
    at = F.col("exposure_time")
    return conform(copy.withColumns({"event_time": at, "partition_time": at}), DELIVERY)


def delivered(events: DataFrame) -> DataFrame:
    """The exposures among the events of a report."""
    rows = events.where(F.col("event").isin("impression", "click"))
    return rows.select("device_id", "country", F.col("event_time").alias("exposure_time"), "campaign_id",
                       "flight_id", "creative_id", "event")


def with_product(impressions: DataFrame, meta: DataFrame) -> DataFrame:
    keys = ["campaign_id", "flight_id", "creative_id"]
    return inner(impressions, meta.select(*keys, "product_id", "product_name").distinct(), keys)
