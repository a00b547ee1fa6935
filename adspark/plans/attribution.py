"""Credit for conversions, by creative or by any other column of the exposure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adspark.functions.time import day_of, diff_units
from adspark.operators import touch
from adspark.operators.relational import in_rel, inner
from adspark.operators.windows import latest_per_key
from adspark.params import ReportParams
from adspark.plans.delivery import only

DEVICE = ("device_id",)
IDS = ("campaign_id", "flight_id", "creative_id")


def any_touch(exposed: DataFrame, conversions: DataFrame, by: Sequence[str], ts: str, max_days: int | None,
              keys: Sequence[str] = DEVICE, minutes: str | None = "minutes",
              date_of: str = "exposure") -> DataFrame:
    """Every exposure before a conversion gets credit, once per conversion.

    ``conversions`` counts pairs, ``minutes`` sums the usage over them (so a session counts once per
    exposure) and ``devices`` the distinct converters. With ``date_of='conversion'`` per
    conversion day as well.
    """
    measures = {minutes: F.col(minutes)} if minutes else {}
    daily = date_of == "conversion"
    dims = [b for b in by if b not in keys]
    totals = touch.pair_totals(exposed, conversions, keys, "exposure_time", ts, dims, measures,
                               max_days, by_conversion_day=daily)
    aggs = [F.sum("pairs").alias("conversions"), F.countDistinct("device_id").alias("devices")]
    if minutes:
        aggs.append(F.sum(minutes).alias(minutes))
    return totals.groupBy(*by, *(["conversion_day"] if daily else [])).agg(*aggs)


def any_touch_device_day(exposed: DataFrame, usage: DataFrame, by: Sequence[str],
                         keys: Sequence[str] = ("device_id", "country")) -> DataFrame:
    """Any touch without window at day grain, each usage day counted once per device and creative.

    A usage day counts if the first exposure day of the device is not later, so one row per device
    and creative is enough on the exposure side.
    """
    first = exposed.groupBy(*keys, *[c for c in by if c not in keys]).agg(
        F.min(day_of("exposure_time")).alias("exposure_time"))
    days = usage.groupBy(*keys, day_of("usage_time").alias("usage_time")).agg(F.sum("minutes").alias("minutes"))
    return any_touch(first, days, by, "usage_time", None, keys)


def last_touch(exposed: DataFrame, conversions: DataFrame, ts: str, max_days: int | None,
               keys: Sequence[str] = DEVICE, carry: Sequence[str] = IDS,
               per: Sequence[str] | None = None) -> DataFrame:
    """One row per conversion with its latest exposure.

    Same exposure time: the lowest campaign, flight and creative. ``per`` names what makes
    conversions one and the same; they are reduced to it first.
    """
    if per is not None:
        conversions = conversions.dropDuplicates(list(per))
    return touch.last_touch(exposed, conversions, keys, "exposure_time", ts, carry, max_days)


def last_touch_per_device(exposed: DataFrame, conversions: DataFrame, ts: str, max_days: int | None,
                          keys: Sequence[str] = DEVICE, carry: Sequence[str] = IDS) -> DataFrame:
    """The latest exposure of each device that led to a conversion, with the seconds between."""
    each = last_touch(exposed, conversions, ts, max_days, keys, carry)
    one = latest_per_key(each, keys, [F.col("exposure_time").desc(), F.col(ts).asc()])
    return one.withColumn("seconds_to_conversion", diff_units("second", "exposure_time", ts))


def nearest_touch(exposed: DataFrame, conversions: DataFrame, ts: str, keys: Sequence[str] = DEVICE,
                  carry: Sequence[str] = IDS, max_days: int | None = None) -> DataFrame:
    """The exposure with the smallest time gap, per device; same gap: the earlier exposure."""
    each = last_touch(exposed, conversions, ts, max_days, keys, carry)
    each = each.withColumn("seconds_to_conversion", diff_units("second", "exposure_time", ts))
    return latest_per_key(each, keys, [F.col("seconds_to_conversion").asc(),
                                       F.col("exposure_time").asc(), F.col(ts).asc()])


def first_touch(exposed: DataFrame, conversions: DataFrame, ts: str, max_days: int | None,
                keys: Sequence[str] = DEVICE, carry: Sequence[str] = IDS) -> DataFrame:
    return touch.first_touch(exposed, conversions, keys, "exposure_time", ts, carry, max_days)


def last_touch_daily(exposed: DataFrame, first: DataFrame, ts: str = "first_open",
                     keys: Sequence[str] = ("device_id", "country"), carry: Sequence[str] = IDS) -> DataFrame:
    """Last touch at day grain over impressions and clicks, without window."""
    days = exposed.select(*keys, *carry, day_of("exposure_time").alias("exposure_time")).distinct()
    return last_touch(days, first.withColumn(ts, day_of(ts)), ts, None, keys, carry)


def attribute(exposed: DataFrame, conversions: DataFrame, p: ReportParams, ts: str, touch: str = "last",
              by: Sequence[str] = IDS, keys: Sequence[str] = DEVICE, per: str | Sequence[str] | None = None,
              date_of: str = "exposure", minutes: str | None = None) -> DataFrame:
    """Conversions per group of exposures under one of the models any, last, nearest and first."""
    days = p.attribution_days
    if touch == "any":
        return any_touch(exposed, conversions, by, ts, days, keys, minutes, date_of)
    carry = tuple(dict.fromkeys((*IDS, *[b for b in by if b not in keys])))
    if touch == "nearest":
        credited = nearest_touch(exposed, conversions, ts, keys, carry, days)
    elif touch == "first":
        credited = first_touch(exposed, conversions, ts, days, keys, carry)
    elif per == "device":
        credited = last_touch_per_device(exposed, conversions, ts, days, keys, carry)
    else:
        credited = last_touch(exposed, conversions, ts, days, keys, carry, per)
    group: list[str | Column] = list(by)
    if date_of == "conversion":
        group.append(day_of(ts).alias("conversion_day"))
    aggs = [F.count("*").alias("conversions"), F.countDistinct("device_id").alias("devices")]
    if minutes:
        aggs.append(F.sum(minutes).alias(minutes))
    return credited.groupBy(*group).agg(*aggs)


def exposed_converters(exposed: DataFrame, conversions: DataFrame, ts: str, max_days: int | None,
                       keys: Sequence[str] = DEVICE) -> DataFrame:
    """Devices with an exposure before a conversion. Which exposure does not matter."""
    return touch.last_touch(exposed, conversions, keys, "exposure_time", ts, [],
                            max_days).select(*keys).distinct()


def threshold_converters(exposed: DataFrame, thresholds: DataFrame, first: DataFrame, creative_map: DataFrame,
                         p: ReportParams, flags: dict[str, str], keys: Sequence[str] = ("device_id", "country"),
                         map_keys: Sequence[str] = ("campaign_id", "creative_id")) -> DataFrame:
    """New users, by placement, that used the app long enough after an impression.

    All thresholds come from one pass: flags are summed over the pairs, and a device counts where
    its sum is not zero.
    """
    new = in_rel(only(exposed, "impression"), first, list(keys))
    totals = touch.pair_totals(new, thresholds, keys, "exposure_time", "usage_time", map_keys,
                               {f: F.col(f) for f in flags.values()}, p.attribution_days)
    places = inner(totals, creative_map.select(*map_keys, "placement_name").distinct(), list(map_keys))
    rows = F.explode(F.array(*[
        F.struct(F.lit(label).alias("time_threshold"), F.col(flag).alias("hits"))
        for label, flag in flags.items()]))
    long = places.select(*keys, "placement_name", rows.alias("t")).where("t.hits > 0")
    return long.groupBy("t.time_threshold", "placement_name").agg(
        F.countDistinct("device_id").alias("new_converter_count"))


def exposed_stats(exposed_opens: DataFrame, by: Sequence[str] = (*IDS, "country")) -> DataFrame:
    """Opens, average minutes and distinct openers of credited usage."""
    return exposed_opens.groupBy(*by).agg(
        F.count("*").alias("exposed_opens"), F.avg("minutes").alias("average_minutes"),
        F.countDistinct("device_id").alias("exposed_openers"))
