"""Exact reach of many cuts from bitmaps of dense device numbers.

Devices get numbers without gaps once. A day's exposures become, for each of its finest groups, bitmaps of the devices seen (32,768
devices each) and a count of impressions. Bitmaps of days and groups are joined by OR, so reach by any cut and over any
days comes from them: the log and the devices aren't read again, and nothing is expanded but rows of bitmaps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from adspark.functions.columns import safe_ratio
from adspark.functions.time import day_of
from adspark.operators.relational import not_exists
from adspark.operators.windows import numbered_rows
from adspark.stage import stage

FINEST = ("country", "campaign_id", "flight_id", "creative_id")
#: The cuts of a reach cube by name.
CUBE: Mapping[str, Sequence[str]] = {
    "creative": ("country", "campaign_id", "flight_id", "creative_id"), "flight": ("country", "campaign_id", "flight_id"),
    "campaign": ("country", "campaign_id"), "campaign and week": ("country", "campaign_id", "week"),
    "country": ("country",), "country and week": ("country", "week"), "all": ()}


def device_numbers(devices: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """device_id and a number from 0 on without gaps; devices in ``known`` keep theirs, new ones follow."""
    new = devices.select("device_id").where(F.col("device_id").isNotNull()).distinct()
    if known is None:
        return numbered_rows(new, ["device_id"], "number")
    first = F.coalesce(known.agg(F.max("number") + 1).scalar(), F.lit(0))
    fresh = numbered_rows(not_exists(new, known, ["device_id"]), ["device_id"], "number")
    return known.select("device_id", "number").unionByName(fresh.withColumn("number", F.col("number") + first))


def daily_bitmaps(exposed: DataFrame, numbers: DataFrame, by: Sequence[str] = FINEST) -> DataFrame:
    """Per day, group and bucket of devices: a bitmap of the devices with an impression, and the impressions.

    A device's impressions of a day are counted before the numbers are looked up. Impressions without a device are
    counted in a bucket of their own, whose bitmap is empty.
    """
    shown = exposed.where(F.col("event") == "impression")
    per_device = shown.groupBy(day_of("exposure_time").alias("day"), *by, "device_id").agg(F.count("*").alias("impressions"))
    at = per_device.join(numbers, "device_id", "left")
    bucket, position = F.bitmap_bucket_number(F.col("number") + 1), F.bitmap_bit_position(F.col("number") + 1)  # buckets count from 1
    return at.groupBy("day", *by, F.coalesce(bucket, F.lit(0)).alias("bucket")).agg(
        F.bitmap_construct_agg(position).alias("devices"), F.sum("impressions").alias("impressions"))


def reach_cube(bitmaps: DataFrame, cuts: Mapping[str, Sequence[str]] = CUBE) -> DataFrame:
    """Impressions, reach and frequency of every cut in one pass, as rows of ``cut`` and the cuts' columns.

    The days' bitmaps of a week are joined first. GROUPING SETS then deal rows of bitmaps, not devices. ``week`` is the Monday.
    """
    columns = sorted({c for cut in cuts.values() for c in cut})
    finest = bitmaps.withColumn("week", F.date_trunc("week", "day").cast("date")) if "week" in columns else bitmaps
    weekly = finest.groupBy(*columns, "bucket").agg(F.bitmap_or_agg("devices").alias("devices"), F.sum("impressions").alias("impressions"))
    sets = [[F.col("bucket"), *[F.col(c) for c in cut]] for cut in cuts.values()]
    per_bucket = weekly.groupingSets(sets, *columns, "bucket").agg(
        F.grouping_id().alias("_cut"), F.bitmap_or_agg("devices").alias("devices"), F.sum("impressions").alias("impressions"))
    name = F.lit(None).cast("string")
    for cut, by in cuts.items():
        bits = sum(0 if c in by else 1 << (len(columns) - k) for k, c in enumerate(columns))  # the first column is the highest bit, bucket the lowest
        name = F.when(F.col("_cut") == bits, cut).otherwise(name)
    return per_bucket.groupBy(name.alias("cut"), *columns).agg(
        F.sum("impressions").alias("impressions"), F.sum(F.bitmap_count("devices")).alias("reach")).withColumn(
        "frequency", safe_ratio("impressions", "reach"))


def reach_of(exposed: DataFrame, cuts: Mapping[str, Sequence[str]] = CUBE) -> DataFrame:
    """:func:`reach_cube` of exposures, numbering their devices."""
    exposed = stage(exposed)
    return reach_cube(stage(daily_bitmaps(exposed, device_numbers(exposed))), cuts)
