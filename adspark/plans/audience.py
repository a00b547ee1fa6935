"""Audiences: registrations, random hold-out, subscriber matching."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from adspark.functions.columns import hash_bucket, json_path, split_part
from adspark.operators.relational import contains, in_rel, not_exists, not_in_rel, union_distinct
from adspark.operators.windows import random_ntile
from adspark.params import months_back
from adspark.schemas import empty_like, schema
from adspark.sinks.export import export_named
from adspark.sinks.tables import current, has_version, refresh_table
from adspark.sources.scan import scan_events

AUDIENCE_DAYS = 45
CONTROL_PERCENT = 10
LIST_MONTHS = 18


def payload_match(app: str, goal: str, form: str = "delimited") -> Column:
    """Is a voice event a registration? Its payload is delimited text or JSON.

    Delimited: the app is in part 1 (any case), the goal in part 4. JSON: both must be equal.
    """
    if form == "json":
        return (json_path("payload", "$.appid") == app) & (json_path("payload", "$.exe_goal") == goal)
    return contains(split_part("payload", ",", 1), app, ignore_case=True) & contains(
        split_part("payload", ",", 4), goal)


def registrations(voice: DataFrame, lo: datetime, hi: datetime, category: str, match: Column,
                  id_map: DataFrame | None = None, countries=()) -> DataFrame:
    """Distinct registered devices per country between two partition hours."""
    rows = scan_events(voice, lo, hi, countries).where((F.col("category") == category) & match)
    rows = rows.select("country", "source_id").distinct()
    return rows if id_map is None else in_rel(rows, id_map, "source_id")


def control_group(new: DataFrame, key: str = "source_id", pct: int = CONTROL_PERCENT, seed: int = 0,
                  exact: bool = False) -> DataFrame:
    """A reproducible random hold-out of new registrants.

    By hash bucket: each key is decided on its own, without a shuffle. ``exact`` ranks all keys into
    100 tiles and takes the first ``pct``; with fewer than 100 keys every tile holds at most one.
    """
    if exact:
        return random_ntile(new, key, 100, seed).where(F.col("tile") <= pct).drop("tile")
    return new.where(hash_bucket(key, 100, seed) < pct)


def roll_control(new: DataFrame, old: DataFrame) -> DataFrame:
    """The control group only grows."""
    return union_distinct(new, old.select(*new.columns))


def audience(registered: DataFrame, control: DataFrame, key: str = "source_id") -> DataFrame:
    return not_in_rel(registered, control, key)


def audience_job(voice: DataFrame, id_map: DataFrame, old_control: DataFrame, run_date: date, category: str,
                 app: str, goal: str, countries=(), seed: int = 0, days: int = AUDIENCE_DAYS) -> tuple[DataFrame, DataFrame]:
    """All countries at once: the new control group and the audience without it.

    If the old control group has a country, hold-out and audience are kept apart by country: someone
    held out in one country may be in the audience of another.
    """
    yesterday = datetime.combine(run_date - timedelta(days=1), time())
    last_hour = yesterday.replace(hour=23)
    first = datetime.combine(run_date - timedelta(days=days), time())
    match = payload_match(app, goal)
    recent = registrations(voice, first, last_hour, category, match, id_map, countries)
    new = registrations(voice, yesterday, last_hour, category, match, id_map, countries)
    held = control_group(new, seed=seed)
    if "country" in old_control.columns:
        control = roll_control(held.select("country", "source_id"), old_control)
        return control, not_exists(recent.where(F.col("source_id").isNotNull()), control, ["country", "source_id"])
    control = roll_control(held.select("source_id"), old_control)
    return control, audience(recent, control)


def audience_delivery(voice: DataFrame, id_map: DataFrame, folder: str, path, run_date: date, category: str,
                      app: str, goal: str, countries=(), seed: int = 0, days: int = AUDIENCE_DAYS) -> list[str]:
    """One night: refresh the tables ``control`` and ``segment`` under ``folder``, then write each country's
    lists to ``path(list, country)``.

    The control group of the night before is the version in force of its table; there is none in
    the first night. A country without a row has no file.
    """
    spark = voice.sparkSession
    old = current(spark, f"{folder}/control") if has_version(spark, f"{folder}/control") else empty_like(
        spark, schema(country="str", source_id="str"))
    control, segment = audience_job(voice, id_map, old.select("country", "source_id"), run_date, category, app, goal,
                                    countries, seed, days)
    refresh_table(control, f"{folder}/control")
    control = current(spark, f"{folder}/control")
    # From the stored control group, so that the two lists exclude each other whatever is read again.
    refresh_table(not_exists(segment, control, ["country", "source_id"]), f"{folder}/segment")
    lists = [df.select(F.lit(name).alias("_list"), "country", "source_id")
             for name, df in (("control", control), ("segment", current(spark, f"{folder}/segment")))]
    rows = lists[0].unionByName(lists[1]).withColumn("_path", path(F.col("_list"), F.col("country")))
    return export_named(rows.where(F.col("_path").isNotNull()), "_path", ["source_id"], ["_list", "country"])


def registered_months(voice: DataFrame, run_date: date, category: str, match: Column, months: int = LIST_MONTHS,
                      id_map: DataFrame | None = None, countries=()) -> DataFrame:
    """Everyone registered in the last 18 months up to yesterday, without a hold-out."""
    yesterday = datetime.combine(run_date - timedelta(days=1), time(23))
    first = datetime.combine(months_back(run_date, months), time())
    return registrations(voice, first, yesterday, category, match, id_map, countries).select("source_id").distinct()


def subscriber_ids(listed: DataFrame, id_map: DataFrame) -> DataFrame:
    """Devices of a list of source ids, whatever the case in the map."""
    mapped = id_map.select(F.lower("source_id").alias("source_id"), "device_id")
    return listed.join(mapped, "source_id", "left").select("device_id").distinct()


def matched_audience(universe: DataFrame, subscribers: DataFrame) -> DataFrame:
    return in_rel(universe, subscribers, "device_id").select("country", "device_id").distinct()


def matched_usage(usage: DataFrame, matched: DataFrame) -> DataFrame:
    """Usage of subscribers in the universe. Order in time is not asked for."""
    return in_rel(usage, matched, ["country", "device_id"]).groupBy("country", "device_id", "usage_time").agg(
        F.sum("opens").alias("opens"), F.sum("hours").alias("hours"))
