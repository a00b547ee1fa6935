"""The touch kernels against brute force, and on a device that holds a third of all rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adspark.operators import touch

T0 = datetime(2024, 1, 1)
SHOWN = "device_id long, exposure_time timestamp_ntz, campaign_id long, event string"
DONE = "device_id long, usage_time timestamp_ntz, minutes long"


def sample(seed: int, n: int, days: int = 12):
    """Few devices, many equal times, times on slice and day edges."""
    rnd = random.Random(seed)

    def at():
        base = T0 + timedelta(days=rnd.randrange(days), hours=rnd.choice([0, 0, 10, 23]))
        return base + timedelta(minutes=rnd.choice([0, 0, 1, 59]), seconds=rnd.choice([0, 59]))

    shown = [(rnd.choice([1, 1, 2, 3]), at(), rnd.randrange(4), "impression") for _ in range(n)]
    done = [(rnd.choice([1, 1, 2, 4]), at(), rnd.randrange(5)) for _ in range(n)]
    return shown, done


def valid(shown_at, done_at, max_days):
    return shown_at <= done_at and (max_days is None or (done_at.date() - shown_at.date()).days <= max_days)


@pytest.mark.parametrize("max_days", [None, 0, 1, 7])
@pytest.mark.parametrize("slice_minutes", [60, 7])
def test_last_touch(spark, make, max_days, slice_minutes):
    shown, done = sample(1, 120)
    expected = Counter()
    for d, t, m in done:
        hits = [(s, -c) for dev, s, c, _ in shown if dev == d and valid(s, t, max_days)]
        if hits:
            s, c = max(hits)
            expected[(d, t, m, s, -c)] += 1
    got = touch.last_touch(make(SHOWN, *shown), make(DONE, *done), ["device_id"], "exposure_time", "usage_time",
                           ["campaign_id"], max_days, slice_minutes)
    assert Counter(tuple(r) for r in got.collect()) == expected


@pytest.mark.parametrize("max_days", [None, 0, 7])
def test_first_touch(spark, make, max_days):
    shown, done = sample(2, 120)
    expected = Counter()
    for d, t, m in done:
        hits = [(s, c) for dev, s, c, _ in shown if dev == d and valid(s, t, max_days)]
        if hits:
            s, c = min(hits)
            expected[(d, t, m, s, c)] += 1
    got = touch.first_touch(make(SHOWN, *shown), make(DONE, *done), ["device_id"], "exposure_time", "usage_time",
                            ["campaign_id"], max_days)
    assert Counter(tuple(r) for r in got.collect()) == expected


@pytest.mark.parametrize("daily", [False, True])
@pytest.mark.parametrize("max_days", [None, 0, 1, 7])
def test_pair_totals(spark, make, max_days, daily):
    shown, done = sample(3, 120)
    pairs, minutes = Counter(), Counter()
    for dev, s, c, _ in shown:
        for d, t, m in done:
            if dev == d and valid(s, t, max_days):
                key = (dev, c, t.date()) if daily else (dev, c)
                pairs[key] += 1
                minutes[key] += m
    got = touch.pair_totals(make(SHOWN, *shown), make(DONE, *done), ["device_id"], "exposure_time", "usage_time",
                            ["campaign_id"], {"minutes": "minutes"}, max_days, by_conversion_day=daily)
    keys = ["device_id", "campaign_id"] + (["conversion_day"] if daily else [])
    rows = {tuple(r[k] for k in keys): (r["pairs"], r["minutes"]) for r in got.collect()}
    assert rows == {k: (pairs[k], minutes[k]) for k in pairs}


def test_boundaries(spark, make):
    """Seven calendar days later is in, eight is out, the same moment is in, a second before is out."""
    shown = make(SHOWN, (1, "2024-01-01 23:00:00", 5, "impression"))
    done = make(DONE, (1, "2024-01-08 01:00:00", 1), (1, "2024-01-09 01:00:00", 2), (1, "2024-01-01 23:00:00", 3),
                (1, "2024-01-01 22:59:59", 4))
    got = touch.last_touch(shown, done, ["device_id"], "exposure_time", "usage_time", ["campaign_id"], 7)
    assert sorted(r["minutes"] for r in got.collect()) == [1, 3]
    total = touch.pair_totals(shown, done, ["device_id"], "exposure_time", "usage_time", [], {"minutes": "minutes"}, 7)
    assert [(r["pairs"], r["minutes"]) for r in total.collect()] == [(2, 4)]


def test_ties_take_the_lowest_creative(spark, make):
    shown = make(SHOWN, (1, "2024-01-01 10:00:00", 9, "impression"), (1, "2024-01-01 10:00:00", 3, "click"))
    done = make(DONE, (1, "2024-01-01 10:00:00", 1))
    got = touch.last_touch(shown, done, ["device_id"], "exposure_time", "usage_time", ["campaign_id"], 7)
    assert [r["campaign_id"] for r in got.collect()] == [3]


def test_rows_without_key_or_time_take_no_part(spark, make):
    shown = make(SHOWN, (None, "2024-01-01 10:00:00", 9, "impression"), (1, None, 3, "click"))
    done = make(DONE, (None, "2024-01-01 11:00:00", 1), (1, "2024-01-01 11:00:00", 1), (1, None, 1))
    args = (["device_id"], "exposure_time", "usage_time")
    assert touch.last_touch(shown, done, *args, ["campaign_id"], 7).count() == 0
    assert touch.pair_totals(shown, done, *args, ["campaign_id"], max_days=7).count() == 0


def test_hot_device(spark):
    """60,000 exposures and 60,000 conversions of one device: 1.8 billion pairs, none of them built."""
    n = 60_000
    step = F.timestamp_add("SECOND", F.col("id") * 10, F.lit(str(T0)).cast("timestamp_ntz"))
    other = F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1)
    rows = spark.range(0, 3 * n // 2).withColumn("device_id", other)
    shown = rows.select("device_id", step.alias("exposure_time"), (F.col("id") % 2).alias("campaign_id"))
    done = rows.select("device_id", step.alias("usage_time"), F.lit(1).cast("long").alias("minutes"))
    total = touch.pair_totals(shown, done, ["device_id"], "exposure_time", "usage_time", ["campaign_id"],
                              {"minutes": "minutes"}, 7)
    got = {r["campaign_id"]: r["pairs"] for r in total.where("device_id = 1").collect()}

    hot = [i for i in range(3 * n // 2) if i % 3]
    day_end = defaultdict(int)  # conversions up to the end of a day
    for i in hot:
        day_end[i * 10 // 86400] += 1
    days = sorted(day_end)
    upto, running = {}, 0
    for d in days:
        running += day_end[d]
        upto[d] = running
    expected = Counter()
    for before, i in enumerate(hot):
        last = min(i * 10 // 86400 + 7, days[-1])
        expected[i % 2] += upto[last] - before
    assert got == dict(expected)

    last = touch.last_touch(shown, done, ["device_id"], "exposure_time", "usage_time", ["campaign_id"], 7)
    assert last.where("exposure_time = usage_time").count() == last.count() == 3 * n // 2


def test_hot_device_of_many_creatives(spark):
    """One device, 2,000 creatives over 60 days, by conversion day and without a limit."""
    step = F.timestamp_add("SECOND", F.col("id") * 259, F.lit(str(T0)).cast("timestamp_ntz"))
    rows = spark.range(0, 20_000).withColumn("device_id", F.lit(1).cast("long"))
    shown = rows.select("device_id", step.alias("exposure_time"), (F.col("id") % 2000).alias("campaign_id"))
    done = rows.select("device_id", step.alias("usage_time"), F.lit(2).cast("long").alias("minutes"))
    total = touch.pair_totals(shown, done, ["device_id"], "exposure_time", "usage_time", ["campaign_id"],
                              {"minutes": "minutes"}, None, by_conversion_day=True)
    got = {r["conversion_day"]: (r["pairs"], r["minutes"]) for r in total.groupBy("conversion_day").agg(
        F.sum("pairs").alias("pairs"), F.sum("minutes").alias("minutes")).collect()}
    expected = Counter()
    for i in range(20_000):
        expected[(T0 + timedelta(seconds=i * 259)).date()] += i + 1
    assert got == {day: (n, 2 * n) for day, n in expected.items()}


def test_plans_build_no_pairs(spark, make):
    """Joins meet one row per slice; no task holds a device's rows by creative, and no list is collected."""
    shown, done = sample(4, 5)
    shown, done = make(SHOWN, *shown), make(DONE, *done)
    args = (["device_id"], "exposure_time", "usage_time", ["campaign_id"])
    for max_days in (None, 7):
        for daily in (False, True):
            plan = touch.pair_totals(shown, done, *args, max_days=max_days, by_conversion_day=daily)
            text = plan._jdf.queryExecution().executedPlan().toString()
            assert not re.search("CartesianProduct|NestedLoop|collect_list", text)
            if not daily:  # by day that step has run and been staged
                by_device = text[text.index("REPARTITION_BY"):].split("Exchange")[0]
                assert "campaign_id" not in by_device
    last = touch.last_touch(shown, done, *args, 7)
    last.collect()
    plan = last._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan  # the time line is shuffled once for both of its readers
