"""Exposed against unexposed audiences."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adspark.functions.columns import bucket_cap, safe_ratio
from adspark.functions.time import day_of
from adspark.operators import touch
from adspark.operators.relational import (
    attach_scalar, derive, lookup, same_day_keys, union_all, with_const)
from adspark.params import ReportParams
from adspark.plans import delivery
from adspark.stage import stage

MEDIA = ("native", "ctv", "stvp")


def audience_summary(subscribers: DataFrame, matched: DataFrame, audience: str) -> DataFrame:
    """Devices on the subscriber list, and those of them that used the app. One row."""
    raw = subscribers.agg(F.countDistinct("device_id").alias("listed_devices"))
    used = matched.agg(F.countDistinct("device_id").alias("matched_devices"))
    return with_const(attach_scalar(raw, used), audience=audience)


def _per_device(usage: DataFrame) -> DataFrame:
    return usage.groupBy("country", "device_id").agg(F.sum("hours").alias("_hours"))


def lift(imps: DataFrame, usage: DataFrame, universe_size: DataFrame, by: Sequence[str] = (),
         frequency_cap: int | None = None) -> DataFrame:
    """Conversion rate and time spent of exposed and unexposed devices, and the lift between them.

    One row per order and ``by``, or per number of impressions up to ``frequency_cap``. The unexposed
    side is the rest of the country's universe. Groups without an exposed user are left out.
    """
    group = ["country", "order_number", *by]
    shown = imps.groupBy(*group, "device_id").agg(F.sum("imps").alias("_imps"))
    if frequency_cap:
        group.append("impression_group")
        shown = shown.withColumn("impression_group", bucket_cap("_imps", frequency_cap))
    users = _per_device(usage)
    exposed = lookup(shown, users.withColumn("_user", F.lit(1)), ["country", "device_id"])
    return _rates(exposed, users, universe_size, group)


def _rates(exposed: DataFrame, users: DataFrame, universe_size: DataFrame, group: Sequence[str]) -> DataFrame:
    """The columns of :func:`lift`. ``exposed`` has a device once per group, so plain counts are distinct counts."""
    exposed = exposed.groupBy(*group).agg(
        F.count("_user").alias("exposed_users"), F.sum("_hours").alias("exposed_hours"),
        F.count("*").alias("reach"), F.sum("_imps").alias("imps")).where(F.col("exposed_users") > 0)
    totals = users.groupBy("country").agg(
        F.count("device_id").alias("total_users"), F.sum("_hours").alias("total_hours"))
    rows = exposed.join(totals, "country").join(universe_size, "country")
    return derive(
        rows,
        freq=safe_ratio("imps", "reach"),
        unexposed_universe=F.col("total_universe") - F.col("reach"),
        unexposed_users=F.col("total_users") - F.col("exposed_users"),
        unexposed_hours=F.col("total_hours") - F.col("exposed_hours"),
        exposed_rate=safe_ratio("exposed_users", "reach"),
        unexposed_rate=safe_ratio("unexposed_users", "unexposed_universe"),
        avg_unexposed_hours=safe_ratio("unexposed_hours", "unexposed_users"),
        avg_exposed_hours=safe_ratio("exposed_hours", "exposed_users"),
        lift=safe_ratio("exposed_rate", "unexposed_rate") - 1,
        lift_time_spent=safe_ratio("avg_exposed_hours", "avg_unexposed_hours") - 1)


CUTS = {"overall": None, "frequency": None, "placement": "line_item_name", "creative": "creative_id", "flight": "flight_id"}


def subscriber_lift(log: DataFrame, meta: DataFrame, matched: DataFrame, universe_size: DataFrame, p: ReportParams,
                    frequency_cap: int, cuts: Mapping[str, str | None] = CUTS) -> DataFrame:
    """All cuts of :func:`lift` in one pass, as rows of ``cut`` and ``value``.

    The counts per device and creative meet the users once. Only then is each row dealt to the groups of all
    cuts that the metadata puts its creative in, and a device's rows in one group are added up where the join has put them;
    each carries the device's flag and hours, so that distinct counts are sums. The log is read once.
    """
    counts = delivery.creative_impressions_per_device(log, meta, p)
    users = stage(_per_device(matched))
    named = [(name, column) for name, column in cuts.items() if name != "frequency"]
    whole = "overall" if "overall" in cuts else "_overall"  # the groups that buckets of frequency are made from
    if "frequency" in cuts and "overall" not in cuts:
        named.append((whole, None))
    groups = F.array(*[F.struct(F.lit(name).alias("cut"), "order_number",
                                (F.col(column) if column else F.lit(None)).cast("string").alias("value")) for name, column in named])
    member = (meta.select(*delivery.IN_CAMPAIGN, F.explode(groups).alias("g")).groupBy(*delivery.IN_CAMPAIGN)
              .agg(F.collect_set("g").alias("groups")))
    flagged = lookup(counts, users.withColumn("_user", F.lit(1)), ["country", "device_id"])
    dealt = flagged.join(member, list(delivery.IN_CAMPAIGN)).select("country", "device_id", "imps", "_user", "_hours", F.explode("groups").alias("g"))
    shown = dealt.groupBy("country", "device_id", "g.cut", "g.order_number", "g.value").agg(
        F.sum("imps").alias("_imps"), F.first("_user").alias("_user"), F.first("_hours").alias("_hours"))
    if "frequency" in cuts:
        bucket = F.struct(F.lit("frequency").alias("cut"), bucket_cap("_imps", frequency_cap).cast("string").alias("value"))
        own = F.struct("cut", "value")
        both = F.when(F.col("cut") == whole, F.array(own, bucket) if "overall" in cuts else F.array(bucket)).otherwise(F.array(own))
        shown = shown.withColumn("g", F.explode(both)).drop("cut", "value").select("*", "g.cut", "g.value")
    return _rates(shown, users, stage(universe_size), ["country", "order_number", "cut", "value"])


def daily_exposure(imps: DataFrame, usage: DataFrame, universe_size: DataFrame) -> DataFrame:
    """Per day: reach, users, and users that were shown the campaign the same day."""
    key = ["country", "day"]
    users = usage.groupBy("country", day_of("usage_time").alias("day")).agg(
        F.countDistinct("device_id").alias("total_users"))
    shown = imps.groupBy("order_number", *key).agg(
        F.countDistinct("device_id").alias("reach"), F.sum("imps").alias("imps"))
    both = same_day_keys(usage, imps, ["country", "device_id"], "usage_time", "day")
    exposed = both.groupBy(*key).agg(F.count("*").alias("exposed_users"))
    return derive(
        users.join(shown, key).join(exposed, key).join(universe_size, "country"),
        unexposed_universe=F.col("total_universe") - F.col("reach"),
        unexposed_users=F.col("total_users") - F.col("exposed_users"))


def unexposed_rate(universe: DataFrame, exposed: DataFrame, converted: DataFrame) -> DataFrame:
    """One row: unexposed devices of the universe, converters among them, their rate."""
    flags = union_all(
        universe.select("device_id", F.lit("u").alias("_of")),
        exposed.select("device_id", F.lit("e").alias("_of")),
        converted.select("device_id", F.lit("c").alias("_of")))
    seen = {n: F.max(F.when(F.col("_of") == n, 1).otherwise(0)).alias(n) for n in ("u", "e", "c")}
    rest = flags.groupBy("device_id").agg(*seen.values()).where((F.col("u") == 1) & (F.col("e") == 0))
    return rest.agg(F.count("*").alias("unexposed_devices"),
                    F.coalesce(F.sum("c"), F.lit(0)).alias("unexposed_converters")).withColumn(
        "unexposed_conversion_rate", safe_ratio("unexposed_converters", "unexposed_devices"))


def _combos(n: Callable[[str], Column], has: Callable[[str], Column], exclusive: bool,
            literal: bool) -> dict[str, Column]:
    """Per combination the total of ``n`` over its media, 0 for devices that are not in it."""

    def alone(medium: str) -> Column:
        others = [m for m in MEDIA if m != medium]
        free = ~has(others[0]) & ~has(others[1])
        return F.when(free, n(medium)).otherwise(0) if exclusive else n(medium)

    def when(test: Column, *media: str) -> Column:
        total = n(media[0])
        for m in media[1:]:
            total = total + n(m)
        return F.when(test, total).otherwise(0)

    if literal:
        either_and_native = n("ctv") + when(has("stvp") & has("native"), "stvp", "native")
    else:
        either_and_native = when(has("native") & (has("ctv") | has("stvp")), *MEDIA)
    return {
        "native": alone("native"),
        "ctv": alone("ctv"),
        "stvp": alone("stvp"),
        "ctv_and_stvp": when(has("ctv") & has("stvp"), "ctv", "stvp"),
        "ctv_or_stvp_and_native": either_and_native,
        "ctv_or_stvp": alone("ctv") + alone("stvp"),
        "all_media": when(has("native") & has("ctv") & has("stvp"), *MEDIA),
    }


COMBO_NAMES = ("native", "ctv", "stvp", "ctv_and_stvp", "ctv_or_stvp_and_native", "ctv_or_stvp", "all_media")


def _media_counts(shown: DataFrame, value: Column, prefix: str) -> list[Column]:
    return [F.sum(F.when(F.col("media") == m, value).otherwise(0)).alias(prefix + m) for m in MEDIA]


def media_combos(shown: DataFrame, exclusive: bool = False, literal: bool = False) -> DataFrame:
    """Impressions and reach of every media combination, from one row per device.

    ``shown`` has ``device_id`` and ``media``. ``exclusive`` limits the single-medium groups to devices
    that saw no other medium. ``literal`` keeps every CTV row in the "CTV or STVP and native" group.
    """
    per_device = shown.groupBy("device_id").agg(*_media_counts(shown, F.lit(1), "n_"))
    combos = _combos(lambda m: F.col("n_" + m), lambda m: F.col("n_" + m) > 0, exclusive, literal)
    long = per_device.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("combo"), total.cast("long").alias("imps"))
        for name, total in combos.items()])).alias("c"))
    return long.where("c.imps > 0").groupBy("c.combo").agg(
        F.sum("c.imps").alias("impressions"), F.count("*").alias("reach"))


def product_lift(shown: DataFrame, pixels: DataFrame, universe: DataFrame, max_days: int,
                 unexposed: str = "not_exposed", exclusive: bool = False, literal: bool = False) -> DataFrame:
    """One lift row per media combination, in one grouped job.

    A device converts for a combination if an exposure to one of its media is followed by a pixel
    event within the window. ``unexposed`` is the rest of the universe: ``not_exposed``, or
    ``not_converted`` for the rest after taking out exposed converters only.
    """
    converted = touch.pair_totals(shown, pixels, ["device_id"], "exposure_time", "visit_time", ["media"],
                                  max_days=max_days)
    parts = union_all(
        shown.select("device_id", "media", F.lit("shown").alias("_of")),
        converted.select("device_id", "media", F.lit("converted").alias("_of")),
        universe.select("device_id", F.lit(None).cast("string").alias("media"), F.lit("universe").alias("_of")),
        pixels.select("device_id", F.lit(None).cast("string").alias("media"), F.lit("pixel").alias("_of")))

    def flag(name: str) -> Column:
        return F.max(F.when(F.col("_of") == name, 1).otherwise(0))

    per_device = parts.where(F.col("device_id").isNotNull()).groupBy("device_id").agg(
        *_media_counts(parts, F.when(F.col("_of") == "shown", 1).otherwise(0), "n_"),
        *_media_counts(parts, F.when(F.col("_of") == "converted", 1).otherwise(0), "c_"),
        flag("universe").alias("_u"), flag("pixel").alias("_p"))

    def has(m: str) -> Column:
        return F.col("n_" + m) > 0

    imps = _combos(lambda m: F.col("n_" + m), has, exclusive, literal)
    conv = _combos(lambda m: F.col("c_" + m), has, exclusive, literal)
    long = per_device.select("_u", "_p", F.explode(F.array(*[
        F.struct(F.lit(n).alias("combo"), imps[n].cast("long").alias("imps"),
                 (conv[n] > 0).cast("int").alias("conv")) for n in COMBO_NAMES])).alias("c"))
    long = long.select("_u", "_p", "c.*")
    out = F.col("imps") > 0 if unexposed == "not_exposed" else F.col("conv") > 0
    rest = (F.col("_u") == 1) & ~out
    # Every device has a row per combination, so combinations nobody saw are there with zeros.
    rows = long.groupBy(F.col("combo").alias("media_ad_type")).agg(
        F.sum("imps").alias("impressions"),
        F.count_if(F.col("imps") > 0).alias("reach"),
        F.sum("conv").cast("long").alias("website_conversions"),
        F.count_if(rest).alias("_rest"),
        F.count_if(rest & (F.col("_p") == 1)).alias("_rest_converted"))
    return derive(
        rows,
        exposed_conversion_rate=safe_ratio("website_conversions", "reach", default=0),
        unexposed_conversion_rate=safe_ratio("_rest_converted", "_rest"),
        website_visitation_lift=safe_ratio("exposed_conversion_rate", "unexposed_conversion_rate") - 1,
        incremental_reach=F.lit(None).cast("long"),
        avg_freq=F.lit(None).cast("double")).drop("_rest", "_rest_converted")
