"""Reports: the weekly partner report and the creative, download, campaign and time tables.

Aggregates are joined to a spine of campaign rows. Both are small next to the logs. Steps read by
several aggregates are staged. Every report reads the delivery log once: the rows it needs, with the
roles they play, are staged, and the seller test, universe, exposures, addresses and visits are read from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from adspark.functions.columns import safe_ratio, without_commas
from adspark.functions.time import date_literal, day_of
from adspark.operators.relational import attach_scalar, cond_sum, in_rel, left_star
from adspark.operators.windows import latest_per_key, row_rank
from adspark.params import ReportParams
from adspark.plans import attribution, conversions, delivery, finance, identity, mapping
from adspark.sinks.export import MAX_ROWS, export_by_country, report_path, route
from adspark.stage import stage


@dataclass(frozen=True)
class Tables:
    """The inputs of a report."""

    delivery: DataFrame
    sessions: DataFrame
    id_map: DataFrame
    apps: DataFrame
    mapping: DataFrame
    hardware: DataFrame | None = None
    app_opens: DataFrame | None = None
    regional_exposures: DataFrame | None = None
    regional_usage: DataFrame | None = None


BY_COUNTRY = ("campaign_id", "flight_id", "creative_id", "country")
KEYS = ("device_id", "country")

# The recipients' column order, and the order of the rows.
REPORT_COLUMNS = (
    "report_execution_date", "advertiser_id", "advertiser", "insertion_order_name", "campaign_id",
    "campaign_name", "campaign_start_date", "campaign_end_date", "flight_id", "flight_name",
    "flight_start_date", "flight_end_date", "line_item_id", "line_item_name", "creative_id",
    "creative_name", "rate_type", "rate", "placement_impressions_booked", "booked_budget",
    "impressions_delivered", "budget_delivered", "clicks", "ctr", "cpc", "reach", "frequency",
    "installs", "average_exposed_time_spent_minutes", "video_start", "video_25", "video_50",
    "video_75", "video_completions", "total_exposed_app_openers", "total_exposed_app_opens",
    "first_time_exposed_app_opens", "total_signup_page_visit", "total_exposed_signup_page_visits",
    "total_first_time_exposed_signup_page_visits", "total_homepage_page_visits",
    "total_exposed_homepage_page_visits", "total_first_time_exposed_homepage_page_visits")
RANK_COLUMNS = ("advertiser", "country", "campaign_id", "flight_id", "line_item_id", "creative_id",
                "impressions_delivered")


def universe_of(t: Tables, creative_map: DataFrame, p: ReportParams) -> DataFrame:
    start = identity.qualified_start(t.delivery, creative_map, p)
    return identity.device_universe(t.hardware, t.delivery, t.app_opens, t.id_map, p, start)


def _fresh_map(t: Tables, p: ReportParams) -> DataFrame:
    mapping.assert_fresh(t.mapping, p.run_date)
    return mapping.creative_map(t.mapping, p)


def read_once(t: Tables, creative_map: DataFrame, p: ReportParams, also: int = 0) -> tuple[DataFrame, DataFrame]:
    """The staged rows of the log that the report needs (``also``: further roles), and the device universe."""
    roles = delivery.SELLER | delivery.OWN | delivery.EXPOSURE | also
    rows = stage(delivery.universe_log(t.delivery, creative_map, p, roles))
    start = identity.start_of(delivery.with_role(rows, delivery.SELLER), p)
    own = delivery.with_role(rows, delivery.OWN).withColumn("device_id", F.col("own_device_id"))
    return rows, stage(identity.universe_with(t.hardware, own, t.app_opens, t.id_map, p, start))


def partner_weekly_report(t: Tables, p: ReportParams, source: str = "log") -> DataFrame:
    """43 columns per campaign, flight, line item and creative, for all countries in one job.

    The delivery log is scanned once, for all kinds of event. With ``source='regional'`` exposures and
    usage come from the regional copies, which know devices and no source ids, trackers or segments:
    a device's openings at one time get one credit, video steps are 0 and page visits NULL.
    A mapping that is too old for the run date (or, without one, for today) stops this report and all others.
    """
    if source not in ("log", "regional"):
        raise ValueError(f"unknown source: {source}")
    regional = source == "regional"
    mapping.assert_fresh(t.mapping, p.run_date)
    meta = mapping.campaign_meta(t.mapping, p)
    creatives = mapping.report_creatives(meta)
    markets = creatives.select(F.col("target_country").alias("country")).distinct()

    log = delivery.regional_log(t.regional_exposures) if regional else t.delivery
    events = stage(delivery.report_events(log, creatives, p))
    shown = delivery.delivered(events)
    impressions = delivery.only(shown, "impression")
    if regional:
        usage = stage(conversions.regional_app_usage(in_rel(t.regional_usage, markets, "country"), p))
    else:
        usage = stage(conversions.app_usage(in_rel(t.sessions, markets, "country"), t.id_map, t.apps, p))
    in_window = conversions.usage_in_window(usage, p)
    first = conversions.first_app_open(usage, p)
    visits = in_rel(conversions.visits_of(events), markets, "country")
    first_visits = conversions.first_visit(visits, p)

    stats = delivery.delivery_stats(shown, BY_COUNTRY)
    reach = delivery.reach_frequency(shown, BY_COUNTRY).select(*BY_COUNTRY, "reach")

    # One last-touch pass for all four kinds of conversion: they share exposures, keys and window.
    kinds = _conversion_kinds(in_window, first, visits, first_visits)
    credited = attribution.last_touch(impressions, kinds, "conversion_time", p.attribution_days, KEYS)
    if regional:  # also where one device was seen in several countries
        credited = latest_per_key(credited, ["device_id", "kind", "conversion_time"], [
            F.col("exposure_time").desc(), *[F.col(c) for c in BY_COUNTRY]])
    exposed = _credited_counts(credited, p)

    spine = meta.select(
        "report_execution_date", "advertiser_id", F.col("advertiser_name").alias("advertiser"),
        F.col("order_name").alias("insertion_order_name"), "campaign_id", "campaign_name",
        F.col("campaign_start").alias("campaign_start_date"), F.col("campaign_end").alias("campaign_end_date"),
        "flight_id", "flight_name", F.col("flight_start").alias("flight_start_date"),
        F.col("flight_end").alias("flight_end_date"), "line_item_id", "line_item_name", "creative_id",
        "creative_name", "rate_type", "rate", F.col("booked_impressions").alias("placement_impressions_booked"),
        "booked_budget", F.col("target_country").alias("country")).distinct()
    rows = left_star(spine, [
        (stats, BY_COUNTRY), (reach, BY_COUNTRY), (exposed, BY_COUNTRY),
        (delivery.video_counts(events), BY_COUNTRY),
        (conversions.installs_by_country(first), ["country"]),
        (conversions.visits_by_country(visits, p), ["country"])])
    rows = rows.withColumns({
        "impressions_delivered": F.coalesce("impressions", F.lit(0)),
        "clicks": F.coalesce("clicks", F.lit(0)), "reach": F.coalesce("reach", F.lit(0)),
        **{n: F.coalesce(n, F.lit(0)) for n in delivery.VIDEO_STEPS}})
    rows = rows.withColumn("budget_delivered", finance.spend(
        "impressions_delivered", "full", booked="placement_impressions_booked"))
    rows = rows.withColumns({
        "ctr": finance.ctr("clicks", "impressions_delivered", percent=False),
        "cpc": finance.cost_per("budget_delivered", "clicks", default=0),
        "frequency": F.when(F.col("impressions_delivered") == 0, F.lit(0.0)).otherwise(
            safe_ratio("impressions_delivered", "reach")),
        "total_signup_page_visit": F.col("total_signup_page_visits"),
        **{n: without_commas(n, "") for n in ("advertiser", "insertion_order_name", "campaign_name",
                                              "flight_name", "line_item_name", "creative_name")}})
    return rows.select(*REPORT_COLUMNS, "country")


def _conversion_kinds(usage: DataFrame | None, first: DataFrame, visits: DataFrame, first_visits: DataFrame) -> DataFrame:
    """All conversions in one shape. Visits of the same device, segment and time are one."""
    none = F.lit(None).cast("long")
    visit = ["device_id", "country", "segment_id", "visit_time"]

    def shape(df: DataFrame, kind: str, ts: str, segment: Column, minutes: Column) -> DataFrame:
        return df.select("device_id", "country", F.col(ts).alias("conversion_time"),
                         F.lit(kind).alias("kind"), segment.alias("segment_id"), minutes.alias("minutes"))

    kinds = [shape(first, "install", "first_open", none, none),
             shape(visits.select(*visit).distinct(), "visit", "visit_time", F.col("segment_id"), none),
             shape(first_visits, "first_visit", "visit_time", F.col("segment_id"), none)]
    if usage is not None:
        kinds.append(shape(usage, "open", "usage_time", none, F.col("minutes")))
    return reduce(DataFrame.unionByName, kinds)


def _credited_counts(credited: DataFrame, p: ReportParams) -> DataFrame:
    """All credited counts per creative and country.

    First per device, which makes the distinct counts plain counts, then per creative.
    """
    kind, segment = F.col("kind"), F.col("segment_id")

    def visits(name: str, of: int | None) -> Column:
        return F.sum(F.when((kind == name) & (segment == F.lit(of).cast("long")), 1))

    columns = {
        "_opens": F.count(F.when(kind == "open", 1)),
        "_minutes": F.sum(F.when(kind == "open", F.col("minutes"))),
        "_timed": F.count(F.when(kind == "open", F.col("minutes"))),
        "_installs": F.count(F.when(kind == "install", 1)),
        "total_exposed_signup_page_visits": visits("visit", p.signup_segment),
        "total_exposed_homepage_page_visits": visits("visit", p.homepage_segment),
        "total_first_time_exposed_signup_page_visits": visits("first_visit", p.signup_segment),
        "total_first_time_exposed_homepage_page_visits": visits("first_visit", p.homepage_segment),
    }
    per_device = credited.groupBy(*BY_COUNTRY, "device_id").agg(*[c.alias(n) for n, c in columns.items()])
    counted = per_device.groupBy(*BY_COUNTRY).agg(
        F.sum("_opens").alias("_opens"), F.sum("_minutes").alias("_minutes"), F.sum("_timed").alias("_timed"),
        F.count(F.when(F.col("_opens") > 0, 1)).alias("_openers"),
        F.count(F.when(F.col("_installs") > 0, 1)).alias("_installers"),
        *[F.sum(n).alias(n) for n in columns if not n.startswith("_")])

    def seen(c: str) -> Column:
        return F.when(F.col(c) > 0, F.col(c))

    return counted.select(
        *BY_COUNTRY, safe_ratio("_minutes", "_timed").alias("average_exposed_time_spent_minutes"),
        seen("_openers").alias("total_exposed_app_openers"), seen("_opens").alias("total_exposed_app_opens"),
        seen("_installers").alias("first_time_exposed_app_opens"),
        *[n for n in columns if not n.startswith("_")])


def ranked_report(report: DataFrame) -> DataFrame:
    """The report with its global row number; equal rows share one."""
    return row_rank(report, RANK_COLUMNS)


def partner_weekly_reports(t: Tables, regions: dict[str, Sequence[str]], p: ReportParams,
                           home: Sequence[str] | None = None) -> DataFrame:
    """Every country of every region, with the region each row is delivered to.

    Regions in ``home`` are read from the log, all others from the regional copies; one job for each
    of the two sources, whatever the number of countries. Without ``home`` all come from the log.
    """
    def of(chosen: dict[str, Sequence[str]], source: str) -> DataFrame:
        countries = tuple(dict.fromkeys(c for group in chosen.values() for c in group))
        report = partner_weekly_report(t, p.but(countries=countries), source)
        names = F.array(*[F.when(F.col("country").isin(*group), F.lit(region)) for region, group in chosen.items()])
        return report.withColumn("region", F.explode(F.array_compact(names)))

    near = {r: group for r, group in regions.items() if home is None or r in home}
    far = {r: group for r, group in regions.items() if r not in near}
    parts = [of(chosen, source) for chosen, source in ((near, "log"), (far, "regional")) if chosen]
    return reduce(DataFrame.unionByName, parts)


def weekly_delivery(t: Tables, regions: dict[str, Sequence[str]], p: ReportParams, prefix: str, home_folder: str,
                    abroad_folder: str, home: Sequence[str] | None = None, max_rows: int = MAX_ROWS,
                    interval: str = "weekly") -> list[str]:
    """The files of all countries: ranked and paged inside the country, named and routed by it.

    A configured country without data gets one row with the run date. Gives the paths written.
    """
    countries = list(dict.fromkeys(c for group in regions.values() for c in group))
    report = partner_weekly_reports(t, regions, p, home).select(*REPORT_COLUMNS, "country").distinct()

    def path(country: Column, page: Column) -> Column:
        return F.concat(route(country, home_folder, abroad_folder), F.lit("/"),
                        report_path(prefix, country, p, page, interval))

    order = [c for c in RANK_COLUMNS if c != "country"]
    return export_by_country(report, countries, "report_execution_date", date_literal(p.run_date or p.end), order,
                             path, max_rows)


def creative_report(t: Tables, p: ReportParams) -> DataFrame:
    """Impressions, clicks, any-touch opens, last-touch first opens and cost per creative."""
    cmap = _fresh_map(t, p)
    rows, universe = read_once(t, cmap, p)
    shown = stage(delivery.exposed(rows, cmap, universe))
    usage = stage(conversions.app_usage(t.sessions, t.id_map, t.apps, p))
    first = conversions.first_app_open(usage, p, universe, open_ended=True)
    lines = cmap.select("line_item_start").distinct()
    used = conversions.usage_since_first_line(usage, lines)
    new = conversions.usage_since_first_line(first, lines, "first_open")

    by = ["campaign_id", "creative_id"]
    stats = delivery.delivery_stats(shown, by)
    opened = attribution.any_touch(shown, used, by, "usage_time", p.attribution_days, KEYS)
    opened = opened.select(*by, F.col("conversions").alias("count_exposed_app_opens"),
                           F.col("minutes").alias("total_time_spent_min"))
    firsts = attribution.attribute(shown, new, p, "first_open", "last", by, KEYS, per=[*KEYS, "first_open"]).select(
        *by, F.col("conversions").alias("count_exposed_first_app_opens"))

    rows = left_star(cmap, [(stats, by), (opened, by), (firsts, by)])
    rows = attach_scalar(rows, conversions.downloads_total(first))
    rows = rows.withColumns({"impression": F.coalesce("impressions", F.lit(0)),
                             "click": F.coalesce("clicks", F.lit(0))})
    rows = rows.withColumn("spend", finance.spend("impression"))
    return rows.select(
        F.lit(p.app_name).alias("campaign_name"), "campaign_id", "placement_id", "creative_id", "creative_name",
        "placement_name", "line_item_start", "line_item_end", "impression", "click", "count_exposed_app_opens",
        "count_exposed_first_app_opens", "total_time_spent_min",
        F.round(F.col("total_time_spent_min") / 60, 2).alias("total_time_spent_hour"), "downloads",
        finance.ctr("click", "impression").alias("ctr"),
        finance.cost_per("spend", "count_exposed_app_opens").alias("cpi"),
        finance.cost_per("spend", "count_exposed_first_app_opens").alias("cac"), "spend")


def regional_creative_report(t: Tables, p: ReportParams, opens_only: bool = False) -> DataFrame:
    """Per country and creative, without daily grain and without window; devices are counted.

    First opens come from the whole lookback, credited usage and downloads from the report days.
    ``opens_only`` is for markets that log openings without duration.
    """
    cmap = _fresh_map(t, p).withColumn("country", F.col("target_country"))
    by = ["country", "campaign_id", "creative_id"]
    shown = stage(delivery.exposures(t.delivery, cmap, p, keys=by))
    if opens_only:
        usage = conversions.app_opens(t.app_opens, t.id_map, t.apps, p)
    else:
        usage = conversions.app_usage(t.sessions, t.id_map, t.apps, p, "day")
    usage = stage(usage.where((F.col("usage_time") <= F.lit(str(p.end)).cast("date"))))
    report_days = usage.where(F.col("usage_time") >= F.lit(str(p.start)).cast("date"))
    lines = cmap.select(day_of("line_item_start").alias("line_item_start")).distinct()
    first = conversions.first_event(usage, ["device_id", "country"], "usage_time", "first_open")
    first_in_lines = conversions.usage_since_first_line(first, lines, "first_open")

    stats = delivery.delivery_stats(shown, by, clicks_on_impression_days=True)
    opened = attribution.any_touch_device_day(shown, conversions.usage_since_first_line(report_days, lines), by)
    opened = opened.select(*by, F.col("devices").alias("count_exposed_app_open"),
                           F.col("minutes").alias("time_spent_min"))
    firsts = attribution.last_touch_daily(shown, first_in_lines).groupBy(*by).agg(
        F.countDistinct("device_id").alias("count_exposed_first_app_open"))
    downloads = first.where(F.col("first_open").between(
        F.lit(str(p.start)).cast("date"), F.lit(str(p.end)).cast("date"))).groupBy("country").agg(
        F.countDistinct("device_id").alias("daily_downloads"))
    named = cmap.select(*by, "placement_id", "creative_name", "placement_name", "line_item_start", "line_item_end")
    rows = left_star(stats.join(named.distinct(), by), [(opened, by), (firsts, by), (downloads, ["country"])])
    return rows.select(
        "country", F.lit(p.app_name).alias("campaign_name"), "campaign_id", "placement_id", "creative_id",
        "creative_name", "placement_name", "line_item_start", "line_item_end",
        F.col("impressions").alias("impression"), F.col("clicks").alias("click"), "count_exposed_app_open",
        "count_exposed_first_app_open", "time_spent_min",
        (F.col("time_spent_min") / 60).alias("time_spent_hr"), "daily_downloads")


def download_table(first: DataFrame, first_visits: DataFrame, p: ReportParams,
                   only_download_days: bool = True) -> DataFrame:
    """Downloads, sign-up visits and home page visits per day, exposed and unexposed.

    Days without downloads are left out, as in a left join from downloads, unless asked for.
    """
    # One pass per log, brought to one shape and grouped once.
    days = conversions.downloads_daily(first).select(
        "day", F.col("downloads").alias("app_downloads"), F.lit(None).cast("long").alias("segment_id"),
        F.lit(None).cast("long").alias("visits"))
    days = days.unionByName(conversions.visits_daily(first_visits), allowMissingColumns=True)

    def visits(segment: int | None) -> Column:
        wanted = F.col("segment_id") == F.lit(segment).cast("long")
        return F.coalesce(F.sum(F.when(wanted, F.col("visits"))), F.lit(0))

    table = days.groupBy("day").agg(
        F.coalesce(F.sum("app_downloads"), F.lit(0)).alias("app_downloads"),
        visits(p.signup_segment).alias("daily_visits_signup"),
        visits(p.homepage_segment).alias("daily_visits_homepage"))
    table = table.where(p.in_attribution(F.col("day").cast("timestamp_ntz")))
    return table.where(F.col("app_downloads") > 0) if only_download_days else table


def campaign_table(t: Tables, p: ReportParams,
                   match_on: Sequence[str] = ("creative_name", "placement_name")) -> DataFrame:
    """Delivery and exposed conversions per delivery day and creative.

    Opens are any touch, the others last touch; all are dated by the conversion and joined to the
    delivery day on ``match_on``, names by default.
    """
    cmap = _fresh_map(t, p)
    rows, universe = read_once(t, cmap, p, delivery.ADDRESS | delivery.VISIT)
    dims = ["campaign_id", "creative_id", "creative_name", "placement_id", "placement_name"]
    attach = [d for d in dims if d not in ("campaign_id", "creative_id")]
    money = ["line_item_start", "line_item_end", "rate_type", "rate", "booked_impressions", "booked_budget"]
    shown = stage(delivery.exposed(rows, cmap, universe, attach))
    usage = stage(conversions.app_usage(t.sessions, t.id_map, t.apps, p))
    ip_map = identity.last_behind(delivery.with_role(rows, delivery.ADDRESS), t.id_map)
    visits = stage(conversions.visits_behind(delivery.with_role(rows, delivery.VISIT), ip_map, universe))
    first_visits = conversions.first_visit(visits, p)
    first = conversions.first_app_open(usage, p, universe)
    used = conversions.usage_since_first_line(usage, cmap.select("line_item_start").distinct())

    match = list(match_on)
    opened = attribution.any_touch(shown, used, match, "usage_time", p.attribution_days, KEYS,
                                   date_of="conversion")
    opened = opened.select(F.col("conversion_day").alias("exposure_day"), *match,
                           F.col("conversions").alias("exposed_app_open_count"),
                           F.col("minutes").alias("total_time_spent_min"))
    carry = (*attribution.IDS, *attach)
    # One last-touch pass for first opens, visits and first visits. Of a device's first opens only the
    # one with the latest exposure counts; every visit is its own group.
    kind = F.col("kind")
    kinds = _conversion_kinds(None, first, visits, first_visits)
    credited = attribution.last_touch(shown, kinds, "conversion_time", p.attribution_days, KEYS, carry)
    each = F.when(kind != "install", F.struct("segment_id", "conversion_time")).alias("_each")
    credited = latest_per_key(credited.select("*", each), ["kind", *KEYS, "_each"],
                              [F.col("exposure_time").desc(), F.col("conversion_time").asc()])
    tests = {"exposed_first_app_open_count": kind == "install"}
    for of, stem in (("visit", "exposed_page_visits_count"), ("first_visit", "exposed_first_page_visits_count")):
        tests |= {n: (kind == of) & test for n, test in conversions.by_segment(p, f"{stem}_signup", f"{stem}_homepage").items()}
    credits = cond_sum(credited.withColumn("exposure_day", day_of("conversion_time")), ["exposure_day", *match], tests)

    stats = delivery.delivery_stats(shown, dims, daily=True)
    rows = stats.join(cmap.select(*dims, *money).distinct(), dims)
    key = ["exposure_day", *match]
    rows = left_star(rows, [(opened, key), (credits, key)])
    counted = ["exposed_app_open_count", "exposed_first_app_open_count", "exposed_page_visits_count_signup",
               "exposed_first_page_visits_count_signup", "exposed_page_visits_count_homepage",
               "exposed_first_page_visits_count_homepage"]
    minutes = F.coalesce(safe_ratio("total_time_spent_min", "exposed_app_open_count"), F.lit(0.0))
    rows = rows.withColumn("avg_min_spent_among_exposed", minutes)
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in counted})
    rows = rows.withColumns({"cpm": finance.effective_cpm(), "cost": finance.spend()})
    return rows.select(
        F.lit(p.app_name).alias("campaign_name"), "campaign_id", "placement_id", "creative_id", "creative_name",
        "placement_name", F.col("exposure_day").alias("date_of_delivery"), "line_item_start", "line_item_end",
        "impressions", "clicks", *counted[:2], "avg_min_spent_among_exposed", *counted[2:], "cpm", "cost",
        finance.cost_per("cost", "exposed_app_open_count").alias("cpi"))


TIME_THRESHOLDS = {"over_60": 60, "over_300": 300}
TIME_LABELS = {"1min time spent": "over_60", "5min time spent": "over_300"}


def time_table(t: Tables, p: ReportParams) -> DataFrame:
    """New users by placement that used the app for at least one and at least five minutes."""
    cmap = _fresh_map(t, p)
    rows, universe = read_once(t, cmap, p)
    shown = stage(delivery.exposed(rows, cmap, universe))
    sessions = stage(conversions.usage_with_thresholds(t.sessions, t.id_map, t.apps, p, TIME_THRESHOLDS))
    first = conversions.first_app_open(sessions.where("used"), p, universe)
    long_use = sessions.where(F.greatest(*[F.col(c) for c in TIME_THRESHOLDS], F.lit(0)) == 1)
    return attribution.threshold_converters(shown, long_use, first, cmap, p, TIME_LABELS)


def downloads_vs_exposures(shown: DataFrame, first: DataFrame, by: Sequence[str],
                           keys: Sequence[str] = ("device_id",)) -> DataFrame:
    """Per day: first opens credited to the nearest exposure, and exposures of later new users.

    Days are the day of the first open and the day of the exposure.
    """
    extra = tuple(b for b in by if b not in attribution.IDS)
    nearest = attribution.nearest_touch(shown, first, "first_open", keys, (*attribution.IDS, *extra))
    opened = nearest.groupBy(day_of("first_open").alias("day"), *by).agg(F.count("*").alias("downloads"))
    last = first.groupBy(*keys).agg(F.max("first_open").alias("_until"))
    led = shown.join(last, list(keys)).where(F.col("exposure_time") <= F.col("_until"))
    led = led.groupBy(day_of("exposure_time").alias("day"), *by).agg(F.count("*").alias("imps"))
    return left_star(opened, [(led, ["day", *by])]).withColumn("imps", F.coalesce("imps", F.lit(0)))


def profile_additive(counts: DataFrame, whole: str) -> DataFrame:
    """One row: the rows of the stage ``whole``, those of all other stages together, and whether they are equal."""
    of = F.coalesce(F.sum(F.when(F.col("stage") == whole, F.col("rows"))), F.lit(0))
    parts = F.coalesce(F.sum(F.when(F.col("stage") != whole, F.col("rows"))), F.lit(0))
    return counts.agg(of.alias("whole"), parts.alias("parts"), (of == parts).alias("additive"))


def profile_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows of each stage, in one job."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("stage"), "rows")
              for n, df in stages.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
