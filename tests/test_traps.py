"""Small fixtures for the rules that are easy to get wrong."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adspark.functions import columns as C, time as T
from adspark.operators.intervals import point_in_interval
from adspark.operators import relational as R, windows as W
from adspark.params import ReportParams, default_window, report_window
from adspark.plans import attribution, audience, conversions, delivery, finance, identity, imports, lift, mapping
from adspark.schemas import DELIVERY, conform
from adspark.sinks import report_path
from adspark.sources import numbers, one_row
from adspark.workload.tables import SELLERS

P = ReportParams(date(2024, 1, 8), date(2024, 1, 14), lookback_months=1, page_lookback_days=7,
                 run_date=date(2024, 1, 22), signup_segment=0, homepage_segment=1, **SELLERS)


def log(make, ddl: str, *rows):
    return conform(make(ddl, *rows), DELIVERY)


def values(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ---- dates

@pytest.mark.parametrize("unit, start, end, expected", [
    ("day", "2024-01-01 23:00:00", "2024-01-02 01:00:00", 1),
    ("hour", "2024-01-01 10:59:00", "2024-01-01 11:01:00", 1),
    ("minute", "2024-01-01 00:00:59", "2024-01-01 00:01:01", 1),
    ("second", "2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", 1),
    ("second", "2024-01-01 00:00:59", "2024-01-01 00:01:01", 2),
    ("day", "2024-03-01 00:00:00", "2024-02-28 23:59:59", -2),
])
def test_differences_count_boundaries(make, unit, start, end, expected):
    df = make("a timestamp_ntz, b timestamp_ntz", (start, end))
    assert df.select(T.diff_units(unit, "a", "b")).first()[0] == expected


def test_differences_do_not_depend_on_the_time_zone(spark, make):
    df = make("a timestamp_ntz, b timestamp_ntz", ("2024-03-10 01:30:00", "2024-03-10 03:30:00"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(T.diff_units("hour", "a", "b")).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_default_window(make):
    df = make("d date", ("2024-11-04",), ("2024-11-03",))
    start, end = default_window(F.col("d"))
    assert values(df.select("d", start.alias("s"), end.alias("e")), "d", "s", "e") == [
        (date(2024, 11, 3), date(2024, 10, 14), date(2024, 10, 20)),
        (date(2024, 11, 4), date(2024, 10, 21), date(2024, 10, 27))]
    for run in (date(2024, 11, 3), date(2024, 11, 4)):
        got = df.where(F.col("d") == T.date_literal(run)).select(start, end).first()
        p = ReportParams.weekly(run)
        assert (p.start, p.end) == tuple(got)


def test_window_edges(spark):
    p = ReportParams(date(2024, 3, 31), date(2024, 4, 6), lookback_months=1, page_lookback_days=30)
    row = report_window(spark, p).first()
    assert row["usage_lookback"] == datetime(2024, 2, 29)
    assert row["window_end"] == datetime(2024, 4, 6, 23, 59, 59)
    assert row["attribution_end"] == datetime(2024, 4, 13, 23, 59, 59)
    assert row["page_lookback"] == datetime(2024, 3, 1)


def test_small_relations(spark):
    assert [r["num"] for r in numbers(spark, 3).collect()] == [1, 2, 3]
    assert one_row(spark, a=F.lit(1), b=F.lit("x")).collect()[0].asDict() == {"a": 1, "b": "x"}


def test_empty_array_and_missing_parts(make):
    df = make("a array<string>, s string", ([], "a|b"))
    row = df.select(C.first_of("a").alias("x"), C.split_part("s", "|", 3).alias("y"), C.text_part("s", "|", 3).alias("z"),
                    C.try_number(F.lit("ORD-12x"), "ORD-").alias("n")).first()
    assert tuple(row) == (None, "", None, None)


# ---- filters and joins

def test_exclusion_list_with_null(make):
    people, control = make("source_id string", ("a",), ("b",), (None,)), make("source_id string", ("a",), (None,))
    assert values(audience.audience(people, control), "source_id") == [("b",)]


def test_unset_segment_gives_no_visits(make):
    events = log(make, "event string, device_id long, segment_id long, country string, event_time timestamp_ntz, partition_time timestamp_ntz",
                 ("segment", 1, 0, "x", "2024-01-09 00:00:00", "2024-01-09 00:00:00"),
                 ("segment", 1, 1, "x", "2024-01-09 00:00:00", "2024-01-09 00:00:00"))
    assert conversions.pixels(events, P.but(signup_segment=None, homepage_segment=None)).count() == 0
    some = P.but(signup_segment=None)
    assert values(conversions.visits_by_country(conversions.pixels(events, some), some), "total_signup_page_visits",
                  "total_homepage_page_visits") == [(None, 1)]


def test_pages_beyond_three_digits_keep_their_names(spark):
    page = spark.range(1).select(report_path("adv_", "US", P, 1000).alias("p")).first()["p"]
    assert page == "weekly/adv_us_weekly_campaign_2024-01-08_2024-01-14_1000.csv"


def test_dropped_is_null_tolerant(make):
    assert values(R.not_dropped(make("i long, dropped boolean", (1, True), (2, False), (3, None))), "i") == [(2,), (3,)]


def test_conditional_sum_without_match_is_null(make):
    df = make("k string, v long", ("a", 1), ("b", 2))
    assert values(R.cond_sum(df, ["k"], {"n": F.col("v") == 1}, zero=False), "k", "n") == [("a", 1), ("b", None)]
    assert values(R.cond_sum(df, ["k"], {"n": F.col("v") == 1}), "k", "n") == [("a", 1), ("b", 0)]


# ---- universe

MAP = "campaign_id long, creative_id long, target_country string"
SEEN = ("event string, device_id long, campaign_id long, creative_id long, country string, seller_id string, "
        "exchange_id long, dropped boolean, event_time timestamp_ntz, partition_time timestamp_ntz")


def seen(event, device, seller, at, exchange=1, dropped=None, creative=7):
    return (event, device, 1, creative, "x", seller, exchange, dropped, at, at)


def test_start_moves_without_known_seller(make):
    cmap = make(MAP, (1, 7, "x"))
    at = "2024-01-09 10:00:00"
    known = log(make, SEEN, seen("impression", 1, "86", at), seen("impression", 1, "zz", at))
    unknown = log(make, SEEN, seen("impression", 1, "zz", at), seen("impression", 1, None, at))
    nothing = unknown.where("false")
    for events, start in ((known, datetime(2024, 1, 8)), (unknown, datetime(2023, 12, 9)), (nothing, datetime(2023, 12, 9))):
        assert identity.qualified_start(events, cmap, P).first()["universe_start"] == start


def test_universe_has_no_null_and_only_own_delivery(make):
    at = "2024-01-09 10:00:00"
    events = log(make, SEEN, seen("impression", 1, "zz", at, exchange=6), seen("impression", 2, "86", at),
                 seen("impression", 3, "zz", at), seen("impression", None, "86", at), seen("impression", 4, "86", at, dropped=True))
    hardware = make("source_id string, country string, partition_time timestamp_ntz", ("s9", "x", at), ("s8", "x", "2024-02-01 00:00:00"))
    opens = make("source_id string, country string, partition_time timestamp_ntz", ("s9", "x", at), ("unmapped", "x", at))
    ids = make("source_id string, device_id long", ("s9", 9), ("s8", 8))
    got = identity.device_universe(hardware, events, opens, ids, P)
    assert values(got, "device_id") == [(1,), (2,), (9,)]


def test_latest_device_behind_an_address(make):
    ddl = "event string, device_id long, ip string, country string, event_time timestamp_ntz, partition_time timestamp_ntz"
    events = log(make, ddl, *[("impression", d, ip, "x", at, at) for d, ip, at in (
        (1, "i", "2024-01-09 10:00:00"), (2, "i", "2024-01-10 10:00:00"), (3, "i", "2024-01-10 10:00:00"), (5, None, "2024-01-10 10:00:00"))])
    ids = make("source_id string, device_id long", ("a", 1), ("b", 2), ("c", 3), ("e", 5))
    assert values(identity.ip_device_map(events, ids, P), "ip", "source_id", "device_id") == [("i", "b", 2)]


# ---- conversions

def sessions(make, *rows):
    return make("source_id string, app_id string, country string, start_time timestamp_ntz, end_time timestamp_ntz, partition_time timestamp_ntz",
                *[("s", "app", "x", a, b, a) for a, b in rows])


def test_session_of_exactly_the_threshold(make):
    ids, apps = make("source_id string, device_id long", ("s", 1)), make("product_name string, app_id string", ("p", "app"))
    rows = sessions(make, ("2024-01-09 10:00:00", "2024-01-09 10:01:00"), ("2024-01-09 11:00:59", "2024-01-09 11:01:01"))
    kept = conversions.app_usage(rows, ids, apps, P)
    assert values(kept, "minutes") == [(1,)]
    assert conversions.app_usage(rows, ids, apps, P, inclusive=False).count() == 0


def test_first_event_on_the_edges(make):
    usage = make("device_id long, source_id string, country string, usage_time timestamp_ntz",
                 (1, "a", "x", "2024-01-08 00:00:00"), (2, "b", "x", "2024-01-21 23:59:59"),
                 (3, "c", "x", "2024-01-02 00:00:00"), (3, "c", "x", "2024-01-10 00:00:00"), (4, "d", "x", "2024-01-22 00:00:00"))
    assert values(conversions.first_app_open(usage, P), "device_id") == [(1,), (2,)]


def test_clicks_on_days_without_impressions(make):
    shown = make("campaign_id long, exposure_time timestamp_ntz, event string", (1, "2024-01-08 10:00:00", "click"),
                 (1, "2024-01-09 10:00:00", "impression"))
    assert delivery.delivery_stats(shown, ["campaign_id"], daily=True).count() == 2
    assert delivery.delivery_stats(shown, ["campaign_id"], daily=True, clicks_on_impression_days=True).count() == 1


def test_duplicate_visits_get_one_credit(make):
    shown = make("device_id long, exposure_time timestamp_ntz, campaign_id long, flight_id long, creative_id long",
                 (1, "2024-01-08 10:00:00", 1, 1, 1))
    visits = make("device_id long, segment_id long, visit_time timestamp_ntz", *[(1, 0, "2024-01-09 10:00:00")] * 3)
    per = ["device_id", "segment_id", "visit_time"]
    assert attribution.last_touch(shown, visits, "visit_time", 7, per=per).count() == 1


# ---- money

def test_money_without_a_base_is_null(make):
    df = make("rate_type string, rate double, booked_budget double, booked_impressions long, impressions long, clicks long",
              ("Flat Rate", 1.0, 100.0, 0, 0, 0), ("CPM", 5.0, 100.0, 1000, 2000, 0), ("Flat Rate", 1.0, 100.0, 4000, 2000, 10), ("Other", 1.0, 1.0, 1, 1, 1))
    got = df.select(finance.effective_cpm().alias("cpm"), finance.spend().alias("s"), finance.spend(flat_rate="full").alias("f"),
                    finance.ctr().alias("ctr"), finance.ctr(percent=False).alias("frac"), finance.cost_per(finance.spend(), "clicks").alias("cpi"))
    assert [tuple(r) for r in got.collect()] == [
        (None, None, 100.0, None, 0.0, None), (5.0, 10.0, 10.0, 0.0, 0.0, None), (25.0, 50.0, 100.0, 0.5, 0.005, 5.0),
        (None, None, None, 100.0, 1.0, None)]


# ---- mapping

def test_stale_mapping(make):
    ddl = "last_update timestamp_ntz"
    mapping.assert_fresh(make(ddl, ("2024-01-16 23:00:00",)), date(2024, 1, 22))
    for stale in (make(ddl, ("2024-01-15 00:00:00",)), make(ddl, ("2024-01-15 00:00:00",)).where("false")):
        with pytest.raises(mapping.StaleMappingError):
            mapping.assert_fresh(stale, date(2024, 1, 22))
        with pytest.raises(mapping.StaleMappingError):
            mapping.assert_fresh(stale, None)  # no run date: as of today
    mapping.assert_fresh(make(ddl, (str(datetime.now()),)), None)


def test_every_report_stops_on_a_stale_mapping_also_without_a_run_date(spark):
    from adspark.plans import reports
    from adspark.workload.tables import PARAMS, Source
    t = Source(spark, "/root/testdata/sf0.001").report_tables
    for report in (reports.creative_report, reports.regional_creative_report, reports.campaign_table, reports.time_table, reports.partner_weekly_report):
        with pytest.raises(mapping.StaleMappingError):
            report(t, PARAMS.but(run_date=None))


def test_product_with_two_custom_fields_keeps_its_country(make):
    fields = make("product_id long, field_id long, field_value string, last_modified timestamp_ntz, partition_time timestamp_ntz",
                  (1, 72, "Korea", "2024-01-01", "2024-01-01"), (1, 28, "CTV", "2024-02-01", "2024-01-01"),
                  (2, 72, "United States", "2024-01-01", "2024-01-01"), (3, 72, None, "2024-01-01", "2024-01-01"))
    assert values(mapping.product_countries(fields), "product_id", "product_country") == [(1, "South Korea"), (2, "USA"), (3, "USA")]


def test_latest_version_breaks_ties(make):
    df = make("k long, v long, a date, b date", (1, 1, "2024-01-01", "2024-01-01"), (1, 2, "2024-01-01", "2024-01-02"))
    assert values(W.latest_per_key(df, ["k"], ["a", "b"]), "v") == [(2,)]


# ---- lift and audiences

MEDIA = "device_id long, media string, exposure_time timestamp_ntz, event string"


def test_media_groups(make):
    at = "2024-01-08 00:00:00"
    shown = make(MEDIA, *[(d, m, at, "impression") for d, m in (
        (1, "ctv"), (2, "ctv"), (2, "stvp"), (3, "ctv"), (3, "stvp"), (3, "native"), (4, "native"))])
    got = {r["combo"]: (r["impressions"], r["reach"]) for r in lift.media_combos(shown).collect()}
    assert got == {"native": (2, 2), "ctv": (3, 3), "stvp": (2, 2), "ctv_and_stvp": (4, 2), "ctv_or_stvp_and_native": (3, 1),
                   "ctv_or_stvp": (5, 3), "all_media": (3, 1)}
    literal = {r["combo"]: r["impressions"] for r in lift.media_combos(shown, literal=True).collect()}
    assert literal["ctv_or_stvp_and_native"] == 3 + 2  # every CTV row, and device 3's other two
    alone = {r["combo"]: r["reach"] for r in lift.media_combos(shown, exclusive=True).collect()}
    assert (alone["native"], alone["ctv"], "stvp" in alone) == (1, 1, False)


def test_combination_nobody_saw_has_a_row(make):
    at = "2024-01-08 00:00:00"
    shown = make(MEDIA, (1, "ctv", at, "impression"))
    pixels = make("device_id long, visit_time timestamp_ntz", (1, "2024-01-09 00:00:00"), (2, "2024-01-09 00:00:00"))
    universe = make("device_id long", (1,), (2,), (3,))
    rows = {r["media_ad_type"]: r for r in lift.product_lift(shown, pixels, universe, 7).collect()}
    assert set(rows) == set(lift.COMBO_NAMES)
    assert (rows["ctv"]["reach"], rows["ctv"]["exposed_conversion_rate"], rows["ctv"]["unexposed_conversion_rate"]) == (1, 1.0, 0.5)
    assert (rows["native"]["impressions"], rows["native"]["reach"], rows["native"]["exposed_conversion_rate"]) == (0, 0, 0.0)


def test_ntile_sizes_and_hold_out(spark):
    keys = spark.range(1234).withColumnRenamed("id", "k")
    sizes = [r["count"] for r in W.random_ntile(keys, "k", 100, seed=1).groupBy("tile").count().collect()]
    assert len(sizes) == 100 and set(sizes) == {12, 13}
    few = W.random_ntile(spark.range(7).withColumnRenamed("id", "k"), "k", 100)
    assert sorted(r["tile"] for r in few.collect()) == list(range(1, 8))
    held = audience.control_group(keys, "k", seed=1)
    assert 80 < held.count() < 170
    assert held.exceptAll(audience.control_group(keys, "k", seed=1)).count() == 0


def test_rank_shares_numbers_and_handles_null(spark, make):
    df = make("a string, b long", ("x", 1), ("x", 1), ("x", 2), (None, 1), ("y", 1))
    assert values(W.row_rank(df, ["a", "b"]), "a", "b", "row_num") == sorted(
        [("x", 1, 1), ("x", 1, 1), ("x", 2, 3), ("y", 1, 4), (None, 1, 5)], key=repr)


# ---- imports

def test_regional_import_rejects_unknown_regions(make):
    with pytest.raises(ValueError):
        ids, apps = make("source_id string, device_id long", ("s", 1)), make("product_name string, app_id string", ("p", "app"))
        imports.regional_usage(sessions(make, ("2024-01-09 10:00:00", "2024-01-09 10:01:00")), ids, apps, P, "moon", date(2024, 1, 22))


def test_usage_of_several_sources_is_one_device(make):
    rows = [(s, "app", "US", "2024-01-10 10:00:00", f"2024-01-10 10:0{m}:00", "2024-01-10 10:00:00")
            for s, m in (("s1", 2), ("s2", 3), ("s3", 4), ("s4", 5))]
    sessions = make("source_id string, app_id string, country string, start_time timestamp_ntz, end_time timestamp_ntz, "
                    "partition_time timestamp_ntz", *rows)
    ids = make("source_id string, device_id long", ("s1", 1), ("s2", 1))
    apps = make("product_name string, app_id string", ("App", "app"))
    got = imports.regional_usage(sessions, ids, apps, P, "eu", date(2024, 1, 22))
    assert values(got, "device_id", "minutes", "usage_count") == [(1, 5, 2), (None, 9, 2)]


def test_interval_join_keeps_points_in_none(make):
    points = make("k long, t timestamp_ntz", (1, "2024-01-01 05:00:00"), (1, "2024-01-09 00:00:00"), (2, "2024-01-01 00:00:00"))
    spans = make("k long, name string, lo timestamp_ntz, hi timestamp_ntz", (1, "a", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
                 (1, "b", "2024-01-01 04:00:00", "2024-01-03 00:00:00"))
    got = point_in_interval(points, spans, ["k"], "t", "lo", "hi", how="left")
    assert values(got, "k", "name") == sorted([(1, "a"), (1, "b"), (1, None), (2, None)], key=repr)
    assert point_in_interval(points, spans, ["k"], "t", "lo", "hi").count() == 2


def test_points_in_many_intervals_of_one_key(spark):
    """Against brute force, with keys of few and of many intervals; and the rows that the join makes for a hot key."""
    import random
    rnd, day = random.Random(4), datetime(2024, 1, 1)
    at = lambda most: day + timedelta(microseconds=rnd.randrange(most * 10**6))
    spans, points = [], []
    for k, (n, most) in enumerate([(2, 1000), (30, 50), (30, 10**7), (0, 10), (60, 3), (5, 10**6)]):
        spans += [(k, f"{k}-{i}", *(sorted((at(most), at(most))) if rnd.random() < .9 else (at(most), at(most)))) for i in range(n)]
        points += [(k, at(most) if rnd.random() < .8 else None) for _ in range(60)]
        points += [(k, rnd.choice(spans)[2 + rnd.randrange(2)]) for _ in range(20) if spans]
    points += [(None, day), (77, day)] + points[:10]
    spans += [(None, "n", day, day), (1, "open", None, day), (1, "back", day + timedelta(days=1), day)]
    p = spark.createDataFrame(points, "k long, t timestamp_ntz")
    i = spark.createDataFrame(spans, "k long, name string, lo timestamp_ntz, hi timestamp_ntz")
    inner = [(k, t, name) for k, t in points for j, name, lo, hi in spans if k is not None and k == j and t and lo and lo <= t <= hi]
    left = inner + [(k, t, None) for k, t in points if not any(k == j and k is not None and t and lo and lo <= t <= hi for j, _, lo, hi in spans)]
    for few in (0, 4, 1000):
        for how, want in (("inner", inner), ("left", left)):
            got = point_in_interval(p, i, ["k"], "t", "lo", "hi", how, few).select("k", "t", "name").collect()
            assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr), (few, how)


def test_a_hot_key_joins_in_proportion_to_its_points(spark):
    """100,000 points and 10,000 disjoint intervals of one key: a billion pairs if the key alone were joined."""
    n, m = 100_000, 10_000
    second = lambda s: F.timestamp_seconds(s).cast("timestamp_ntz")
    points = spark.range(n).select(F.lit(1).alias("k"), second(F.col("id") * 7 % 600_000).alias("t"))
    spans = spark.range(m).select(F.lit(1).alias("k"), F.col("id").alias("name"), second(F.col("id") * 60).alias("lo"), second(F.col("id") * 60 + 49).alias("hi"))
    found = point_in_interval(points, spans, ["k"], "t", "lo", "hi")
    inside = sum((i * 7 % 600_000) % 60 < 50 for i in range(n))
    assert len(found.collect()) == inside
    metrics, nodes = [], [found._jdf.queryExecution().executedPlan()]
    while nodes:  # rows that any step made
        node = nodes.pop()
        values = node.metrics()
        if values.contains("numOutputRows"):
            metrics.append(values.apply("numOutputRows").value())
        children = node.children()
        nodes += [children.apply(c) for c in range(children.size())]
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            nodes.append(node.plan())
    assert n <= max(metrics) <= 12 * n


# ---- regional copies

def test_lines_abroad_against_all_pairs(spark):
    """Lines of every length, also within a day; exposures without a country, flight or creative."""
    import random
    rnd = random.Random(3)
    day = datetime(2024, 1, 1)
    lines = []
    for i in range(40):
        start = day + timedelta(minutes=rnd.randrange(6 * 1440))
        lines.append((rnd.randrange(3), rnd.randrange(2), i, start, start + timedelta(minutes=rnd.choice([0, 5, 90, 700, 3000]))))
    shown = [(rnd.randrange(3), rnd.randrange(2), rnd.choice(["A", None]), rnd.choice([1, None]), rnd.choice([1, 2, None]),
              day + timedelta(minutes=rnd.randrange(7 * 1440))) for _ in range(150)] + [(0, 0, "A", 1, 1, None)]
    spans = spark.createDataFrame(lines, "order_number long, campaign_id long, line_item_id long, "
                                         "line_item_start timestamp_ntz, line_item_end timestamp_ntz")
    copy = spark.createDataFrame(shown, "order_number long, campaign_id long, country string, flight_id long, "
                                        "creative_id long, exposure_time timestamp_ntz")
    got = mapping.ran_for_lines(spans, copy)
    pairs = {(li[2], *s[2:5]) for li in lines for s in shown if s[:2] == li[:2] and s[5] and li[3] <= s[5] <= li[4]}
    assert pairs and values(got, "line_item_id", "country", "flight_id", "creative_id") == sorted(pairs, key=repr)


def test_one_regional_credit_per_device_and_time(make):
    """Usage at one time in two countries: the later exposure has it, and a stale mapping stops the report."""
    from adspark.plans.reports import Tables, partner_weekly_report
    from adspark.schemas import CREATIVE_MAPPING, REGIONAL_EXPOSURE, REGIONAL_USAGE
    shown = conform(make("device_id long, exposure_time timestamp_ntz, country string, campaign_id long, creative_id long, flight_id long, event string",
                         (1, "2024-01-09 10:00:00", "AT", 1, 1, 1, "impression"),
                         (1, "2024-01-09 11:00:00", "DE", 1, 1, 1, "impression")), REGIONAL_EXPOSURE)
    used = conform(make("device_id long, usage_time timestamp_ntz, country string, minutes long",
                        (1, "2024-01-09 12:00:00", "AT", 4), (1, "2024-01-09 12:00:00", "DE", 6),
                        (None, "2024-01-09 12:00:00", "DE", 6)), REGIONAL_USAGE)
    lines = [(c, 1, 1, 1, i, "2024-01-01 00:00:00", "2024-01-31 00:00:00", "2024-01-20 00:00:00") for i, c in enumerate(["AT", "DE"])]
    mapped = conform(make("target_country string, campaign_id long, flight_id long, creative_id long, line_item_id long, "
                          "line_item_start timestamp_ntz, line_item_end timestamp_ntz, last_update timestamp_ntz", *lines), CREATIVE_MAPPING)
    t = Tables(None, None, None, None, mapped, regional_exposures=shown, regional_usage=used)
    report = partner_weekly_report(t, P, "regional")
    assert values(report, "country", "impressions_delivered", "total_exposed_app_opens", "first_time_exposed_app_opens",
                  "average_exposed_time_spent_minutes", "installs", "video_start", "total_signup_page_visit") == [
        ("AT", 1, None, None, None, 1, 0, None), ("DE", 1, 1, 1, 6.0, 1, 0, None)]
    with pytest.raises(mapping.StaleMappingError):
        partner_weekly_report(t, P.but(run_date=date(2024, 1, 27)), "regional")


def test_counted_intervals_add_up_to_the_pairs(spark):
    """Against brute force, with ends inside one second; points in none count once."""
    import random
    from collections import Counter
    rnd, day = random.Random(7), datetime(2024, 1, 1)
    at = lambda most: day + timedelta(microseconds=rnd.randrange(most * 10**6))
    spans, points = [], []
    for k, (n, most) in enumerate([(2, 1000), (40, 50), (30, 10**7), (0, 10), (60, 3), (5, 10**6)]):
        spans += [(k, rnd.choice(["a", "b", None]), *sorted((at(most), at(most)))) for _ in range(n)]
        points += [(k, at(most) if rnd.random() < .8 else None) for _ in range(60)]
        points += [(k, rnd.choice(spans)[2 + rnd.randrange(2)]) for _ in range(20)]
    points += [(None, day), (77, day)] + points[:10]
    spans += spans[:40] + [(None, "n", day, day), (1, "open", None, day), (1, "back", day + timedelta(days=1), day)]
    p = spark.createDataFrame(points, "k long, t timestamp_ntz")
    i = spark.createDataFrame(spans, "k long, name string, lo timestamp_ntz, hi timestamp_ntz")
    held = [[(k, t, name) for j, name, lo, hi in spans if k is not None and k == j and t and lo and lo <= t <= hi] for k, t in points]
    inner, left = Counter(x for h in held for x in h), Counter(x for (k, t), h in zip(points, held) for x in h or [(k, t, None)])
    for few in (4, 1000):
        for how, want in (("inner", inner), ("left", left)):
            got = Counter()
            for r in point_in_interval(p, i, ["k"], "t", "lo", "hi", how, few, count="n").collect():
                got[r.k, r.t, r.name] += r.n
            assert got == want, (few, how)


def test_counting_many_overlapping_intervals_makes_no_pairs(spark):
    """20,000 points in all of 20,000 intervals: 400 million pairs; the plan makes two rows of a point, one for each name."""
    n, second = 20_000, lambda s: F.timestamp_seconds(s).cast("timestamp_ntz")
    points = spark.range(n).select(F.lit(1).alias("k"), second(F.col("id") + 50_000).alias("t"))
    spans = spark.range(n).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("name"),
                                  second(F.col("id")).alias("lo"), second(100_000 + F.col("id") * 3).alias("hi"))
    rows = point_in_interval(points, spans, ["k"], "t", "lo", "hi", "left", count="n")
    assert values(rows.groupBy("name").agg(F.count("*").alias("rows"), F.sum("n").alias("n")), "name", "rows", "n") == [
        ("even", n, n * n // 2), ("odd", n, n * n // 2)]


def test_rows_without_a_parent_are_spread(spark):
    """Of 8,000 rows in eight tasks two have a parent; a task that holds all others fails here."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    rows = spark.range(8000).select("id", F.expr("CASE id WHEN 5 THEN 7L WHEN 6 THEN 9999L END").alias("up"), (F.col("id") * 2).alias("x"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, 1), (None, 7, 2)], "id long, up long, x long"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = R.with_parent(rows, "up", "id", ["id", "x"])
        assert got.columns == ["up", "id", "x", "parent_id", "parent_x"]
        assert got.count() == 8002
        assert values(got.where("up IS NOT NULL OR parent_id IS NOT NULL"), "id", "up", "parent_id", "parent_x") == sorted(
            [(5, 7, 7, 14), (6, 9999, None, None), (None, 7, 7, 14)], key=repr)
        assert got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 3000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_creative_mapping_is_distinct_before_lines_meet_what_ran(make):
    """Repeated lines, countries, flights and names make no repeated rows, and the joined rows aren't shuffled to find that out."""
    line = lambda i, country: (1, "order", "2024-01-01", "2024-01-31", 10, 5, "adv", country, i, "line", 0, None, "CPM", 1.5, 20.0, 7,
                               "2024-01-02 00:00:00", "2024-01-20 00:00:00")
    book = make("sales_order_id long, sales_order_name string, order_start date, order_end date, order_number long, advertiser_id long, "
                "advertiser_name string, product_country string, line_item_id long, line_item_name string, is_added_value long, "
                "added_value_amount double, cost_type string, net_unit_cost double, net_cost double, production_quantity long, "
                "line_item_start timestamp_ntz, line_item_end timestamp_ntz",
                *[line(i, c) for i, c in ((1, "USA"), (1, "USA"), (2, "Canada"), (3, "France"), (3, "France"), (4, "Mars"))])
    campaigns = make("campaign_id long, campaign_name string, state string", (100, "c", "live"), (100, "c", "live"))
    oms = make("campaign_id long, order_external_id long, line_external_id long", *[(100, 1, i) for i in (1, 2, 3, 4)])
    shown = log(make, "event string, country string, campaign_id long, flight_id long, creative_id long, partition_time timestamp_ntz",
                *[("impression", "US", 100, f, c, "2024-01-05 00:00:00") for f, c in ((1, 11), (1, 11), (None, 12), (2, 13))])
    copy = make("order_number long, campaign_id long, country string, flight_id long, creative_id long, exposure_time timestamp_ntz",
                (10, 100, "FR", None, 11, "2024-01-05 00:00:00"), (10, 100, "FR", 1, 11, "2024-01-25 00:00:00"))
    creatives = make("creative_id long, creative_name string", (11, "k11"), (11, "k11"), (12, "k12"))
    flights = make("flight_id long, campaign_id long, flight_name string, flight_start timestamp_ntz, flight_end timestamp_ntz",
                   *[(1, 100, "f1", "2024-01-01 00:00:00", "2024-01-09 00:00:00")] * 2)
    countries = make("country_name string, country_code string, region string", *[("Canada", "CA", "NA"), ("USA", "U1", "NA"), ("USA", "U2", "NA"),
                                                                                   ("France", "FR", "EU"), ("France", "FR", "EU")])
    got = mapping.creative_mapping(book, campaigns, oms, shown, copy, creatives, flights, countries, date(2024, 2, 1))
    ran = [("US", 1, "f1", 11, "k11"), ("US", None, None, 12, "k12"), ("US", 2, None, 13, None)]
    want = [(i, c, *r) for i, c in ((1, "US"), (2, "CA")) for r in ran]
    want += [(3, "FR", "FR", None, None, 11, "k11"), (4, None, "FR", None, None, 11, "k11")]
    assert values(got, "line_item_id", "target_country", "country", "flight_id", "flight_name", "creative_id", "creative_name") == sorted(want, key=repr)
    assert got._jdf.queryExecution().optimizedPlan().nodeName() == "Union"  # no Aggregate over it


def test_order_book_lines_carry_each_term_once(make, monkeypatch):
    """Staged lines have no columns that the book doesn't need, and meet the orders with one value of each term."""
    staged, stage = [], mapping.stage
    monkeypatch.setattr(mapping, "stage", lambda df: staged.append(df.columns) or stage(df))
    at = "2024-01-01 00:00:00"
    orders = make("sales_order_id long, sales_order_name string, order_start date, order_end date, advertiser_id long, advertiser_name string, "
                  "sales_stage string, order_status string, last_modified timestamp_ntz, partition_time timestamp_ntz",
                  (1, "IO | name", "2024-01-01", "2024-02-01", 1, "a", "Open", "active", at, at),
                  (2, "empty", "2024-01-01", "2024-02-01", 1, "a", "Open", "active", at, at))
    fields = make("sales_order_id long, field_name string, field_value string, field_status string, last_modified timestamp_ntz, "
                  "partition_time timestamp_ntz", (1, "JIRA ID", "77", "active", at, at))
    lines = make("sales_order_id long, line_item_id long, line_item_name string, product_name string, product_id long, start_date date, "
                 "start_clock string, end_date date, end_clock string, cost_type string, quantity long, production_quantity long, "
                 "unit_type string, is_added_value long, added_value_amount double, net_cost double, net_unit_cost double, "
                 "line_item_status string, parent_line_item_id long, last_modified timestamp_ntz, partition_time timestamp_ntz",
                 (1, 5, "package", "p", 1, "2024-01-01", "00:00:00", "2024-01-31", "23:59:59", None, 1, 2, "u", 0, 0.5, 9.0, 1.0, "live", None, at, at),
                 (1, 6, "part", "p", 1, "2024-01-05", "00:00:00", "2024-01-06", "23:59:59", "CPM", 3, 4, "v", 1, 1.5, 8.0, 2.0, "live", 5, at, at))
    products = make("product_id long, creative_spec string, booking_types string, last_modified timestamp_ntz, partition_time timestamp_ntz",
                    (1, "spec", "Bookable", at, at))
    countries = make("product_id long, field_id int, field_value string, last_modified timestamp_ntz, partition_time timestamp_ntz",
                     (1, 72, "None", at, at))
    got = mapping.order_book(orders, fields, lines, products, countries, date(2024, 2, 1))
    assert values(got, "sales_order_id", "order_number", "line_item_id", "line_item_name", "cost_type", "net_cost", "product_country") == sorted([
        (1, 77, 5, "package", None, 9.0, "USA"), (1, 77, 5, "package", "CPM", 9.0, "USA"), (2, None, None, None, None, None, None)], key=repr)
    assert not {"start_clock", "end_clock", "last_modified", "partition_time", "product_id"} & set(staged[-1])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "parent_net_cost" not in plan[:plan.index("Union")]  # chosen below the join with the orders


def test_order_book_carries_lines_of_orders_that_are_not_shown_only_as_packages(make, monkeypatch):
    """Of a closed order only the line that a shown line names stays; the latest version decides which, and lines without a key are kept."""
    staged, stage = [], mapping.stage
    monkeypatch.setattr(mapping, "stage", lambda df: staged.append(stage(df)) or staged[-1])
    old, new = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    orders = make("sales_order_id long, sales_order_name string, order_start date, order_end date, advertiser_id long, advertiser_name string, "
                  "sales_stage string, order_status string, last_modified timestamp_ntz, partition_time timestamp_ntz",
                  *[(i, f"order {i}", "2024-01-01", "2024-02-01", 1, "a", s, t, old, old)
                    for i, s, t in ((1, "Open", "active"), (2, "Closed Lost", "active"), (3, "Open", "deleted"), (4, None, "active"))])
    fields = make("sales_order_id long, field_name string, field_value string, field_status string, last_modified timestamp_ntz, "
                  "partition_time timestamp_ntz", (1, "JIRA ID", "77", "active", old, old))
    line = lambda order, i, name, parent, at, cost=None, product=1, status="live": (
        order, i, name, "p", product, "2024-01-01", "00:00:00", "2024-01-31", "23:59:59", "CPM", 1, 2, "u", 0, 0.5, cost, 1.0, status, parent, at, at, "wide")
    lines = make("sales_order_id long, line_item_id long, line_item_name string, product_name string, product_id long, start_date date, "
                 "start_clock string, end_date date, end_clock string, cost_type string, quantity long, production_quantity long, "
                 "unit_type string, is_added_value long, added_value_amount double, net_cost double, net_unit_cost double, "
                 "line_item_status string, parent_line_item_id long, last_modified timestamp_ntz, partition_time timestamp_ntz, not_needed string",
                 line(2, 20, "old package", None, old, 7.0), line(2, 20, "package", None, new, 8.0), line(2, 21, "closed", None, new), line(3, 30, "dead", 31, new),
                 line(3, 31, "package of a dead order's line", None, new), line(4, 40, "no stage", 41, new), line(4, 41, "unseen", None, new), line(9, 90, "no order", 20, new),
                 line(1, 10, "in it", 20, new, 1.0), line(1, 11, "left it", 21, old, 2.0), line(1, 11, "left it", None, new, 3.0), line(1, 12, "of none", 99, new, 4.0),
                 line(1, None, "without a key", None, old, 5.0), line(1, 13, "deleted", None, new, status="deleted"), line(1, 14, "own cost", 15, new, 6.0),
                 line(1, 15, "free package", None, None), line(1, 15, "free package", None, old, None, 2))
    products = make("product_id long, creative_spec string, booking_types string, last_modified timestamp_ntz, partition_time timestamp_ntz",
                    (1, "spec", "Bookable", old, old), (2, "other", "Bookable", old, old))
    countries = make("product_id long, field_id int, field_value string, last_modified timestamp_ntz, partition_time timestamp_ntz",
                     (1, 72, "France", old, old))
    got = mapping.order_book(orders, fields, lines, products, countries, date(2024, 2, 1))
    assert values(got, "sales_order_id", "order_number", "line_item_id", "line_item_name", "net_cost", "creative_spec", "product_country") == sorted([
        (1, 77, 20, "package", 8.0, "spec", "France"), (1, 77, 11, "left it", 3.0, "spec", "France"), (1, 77, 99, "of none", 4.0, "spec", "France"),
        (1, 77, None, "without a key", 5.0, "spec", "France"), (1, 77, 15, "free package", 6.0, "other", "France"),
        (1, 77, 15, "free package", None, "other", None)], key=repr)
    assert "not_needed" not in staged[-1].columns
    # 21 was a package before; 30, 31, 40, 41 and 90 are of orders that aren't shown, or none.
    assert sorted(str(r[0]) for r in staged[-1].select("line_item_id").collect()) == ["10", "11", "12", "14", "15", "20", "21", "None"]


def test_a_staged_step_leaves_no_shuffle_files(spark):
    """The written rows stay, what was shuffled to find them goes at once; a setting of the session comes back."""
    from adspark.stage import CLEANUP_CONF, stage
    before = spark.conf.get(CLEANUP_CONF)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = lambda: {str(f) for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    old = names()
    rows = spark.range(20000).groupBy((F.col("id") % 7).alias("k")).count().orderBy("k")
    got = stage(rows)
    assert not names() - old
    assert [tuple(r) for r in got.orderBy("k").limit(2).collect()] == [(0, 2858), (1, 2857)]
    assert [r["k"] for r in rows.collect()] == [r["k"] for r in stage(rows).orderBy("k").collect()] == list(range(7))
    assert spark.conf.get(CLEANUP_CONF) == before
