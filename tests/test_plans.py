"""Properties of results and of physical plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from adspark.operators import windows as W
from adspark.operators.relational import in_rel
from adspark.plans import attribution, conversions, delivery, identity, lift
from adspark.plans.reports import KEYS, REPORT_COLUMNS, campaign_table, creative_report, partner_weekly_report, time_table
from adspark.stage import stage
from adspark.workload import measurement as M, queries
from adspark.workload.tables import PARAMS as P, Source

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def source(spark):
    return Source(spark, FOLDER)


@pytest.fixture(scope="module")
def staged(spark, source):
    """Small shared inputs, collected once."""
    keep = {}
    for name in ("shown", "used", "universe", "first"):
        df = getattr(M, name)(source)
        keep[name] = spark.createDataFrame(df.collect(), df.schema)
    return keep


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(queries()["scan_window"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThanOrEqual(l_shipdate" in plan
    assert re.search(r"ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>", plan)


@pytest.mark.parametrize("report", [creative_report, campaign_table, time_table, partner_weekly_report])
def test_a_report_reads_the_log_once(spark, source, monkeypatch, tmp_path, report):
    """Scans of the log (and of the sessions) in all plans that a report runs: staged steps and the result."""
    from dataclasses import replace
    from adspark.operators import touch
    from adspark.plans import reports
    paths = {}
    for name in ("delivery", "sessions"):
        paths[name] = f"{tmp_path}/{name}"
        getattr(source.report_tables, name).write.parquet(paths[name])
    t = replace(source.report_tables, **{n: spark.read.parquet(path) for n, path in paths.items()})
    plans = []

    def spy(df, name=None):
        plans.append(plan_of(df))
        return stage(df, name)

    for module in (reports, touch):
        monkeypatch.setattr(module, "stage", spy)
    plans.append(plan_of(report(t, P)))
    for path in paths.values():
        assert sum(len(re.findall(rf"FileScan parquet [^\n]*{re.escape(path)}", x)) for x in plans) == 1


def test_campaign_metadata_finds_booked_lines_once(spark, monkeypatch):
    """Bounds of the log, campaigns that ran and lines are taken from one reading of the bookings; the lines' versions are the other one."""
    from adspark.plans import mapping
    plans = []

    def spy(df, name=None):
        plans.append(plan_of(df))
        return stage(df, name)

    monkeypatch.setattr(mapping, "stage", spy)
    plans.append(plan_of(queries()["campaign_meta_from_log"](spark, FOLDER)))
    assert sum(len(re.findall(r"FileScan parquet [^\n]*lineitem", x)) for x in plans) == 2


def test_all_cuts_of_the_lift_meet_the_users_once(spark, source):
    usage, size = M.matched(source), identity.universe_size(M.universe(source))
    rows = lift.subscriber_lift(source.log, source.mapping, usage, size, P, 20)
    plan = plan_of(rows)
    assert len(re.findall(r"(?:Join|JoinExec)[^\n]*LeftOuter", plan)) == 1 and "Union" not in plan
    every = {tuple(x) for x in rows.select(*sorted(rows.columns)).collect()}
    for cuts in ({"frequency": None}, {"creative": "creative_id"}, {"overall": None, "placement": "line_item_name"}):
        some = lift.subscriber_lift(source.log, source.mapping, usage, size, P, 20, cuts)
        assert {tuple(x) for x in some.select(*sorted(rows.columns)).collect()} == {x for x in every if x[sorted(rows.columns).index("cut")] in cuts}


def test_latest_per_key_limits_before_the_shuffle(spark, source):
    plan = plan_of(W.latest_per_key(source.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_global_order_is_not_one_task(spark, source, monkeypatch):
    plans = []
    from adspark.operators import windows
    from adspark.stage import written

    def spy(df):
        plans.append(plan_of(df))
        return written(df)

    monkeypatch.setattr(windows, "written", spy)
    ranked = W.row_rank(source.orders, ["o_custkey", "o_orderpriority"])
    ranked.collect()
    plan = plan_of(ranked)
    # The only single-partition step adds up the sizes of the ranges.
    assert plan.count("SinglePartition") <= 1
    assert "rangepartitioning" not in plan  # already done when the ranges were written
    assert sum(x.count("orders.parquet") for x in [*plans, plan]) == 1 and "SortMergeJoin" not in plan


def test_rank_of_values_that_fill_many_ranges(spark):
    import random
    r = random.Random(1)
    merge, before = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(merge, "false")
    try:
        for values in ([1] * 700, [1] * 300 + [2] * 400 + [None] * 200, [r.choice([None, 1, 2, 2, 2, 2, 3, 9]) for _ in range(900)], []):
            rows = [(v, r.choice("ab"), k) for k, v in enumerate(values)]
            got = W.row_rank(spark.createDataFrame(rows, "v long, s string, k long"), ["v", "s"]).collect()
            key = lambda x: (x[0] is None, x[0] or 0, x[1])
            line = sorted(map(key, rows))
            assert sorted((x.k, x.row_num) for x in got) == [(k, line.index(key(x)) + 1) for k, x in enumerate(rows)]
    finally:
        spark.conf.set(merge, before)


def test_hot_device_is_split_in_joins(spark):
    """A third of the rows on one device: adaptive execution splits its side of the universe join."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("device_id"), F.lit("x").alias("country"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    universe = rows.select("country", "device_id").distinct()
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        kept = in_rel(rows, universe, ["country", "device_id"])
        assert len(kept.collect()) == 300_000
        assert "skew=true" in plan_of(kept)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_last_touch_is_part_of_any_touch(staged):
    last = attribution.last_touch(staged["shown"], staged["used"], "usage_time", 7, KEYS)
    assert last.count() <= staged["used"].count()
    by = ["campaign_id", "creative_id"]
    credited = last.groupBy(*by).agg(F.count("*").alias("n"))
    every = attribution.any_touch(staged["shown"], staged["used"], by, "usage_time", 7, KEYS)
    joined = credited.join(every, by, "left")
    assert joined.where("conversions IS NULL OR n > conversions").count() == 0


def test_reach_is_at_most_impressions(staged):
    rows = delivery.reach_frequency(staged["shown"], ["campaign_id"])
    assert rows.where("reach > impressions OR frequency < 1").count() == 0


def test_exposed_and_unexposed_make_the_universe(staged):
    u = staged["universe"].select("device_id").distinct()
    exposed = u.join(staged["shown"], "device_id", "left_semi")
    row = lift.unexposed_rate(u, staged["shown"], staged["used"]).first()
    assert row["unexposed_devices"] + exposed.count() == u.count()


def test_media_parts_add_up(source):
    rows = {r["combo"]: r["impressions"] for r in lift.media_combos(source.media).collect()}
    assert rows["native"] + rows["ctv"] + rows["stvp"] == source.media.count()
    assert rows["ctv_or_stvp"] == rows["ctv"] + rows["stvp"]


def test_weekly_report_shape(source):
    report = partner_weekly_report(source.report_tables, P)
    assert len(REPORT_COLUMNS) == 43
    assert tuple(report.columns) == (*REPORT_COLUMNS, "country")


def test_single_market_run_equals_its_part_of_the_whole(source):
    one = partner_weekly_report(source.report_tables, P.but(countries=("EUROPE",)))
    whole = partner_weekly_report(source.report_tables, P).where("country = 'EUROPE'")
    assert one.exceptAll(whole).count() == 0 and whole.exceptAll(one).count() == 0


def test_universe_of_a_market(source):
    cmap = M.cmap(source)
    start = identity.qualified_start(source.log, cmap, P)
    t = source.report_tables
    one = identity.device_universe(t.hardware, t.delivery, t.app_opens, t.id_map, P.but(countries=("ASIA",)), start)
    whole = M.universe(source).where("country = 'ASIA'")
    assert one.exceptAll(whole).count() == 0 and whole.exceptAll(one).count() == 0


def test_downloads_per_day_add_up(staged):
    total = conversions.downloads_total(staged["first"]).first()["downloads"]
    days = conversions.downloads_daily(staged["first"]).agg(F.coalesce(F.sum("downloads"), F.lit(0))).first()[0]
    assert total == days


def test_partitions_are_pruned(spark, source, tmp_path):
    """Bounds on the partition column reach the scan as partition filters, also those found at run time."""
    from adspark.plans import mapping
    from adspark.sources import scan_events
    plan = plan_of(queries()["scan_partition_text"](spark, FOLDER))
    assert re.search(r"PartitionFilters: \[[^\]]*partition_hour", plan)

    log, sessions, opens, hardware = (
        _kept(spark, df, f"{tmp_path}/{n}") for n, df in
        (("log", source.log), ("sessions", source.sessions), ("opens", source.app_opens), ("hardware", source.hardware)))
    cmap = mapping.creative_map(source.mapping, P)
    start = identity.qualified_start(log, cmap, P)
    plans = [delivery.exposures(log, cmap, P), conversions.app_usage(sessions, source.id_map, source.apps, P),
             identity.device_universe(hardware, log, opens, source.id_map, P, start)]
    for df in plans:
        scans = [s for s in plan_of(df).split("\n") if "FileScan" in s and f"{tmp_path}" in s]
        assert scans and all(re.search(r"PartitionFilters: \[[^\]]*partition_time", s) for s in scans)


def _kept(spark, df, path):
    """A copy of ``df`` in folders by partition time."""
    df.repartition("partition_time").write.partitionBy("partition_time").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
