"""State kept between nights: days and months, versions with readers, digests of days."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adspark.plans import imports
from adspark.sinks import append_changed, current, reading, refresh_table, vacuum
from adspark.sinks.daily import DailyState, days_between
from adspark.sinks.tables import _names, append_new

D0 = date(2024, 1, 20)


def rows_of(seed, days=60, n=400):
    r = random.Random(seed)
    return [(r.randrange(30), r.choice(["US", "CA", None]), datetime.combine(D0 + timedelta(days=r.randrange(days)), datetime.min.time())
             + timedelta(seconds=r.randrange(86400)), r.randrange(5)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, country string, at timestamp_ntz, n long")


def state(path):
    return DailyState(str(path), ("k", "country"), {"at": "min", "n": "sum"})


def merged(rows, lo, hi):
    out = {}
    for k, c, at, n in rows:
        if lo <= at.date() <= hi:
            first, total = out.get((k, c), (at, 0))
            out[k, c] = min(first, at), total + n
    return sorted(((k, c, *v) for (k, c), v in out.items()), key=str)


def test_days_in_any_order_and_number_merge_as_the_whole_does(spark, tmp_path):
    rows, s, r = rows_of(1), state(tmp_path / "s"), random.Random(2)
    df, every = frame(spark, rows), days_between(D0, D0 + timedelta(days=59))
    r.shuffle(every)
    for part in (every[:25], every[20:45], every[40:], every[:3]):
        s.take(df, F.to_date("at"), part)
    assert not s.missing(spark, min(every), max(every)) and s.missing(spark, D0 - timedelta(days=1), D0) == [D0 - timedelta(days=1)]
    ranges = [(D0, D0 + timedelta(days=59)), (date(2024, 1, 31), date(2024, 3, 2)), (date(2024, 2, 1), date(2024, 2, 29)), (date(2024, 2, 10), date(2024, 2, 10))]
    want = [merged(rows, *x) for x in ranges]
    got = lambda: [sorted(map(tuple, s.read(spark, *x).collect()), key=str) for x in ranges]
    assert got() == want
    assert s.fold(spark, date(2024, 4, 1)) == ["2024-02"] and s.fold(spark, date(2024, 4, 1)) == []
    assert got() == want
    assert any("months" in f for f in s.read(spark, *ranges[0]).inputFiles()) and len(s.read(spark, *ranges[2]).inputFiles()) < 29
    # A day of the folded month changes: the month isn't read any more until it is folded again.
    late = [*rows, (7, "US", datetime(2024, 2, 10, 0, 0, 1), 100)]
    s.take(frame(spark, late), F.to_date("at"), [date(2024, 2, 10)])
    want = [merged(late, *x) for x in ranges]
    assert got() == want
    assert s.fold(spark, date(2024, 4, 1)) == ["2024-02"] and got() == want
    assert s.vacuum(spark) > 0 and s.vacuum(spark) == 0 and got() == want


def test_reach_adds_up_over_days_and_numbers_stay(spark):
    from adspark.plans import reach
    r = random.Random(9)
    rows = [(r.choice([None, *range(50)]) if r.random() < .9 else 40_000 + k, r.choice(["US", "CA", None]), r.randrange(3), r.randrange(2), r.randrange(4),
             r.choice(["impression"] * 4 + ["click"]), datetime(2024, 1, 1) + timedelta(hours=r.randrange(24 * 20))) for k in range(900)]
    df = spark.createDataFrame(rows, "device_id long, country string, campaign_id long, flight_id long, creative_id long, event string, exposure_time timestamp_ntz")
    old = reach.device_numbers(df.where("device_id < 10"))
    numbers = reach.device_numbers(df, old)
    every = {x.device_id: x.number for x in numbers.collect()}
    assert sorted(every.values()) == list(range(len({x[0] for x in rows} - {None}))) and all(every[k] < 10 for k in every if k < 10)
    halves = [df.where(f"exposure_time {op} '2024-01-09'") for op in ("<", ">=")]
    days = reach.daily_bitmaps(halves[0], numbers).unionByName(reach.daily_bitmaps(halves[1], numbers))
    want = {}
    names = sorted({c for by in reach.CUBE.values() for c in by})
    for device, country, campaign, flight, creative, event, at in rows:
        if event == "impression":
            facts = {"country": country, "campaign_id": campaign, "flight_id": flight, "creative_id": creative, "week": at.date() - timedelta(days=at.weekday())}
            for cut, by in reach.CUBE.items():
                seen = want.setdefault((cut, *[facts[c] if c in by else None for c in names]), [0, set()])
                seen[0] += 1
                seen[1] |= {device} - {None}
    cube = reach.reach_cube(days)
    got = {tuple(x[c] for c in ("cut", *names)): (x.impressions, x.reach) for x in cube.collect()}
    assert got == {k: (n, len(devices)) for k, (n, devices) in want.items()}
    plan = cube._jdf.queryExecution().optimizedPlan().toString()
    assert "device_id" not in "".join(line for line in plan.splitlines() if "Expand" in line)


def test_days_without_rows_and_days_never_taken(spark, tmp_path):
    s = state(tmp_path / "s")
    s.take(frame(spark, []), F.to_date("at"), [D0])
    s.take(frame(spark, rows_of(3, days=1, n=3)), F.to_date("at"), [D0 + timedelta(days=1)])
    assert s.read(spark, D0, D0 + timedelta(days=1)).collect() == []
    with pytest.raises(LookupError):
        s.read(spark, D0, D0 + timedelta(days=2))
    s.take(frame(spark, rows_of(3, days=1, n=3)), F.to_date("at"), [])
    assert s.taken(spark) == {D0, D0 + timedelta(days=1)}


def test_a_crash_between_write_and_marker_leaves_the_old_day(spark, tmp_path, monkeypatch):
    s, rows = state(tmp_path / "s"), rows_of(4, days=1)
    s.take(frame(spark, rows), F.to_date("at"), [D0])
    monkeypatch.setattr(DailyState, "_mark", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        s.take(frame(spark, []), F.to_date("at"), [D0])
    assert sorted(map(tuple, s.read(spark, D0, D0).collect()), key=str) == merged(rows, D0, D0)


def test_five_nights_keep_two_versions_and_a_reader_finishes(spark, tmp_path):
    folder = f"{tmp_path}/t"
    refresh_table(spark.range(10), folder)
    with reading(spark, folder) as old:
        for night in range(1, 6):
            refresh_table(spark.range(10 + night), folder)
        assert old.count() == 10 and current(spark, folder).count() == 15
        assert sum(n.startswith("v-") for n in _names(spark, folder)) == 3  # two, and the one that is read
    vacuum(spark, folder)
    assert sum(n.startswith("v-") for n in _names(spark, folder)) == 2 and current(spark, folder).count() == 15
    spark.range(3).write.parquet(f"{folder}/v-crashed")  # a writer that never switched
    assert vacuum(spark, folder) == [] and vacuum(spark, folder, grace_hours=-1) == ["v-crashed"]
    with reading(spark, folder, hours=-1):  # a lease that ran out
        for night in range(2):
            refresh_table(spark.range(night), folder)
    assert sum(n.startswith("v-") for n in _names(spark, folder)) == 2 and _names(spark, f"{folder}/_leases") == []


def test_only_days_that_changed_are_appended(spark, tmp_path, monkeypatch):
    path, plain = f"{tmp_path}/t", f"{tmp_path}/plain"
    keys, rows = ["k", "country", "at", "n"], rows_of(5, days=10)
    joined = []
    from adspark.sinks import tables
    monkeypatch.setattr(tables, "append_new", lambda df, *a: joined.append(df.count()) or append_new(df, *a))
    same = lambda: sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == sorted(map(tuple, spark.read.parquet(plain).collect()), key=str)
    night = lambda batch: append_changed(frame(spark, batch), path, keys, F.to_date("at"))

    def both(batch):
        append_new(frame(spark, batch), plain, keys)
        return night(batch)

    assert len(both(rows)) == 10 and same()
    random.Random(1).shuffle(rows)
    assert both(rows) == [] and len(joined) == 1  # other order, same rows: nothing is compared
    late = [(99, None, datetime.combine(D0 + timedelta(days=4), datetime.min.time()), 1), (1, "US", datetime.combine(D0 + timedelta(days=30), datetime.min.time()), 1)]
    assert both(rows + late) == [D0 + timedelta(days=4), D0 + timedelta(days=30)] and same()
    assert joined[1] < len(rows) / 5
    assert both(rows + late) == [] and both(rows[:100]) != [] and same()  # rows that vanish add none
    assert both([]) == [] and same()


def test_an_import_run_twice_touches_no_day(spark, tmp_path):
    from adspark.plans import mapping
    from adspark.workload.tables import Source
    s = Source(spark, "/root/testdata/sf0.001")
    run, path = date(2024, 1, 22), f"{tmp_path}/exposures"
    campaigns = mapping.active_campaigns(s.book, s.campaigns, s.oms, run)
    assert len(imports.import_exposures_into(s.log, campaigns, path, run)) == 14
    files = sorted(spark.read.parquet(path).inputFiles())
    assert imports.import_exposures_into(s.log, campaigns, path, run) == []
    assert sorted(spark.read.parquet(path).inputFiles()) == files
