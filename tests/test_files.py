"""CSV, tables and delivered files."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from adspark.functions.time import date_literal
from adspark.schemas import schema
from adspark.sinks import append_new, current, export_csv, export_paged, refresh_table, with_placeholder
from adspark.sinks import export
from adspark.sinks.export import _move_single, export_by_country, export_named
from adspark.sources import BadRowsError, read_csv, read_csv_tolerant, report_manifest, split_to_rows

ROWS = schema(id="int", name="str")


@pytest.mark.parametrize("bad, fits", [(250, True), (251, False)])
def test_bad_row_budget(spark, tmp_path, bad, fits):
    path = tmp_path / "in.csv"
    path.write_text("id,name\n" + "".join(f'{i},"n, {i}"\n' for i in range(300)) + "broken,x\n" * bad)
    if fits:
        rows, rejected = read_csv_tolerant(spark, str(path), ROWS, max_errors=250)
        assert {r["rejected"] for r in rejected.collect()} == {"broken,x"} and rejected.count() == bad
        assert rows.count() == 300
        assert rows.agg(F.sum("id")).first()[0] == sum(range(300))
    else:
        with pytest.raises(BadRowsError):
            read_csv_tolerant(spark, str(path), ROWS, max_errors=250)


def test_pages(spark, tmp_path):
    df = spark.range(5).select(F.col("id"), F.concat(F.lit('a "quoted", name '), "id").alias("name"))
    files = export_paged(df, str(tmp_path / "out"), ["id"], lambda n: f"report_{n:03d}.csv", max_rows=2)
    assert [os.path.basename(f) for f in files] == ["report_001.csv", "report_002.csv", "report_003.csv"]
    back = read_csv(spark, str(tmp_path / "out" / "*.csv"), ROWS, escape='"')
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    counts = [len(read_csv(spark, f, ROWS, escape='"').collect()) for f in files]
    assert counts == [2, 2, 1]
    manifest = report_manifest(spark, str(tmp_path), "report_*.csv").first()
    assert (manifest["destination"], manifest["files"]) == ("out", 3)


def test_empty_report_is_one_file(spark, tmp_path):
    files = export_paged(spark.range(0).toDF("id"), str(tmp_path / "out"), ["id"], lambda n: f"r_{n:03d}.csv")
    assert [os.path.basename(f) for f in files] == ["r_001.csv"]


def test_placeholder(spark):
    report = spark.range(3).toDF("id")
    day = date_literal("2024-01-22")
    assert with_placeholder(report, day).count() == 3
    rows = with_placeholder(report.where("id > 9"), day).collect()
    assert [(r["id"], str(r["report_execution_date"])) for r in rows] == [(None, "2024-01-22")]


def test_one_file_from_many_tasks(spark, tmp_path):
    """Three ranges, one header; order and dialect as a single task would write them."""
    rows = [(k % 50, f'a "quoted", name\\n {k}' if k % 3 else None, "" if k % 2 else "x") for k in range(3000)]
    df = spark.createDataFrame(rows, 'id long, `na"me` string, e string').repartition(3)
    merge, before = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(merge, "false")
    try:
        path = export_csv(df, str(tmp_path / "many.csv"), ["id", 'na"me'])
        plain = df.repartition(1).sortWithinPartitions("id", 'na"me')
        from adspark.sinks.export import CSV_DIALECT
        plain.write.options(**CSV_DIALECT).csv(str(tmp_path / "plain"))
    finally:
        spark.conf.set(merge, before)
    one = next((tmp_path / "plain").glob("part-*.csv")).read_text().splitlines()
    many = open(path).read().splitlines()
    assert many[0] == one[0] and sorted(many) == sorted(one) and [x.split(",")[0] for x in many] == [x.split(",")[0] for x in one]
    assert os.listdir(tmp_path) and not [x for x in os.listdir(tmp_path) if ".parts-" in x]
    assert open(export_csv(df.where("false"), str(tmp_path / "none.csv"))).read() == '"id","na""me","e"\n'


def test_counts_are_taken_while_rows_are_written(spark, tmp_path):
    from adspark.stage import written_counted
    df = spark.range(0, 1000, numPartitions=7).withColumn("k", F.col("id") % 3)
    rows, counts = written_counted(df, "all", {"zero": F.col("k") == 0, "none": F.col("k") == 9})
    assert sorted(map(tuple, counts.collect())) == [("all", 1000), ("none", 0), ("zero", 334)] and rows.count() == 1000
    assert sorted(map(tuple, written_counted(df.where("false"), "all", {})[1].collect())) == [("all", 0)]


def test_single_file_replaces(spark, tmp_path):
    path = str(tmp_path / "list.csv")
    for n in (5, 2):
        export_csv(spark.range(n).toDF("id"), path, ["id"])
    with open(path) as f:
        assert f.read() == '"id"\n"0"\n"1"\n'


def test_session_that_splits_files_loses_nothing(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        export_csv(spark.range(10).toDF("id"), str(tmp_path / "list.csv"), ["id"])
        files = export_paged(spark.range(10).toDF("id"), str(tmp_path / "out"), ["id"], lambda n: f"p_{n}.csv", max_rows=7)
        spark.range(10).repartition(1).write.csv(str(tmp_path / "split"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    one = schema(id="int")
    assert read_csv(spark, str(tmp_path / "list.csv"), one).count() == 10
    assert [read_csv(spark, f, one).count() for f in files] == [7, 3]
    with pytest.raises(RuntimeError, match="part files"):
        _move_single(spark, str(tmp_path / "split"), str(tmp_path / "x.csv"))


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.range(4).selectExpr("id % 3 AS k", "id % 3 AS v")
    for _ in range(2):
        append_new(batch, path, ["k", "v"], date_literal("2024-01-22"))
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [0, 1, 2]


def test_append_of_null_keys_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(None, 1), (2, None), (2, None)], "k long, v long")
    for _ in range(3):
        append_new(batch, path, ["k", "v"], date_literal("2024-01-22"))
    assert spark.read.parquet(path).count() == 2


def test_refresh_reads_what_it_replaces(spark, tmp_path):
    folder = str(tmp_path / "t")
    refresh_table(spark.range(5).toDF("id"), folder)
    for _ in range(2):
        refresh_table(current(spark, folder).selectExpr("id + 1 AS id"), folder)
    assert sorted(r["id"] for r in current(spark, folder).collect()) == [2, 3, 4, 5, 6]


def test_split_parameter(spark):
    assert sorted(r["value"] for r in split_to_rows(spark, " US, CA ,,").collect()) == ["CA", "US"]


def test_files_by_country(spark, tmp_path):
    df = spark.range(7).select("id", F.when(F.col("id") < 5, "US").when(F.col("id") == 5, "SOUTH/X").alias("country"))
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 1)
    try:
        files = export_by_country(
            df, ["US", "SOUTH/X", "BR"], "run_date", date_literal("2024-01-22"), ["id"],
            lambda c, page: F.concat(F.lit(f"{tmp_path}/"), F.when(c == "US", "home").otherwise("abroad"),
                                     F.lit("/"), F.replace(c, F.lit("/"), F.lit("-")), F.lit("_"), page, F.lit(".csv")), 2)
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", before)
    names = ["abroad/BR_1.csv", "abroad/SOUTH-X_1.csv", "home/US_1.csv", "home/US_2.csv", "home/US_3.csv"]
    assert [os.path.relpath(f, tmp_path) for f in files] == names
    rows = {n: [tuple(r) for r in read_csv(spark, f, schema(id="int", run_date="date")).collect()]
            for n, f in zip(names, files)}
    day = date(2024, 1, 22)
    assert rows["abroad/BR_1.csv"] == [(None, day)]
    assert rows["abroad/SOUTH-X_1.csv"] == [(5, day)]
    assert [r for n in names[2:] for r in rows[n]] == [(i, day) for i in range(5)]


@pytest.mark.parametrize("local", [True, False])
def test_many_files_are_written_by_all_tasks_and_moved_together(spark, tmp_path, monkeypatch, local):
    """200 files: adaptive execution may not leave them to one task, nor are local ones moved with calls of the JVM."""
    move_all, move_single, fs_of, tasks, singles = export._move_all, export._move_single, export._fs, set(), []

    class Remote:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return (lambda: "remote") if name == "getScheme" else getattr(self.fs, name)

    def spy(spark, base, moves):
        tasks.update(x.split("-")[1] for folder, _ in moves for x in os.listdir(folder.removeprefix("file:")) if x.startswith("part-"))
        if not local:
            monkeypatch.setattr(export, "_fs", lambda *of: (Remote(fs_of(*of)[0]), fs_of(*of)[1]))
        move_all(spark, base, moves)

    monkeypatch.setattr(export, "_move_all", spy)
    monkeypatch.setattr(export, "_move_single", lambda *of: singles.append(of) or move_single(*of))
    old = tmp_path / "home" / "list 7.csv"
    spark.range(50).coalesce(1).write.csv(str(tmp_path / "before"))
    old.parent.mkdir()
    part = next((tmp_path / "before").glob("part-*.csv"))
    part.rename(old)
    (part.parent / f".{part.name}.crc").rename(old.parent / ".list 7.csv.crc")  # a checksum that no longer holds
    name = lambda k: f"{tmp_path}/{'home' if k % 2 else 'abroad'}/list {k}.csv"
    df = spark.range(1000).select("id", F.concat(F.lit(f"file:{tmp_path}/"), F.when(F.col("id") % 2 == 1, "home").otherwise("abroad"),
                                                 F.lit("/list "), F.col("id") % 200, F.lit(".csv")).alias("at"))
    files = export_named(df, "at", ["id"])
    assert sorted(files) == sorted("file:" + name(k) for k in range(200))
    for k in (0, 7, 199):
        assert open(name(k)).read() == '"id"\n' + "".join(f'"{i}"\n' for i in range(k, 1000, 200))
    assert read_csv(spark, f"{tmp_path}/{{home,abroad}}/*.csv", schema(id="int")).agg(F.sum("id")).first()[0] == 499500
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) and len(singles) == (0 if local else 200)
    assert {x for d in ("home", "abroad") for x in os.listdir(tmp_path / d) if "parts" in x} == set()


def test_a_delivery_with_rows_left_behind_stops(spark, tmp_path):
    """Two part files for one path stop a local delivery as they stop others."""
    spark.range(10).repartition(2).write.csv(str(tmp_path / "base" / "a"))
    with pytest.raises(RuntimeError, match="2 part files"):
        export._move_all(spark, str(tmp_path / "base"), [(str(tmp_path / "base" / "a"), str(tmp_path / "x.csv"))])
    assert not (tmp_path / "x.csv").exists()
