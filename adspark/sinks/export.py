"""Delivered CSV files: single, paged, named and routed by country."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F

from adspark.operators.windows import row_rank
from adspark.params import ReportParams
from adspark.sinks.tables import _fs
from adspark.sources.relations import one_row
from adspark.stage import stage

CSV_DIALECT = {
    "header": True, "quoteAll": True, "nullValue": "", "emptyValue": "", "escape": '"',
    "compression": "none", "maxRecordsPerFile": 0, "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}
MAX_ROWS = 999_999
#: Files that are renamed at one time on a file system whose answers come over a network.
MOVERS = 16


def export_csv(df: DataFrame, path: str, order_cols: Sequence[str] = ()) -> str:
    """One headered, uncompressed file at ``path``, replacing what is there.

    For lists that must arrive as a single file, of whatever size: all tasks write a range of the order, without headers, and
    the parts are put together behind one header. A file system that can append whole files (HDFS) does so without
    copying; elsewhere the bytes are streamed from part to file.
    """
    spark = df.sparkSession
    ordered = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols) if order_cols else df
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    ordered.write.options(**{**CSV_DIALECT, "header": False}).csv(parts)
    _join_parts(spark, parts, path, df.columns)
    return path


def _join_parts(spark, folder: str, path: str, columns: Sequence[str]) -> None:
    """The part files of a folder, in order, behind a header, as one file."""
    fs, src = _fs(spark, folder)
    parts = sorted((s.getPath() for s in fs.listStatus(src) if s.getPath().getName().startswith("part-") and s.getLen() > 0),
                   key=lambda x: x.getName())  # parts are numbered in the order of their ranges
    _, whole = _fs(spark, f"{folder}/whole")
    header = ",".join('"' + c.replace('"', '""') + '"' for c in columns) + "\n"
    out = fs.create(whole)
    out.write(bytearray(header.encode()))
    if fs.getScheme() == "hdfs" and parts:
        out.close()
        array = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
        for k, part in enumerate(parts):
            array[k] = part
        fs.concat(whole, array)
    else:
        for part in parts:
            data = fs.open(part)
            spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 20, False)
            data.close()
        out.close()
    _, dst = _fs(spark, path)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst):
        fs.delete(dst, False)
    fs.rename(whole, dst)
    fs.delete(src, True)


def _move_single(spark, folder: str, path: str) -> None:
    """Move the only part file of a folder; several would mean that rows are left behind."""
    fs, src = _fs(spark, folder)
    parts = [s.getPath() for s in fs.listStatus(src) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"{len(parts)} part files instead of one for {path}")
    part = parts[0]
    _, dst = _fs(spark, path)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst):
        fs.delete(dst, False)
    fs.rename(part, dst)
    fs.delete(src, True)


def _move_all(spark, base: str, moves: Sequence[tuple[str, str]]) -> None:
    """:func:`_move_single` for the folders (below ``base``) and paths of a whole delivery; then ``base`` is deleted.

    One call of the JVM after the other takes longer than writing when there are many files. On a local file system each file takes a
    few system calls, elsewhere the calls wait for the file system side by side.
    """
    fs, root = _fs(spark, base)
    plain = {x: re.sub(r"^file:(//)?(?=/)", "", x) for move in moves for x in move}
    if fs.getScheme() == "file" and all(x.startswith("/") for x in plain.values()):
        for folder in {os.path.dirname(plain[path]) for _, path in moves}:
            os.makedirs(folder, exist_ok=True)
        for folder, path in moves:
            _move_local(plain[folder], plain[path])
        shutil.rmtree(root.toUri().getPath())
        return
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda move: _move_single(spark, *move), moves))
    fs.delete(root, True)


def _move_local(folder: str, path: str) -> None:
    """:func:`_move_single` within a local file system, where Hadoop keeps a file's checksum beside it."""
    parts = [x for x in os.listdir(folder) if x.startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"{len(parts)} part files instead of one for {path}")
    sums = lambda at, name: f"{at}/.{name}.crc"
    old, new = sums(folder, parts[0]), sums(*os.path.split(path))
    if os.path.exists(new):
        os.remove(new)
    os.replace(f"{folder}/{parts[0]}", path)
    if os.path.exists(old):
        os.replace(old, new)


def page_of(rank: Column, max_rows: int) -> Column:
    return F.ceil(rank / F.lit(max_rows)).cast("long")


def report_path(prefix: str, country: Column | str, p: ReportParams, page: Column | int,
                interval: str = "weekly") -> Column:
    """``weekly/<prefix><country>_weekly_campaign_<start>_<end>_001.csv``"""
    country = F.lit(country) if isinstance(country, str) else country
    page = F.lit(page) if isinstance(page, int) else page
    seq = F.format_string("%03d", page.cast("long"))  # more than 999 pages get longer numbers
    return F.concat(F.lit(f"{interval}/{prefix}"), F.lower(country),
                    F.lit(f"_{interval}_campaign_{p.start}_{p.end}_"), seq, F.lit(".csv"))


def dated_path(template: str, run_date: Column) -> Column:
    """``<date>`` in a target path becomes yyyyMMdd."""
    return F.replace(F.lit(template), F.lit("<date>"), F.date_format(run_date, "yyyyMMdd"))


def route(country: Column, home: str, abroad: str) -> Column:
    """The home market has its own destination."""
    return F.when(F.lower(country) == "us", home).otherwise(abroad)


def with_placeholder(report: DataFrame, run_date: Column, column: str = "report_execution_date") -> DataFrame:
    """The report with its run date, or one row that holds only the run date if it is empty."""
    report = report.withColumn(column, run_date)
    blank = one_row(report.sparkSession, **{column: run_date}).where(~report.exists())
    return report.unionByName(blank, allowMissingColumns=True)


def export_by_country(report: DataFrame, countries: Sequence[str], date_column: str, run_date: Column,
                      order_cols: Sequence[str], path, max_rows: int = MAX_ROWS) -> list[str]:
    """Files of at most ``max_rows`` ranks for each country, at ``path(country, page)``.

    Ranks count inside the country. Of ``countries`` those without a row get one that holds only the
    run date; rows without a country go nowhere. All files are written in one job, one task each.
    """
    spark = report.sparkSession
    report = stage(report.where(F.col("country") != "").withColumn(date_column, run_date))
    # One order over all countries, and each country's first rank taken off: no task holds a country.
    ranked = row_rank(report, ["country", *order_cols], "_global")
    first = ranked.groupBy("country").agg(F.min("_global").alias("_first"))
    ranked = ranked.join(first, "country").withColumn("_rank", F.col("_global") - F.col("_first") + 1)
    configured = spark.createDataFrame([(c,) for c in countries], "country string")
    silent = configured.join(report.select("country").distinct(), "country", "left_anti").withColumns(
        {date_column: run_date, "_rank": F.lit(1).cast("long")})
    rows = ranked.drop("_global", "_first").unionByName(silent, allowMissingColumns=True)
    rows = rows.withColumn("_path", path(F.col("country"), page_of(F.col("_rank"), max_rows)))
    return export_named(rows, "_path", ["_rank"], ["country", "_rank"])


def export_named(rows: DataFrame, path: str, order_cols: Sequence[str], leave_out: Sequence[str] = ()) -> list[str]:
    """Each row goes to the file that its column ``path`` names. One job writes all files, each in one task."""
    spark = rows.sparkSession
    rows = stage(rows.withColumn("_file", F.md5(path)))
    files = rows.select("_file", path).distinct().orderBy(path).collect()  # one row per file
    if not files:
        return []
    base = f"{files[0][path].rsplit('/', 1)[0]}/.parts-{uuid.uuid4().hex}"
    # Many small files cost by their number, which adaptive execution, merging partitions by their bytes, would leave to a few tasks.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(spread, "_file") if len(files) > spread else rows.repartition("_file")
    (dealt.sortWithinPartitions("_file", *order_cols).drop(path, *leave_out)
     .write.partitionBy("_file").options(**CSV_DIALECT).csv(base))
    _move_all(spark, base, [(f"{base}/_file={f['_file']}", f[path]) for f in files])
    return [f[path] for f in files]


def export_paged(report: DataFrame, folder: str, order_cols: Sequence[str], file_name,
                 max_rows: int = MAX_ROWS) -> list[str]:
    """Write at most ``max_rows`` ranks per file and name the files ``file_name(page)``.

    Pages are written in parallel, one task each. An empty report gives one file with a header. The
    report is staged, because ranking reads it twice.
    """
    spark = report.sparkSession
    report = stage(report)
    ranked = row_rank(report, order_cols, "_rank").withColumn("_page", page_of(F.col("_rank"), max_rows))
    parts = f"{folder.rstrip('/')}/.parts-{uuid.uuid4().hex}"
    (ranked.repartition("_page").sortWithinPartitions("_page", "_rank").drop("_rank")
     .write.partitionBy("_page").options(**CSV_DIALECT).csv(parts))
    fs, base = _fs(spark, parts)
    pages = sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(base)
                   if s.getPath().getName().startswith("_page="))
    out = [f"{folder.rstrip('/')}/{file_name(page)}" for page in pages]
    if not pages:
        out.append(export_csv(report, f"{folder.rstrip('/')}/{file_name(1)}"))
    _move_all(spark, parts, [(f"{parts}/_page={page}", path) for page, path in zip(pages, out)])
    return out
