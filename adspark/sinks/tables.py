"""Full refresh and idempotent append of parquet tables kept under a folder."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adspark.operators.relational import not_held
from adspark.stage import stage

POINTER, LEASES, DROPPED = "_current", "_leases", "_dropped"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def refresh_table(df: DataFrame, folder: str, partition_by: Sequence[str] = (), keep: int = 2) -> str:
    """Write ``df`` as the new version of a table, switch to it and delete all but the last ``keep`` versions.

    The job may read the version it replaces: nothing is overwritten, the pointer is a marker
    whose name orders after the older ones. Readers see the old version or the new one, and one that
    :func:`reading` holds stays until it is done.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{folder}/{version}")
    number = max([int(n.split("-")[0]) for n in _names(spark, f"{folder}/{POINTER}")], default=0) + 1
    fs, marker = _fs(spark, f"{folder}/{POINTER}/{number:09d}-{version}")
    fs.create(marker).close()
    vacuum(spark, folder, keep)
    return f"{folder}/{version}"


def has_version(spark: SparkSession, folder: str) -> bool:
    return bool(_names(spark, f"{folder.rstrip('/')}/{POINTER}"))


def _last(spark: SparkSession, folder: str) -> str:
    return max(_names(spark, f"{folder}/{POINTER}"))


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The version of a refreshed table that is in force. It is safe for as long as ``keep`` versions take to be
    written; a longer reader uses :func:`reading`."""
    folder = folder.rstrip("/")
    return spark.read.parquet(f"{folder}/{_last(spark, folder).split('-', 1)[1]}")


@contextmanager
def reading(spark: SparkSession, folder: str, hours: float = 24) -> Iterator[DataFrame]:
    """The version in force, held until the block ends (or for ``hours``, if the reader dies).

    The lease is written first and the marker looked at again: a vacuum removes the marker before it looks
    for leases, so one of the two sees the other.
    """
    folder = folder.rstrip("/")
    while True:
        marker = _last(spark, folder)
        version = marker.split("-", 1)[1]
        until = int((time.time() + 3600 * hours) * 1000)
        fs, lease = _fs(spark, f"{folder}/{LEASES}/{version}~{until}~{uuid.uuid4().hex}")
        fs.create(lease).close()
        if marker in _names(spark, f"{folder}/{POINTER}"):
            break
        fs.delete(lease, False)
    try:
        yield spark.read.parquet(f"{folder}/{version}")
    finally:
        fs.delete(lease, False)


def vacuum(spark: SparkSession, folder: str, keep: int = 2, grace_hours: float = 24) -> list[str]:
    """Delete versions beyond the last ``keep`` that no reader holds, and what crashed writers left ``grace_hours`` ago."""
    folder = folder.rstrip("/")
    fs, base = _fs(spark, folder)
    at = lambda *names: _fs(spark, "/".join([folder, *names]))[1]
    markers = _names(spark, f"{folder}/{POINTER}")
    for marker in markers[:-keep] if keep > 0 else []:
        dropped = at(DROPPED, marker.split("-", 1)[1])
        fs.create(dropped).close()
        fs.delete(at(POINTER, marker), False)
    now = time.time() * 1000
    held = set()
    for lease in _names(spark, f"{folder}/{LEASES}"):
        version, until, _ = lease.split("~")
        if int(until) > now:
            held.add(version)
        else:
            fs.delete(at(LEASES, lease), False)
    named = {m.split("-", 1)[1] for m in _names(spark, f"{folder}/{POINTER}")}
    dropped = set(_names(spark, f"{folder}/{DROPPED}"))
    gone = []
    for s in fs.listStatus(base):
        version = s.getPath().getName()
        if not version.startswith("v-") or version in named or version in held:
            continue
        if version in dropped or s.getModificationTime() < now - 3_600_000 * grace_hours:
            fs.delete(s.getPath(), True)
            gone.append(version)
    for version in dropped - {s.getPath().getName() for s in fs.listStatus(base)}:
        fs.delete(at(DROPPED, version), False)
    return gone


def rows_to_append(df: DataFrame, target: DataFrame, keys: Sequence[str],
                   imported: Column | None = None) -> DataFrame:
    """Rows of ``df`` not yet in ``target`` (all business keys equal, NULL to NULL), one of each."""
    fresh = not_held(df.dropDuplicates(list(keys)), target, keys)
    return fresh if imported is None else fresh.withColumn("date_imported", imported)


def append_new(df: DataFrame, path: str, keys: Sequence[str], imported: Column | None = None,
               since: Column | None = None, partition_by: Sequence[str] = ()) -> None:
    """Append the rows a parquet table does not hold yet; running a batch twice adds it once.

    ``since`` is a predicate on the target that is known to cover the batch (the re-read period),
    so that the comparison reads only that part of the table.
    """
    spark = df.sparkSession
    fs, hpath = _fs(spark, path)
    if fs.exists(hpath):
        target = spark.read.parquet(path)
        target = target if since is None else target.where(since)
        new = rows_to_append(df, target, keys, imported)
    else:
        new = df.dropDuplicates(list(keys))
        new = new if imported is None else new.withColumn("date_imported", imported)
    new.write.mode("append").partitionBy(*partition_by).parquet(path)


def digests(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """For each group the number of rows and two sums of hashes of whole rows, whatever their order."""
    cols = sorted(df.columns)
    return df.groupBy(*groups).agg(
        F.count("*").alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("first_sum"),
        F.sum(F.xxhash64(F.lit(1), *cols).cast("decimal(38,0)")).alias("second_sum"))


def append_changed(df: DataFrame, path: str, keys: Sequence[str], day: Column, imported: Column | None = None,
                   by: Sequence[str] = ("country",), since: Column | None = None, partition_by: Sequence[str] = ()) -> list[date]:
    """:func:`append_new`, but only for the days and groups ``by`` whose rows aren't those of the last run.

    Beside the table, a small table keeps the digests of what was last taken. Days without a change are neither joined
    nor shuffled; without any change nothing is written. Returns the days that were touched. ``since`` as for
    :func:`append_new`. The digests are written last: after a crash the same days are compared again.
    """
    spark = df.sparkSession
    rows = df.withColumn("_day", day)
    found = digests(rows, ["_day", *by])
    noted = f"{path.rstrip('/')}.digests"
    now = stage(found)  # a row for each day and group of the re-read period
    if has_version(spark, noted):
        known = current(spark, noted)
        changed = not_held(now, known, now.columns)
    else:
        known, changed = None, now
    groups = changed.select("_day", *by).collect()
    if not groups:
        return []
    days = sorted({g["_day"] for g in groups if g["_day"] is not None})
    some = F.col("_day").isin(days) | (F.col("_day").isNull() if any(g["_day"] is None for g in groups) else F.lit(False))
    wanted = spark.createDataFrame([tuple(g) for g in groups], changed.select("_day", *by).schema)
    on = wanted.select(*[F.col(c).alias(f"_of_{c}") for c in wanted.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in wanted.columns])
    append_new(rows.where(some).join(on, same, "left_semi").drop("_day"), path, keys, imported, since, partition_by)
    kept = now if known is None else now.unionByName(not_held(known, now, ["_day", *by]))
    refresh_table(kept, noted)
    return days
