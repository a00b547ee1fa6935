"""State that is kept per day and merged when it is read.

A :class:`DailyState` holds, for every day taken, one row per key with aggregates that merge (the earliest, the latest, a
sum). Nobody reads the raw log of a long lookback again: a night takes the days that are new and those that may have changed,
and a report merges days. Taking a day again replaces it, so days may come in any order and any number of times.

Whole past months are folded into one row per key and month; a range is read as months with single days at its ends.
Days and months are written beside the old ones and come into force by a marker, whose name holds the day, a growing
number and the folder; readers see a day's old rows or its new ones. A crash leaves folders without marker.
"""

from __future__ import annotations

import calendar
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adspark.sinks.tables import _fs

MERGES = {"min": F.min, "max": F.max, "sum": F.sum}


def days_between(lo: date, hi: date) -> list[date]:
    return [lo + timedelta(days=k) for k in range((hi - lo).days + 1)]


@dataclass(frozen=True)
class DailyState:
    """``merge`` names the aggregate of each value column: min, max or sum."""

    folder: str
    keys: tuple[str, ...]
    merge: Mapping[str, str]

    def _merged(self, df: DataFrame, *also: Column | str) -> DataFrame:
        return df.groupBy(*also, *self.keys).agg(*[MERGES[how](c).alias(c) for c, how in self.merge.items()])

    # ---- markers

    def _in_force(self, spark: SparkSession, what: str) -> dict[str, tuple[int, str]]:
        """For each day or month its number and folder."""
        fs, at = _fs(spark, f"{self.folder}/_{what}")
        found: dict[str, tuple[int, str]] = {}
        for s in fs.listStatus(at) if fs.exists(at) else ():
            name, number, made = s.getPath().getName().split("~")
            found[name] = max(found.get(name, (0, "")), (int(number), made))
        return found

    def _mark(self, spark: SparkSession, what: str, names: Sequence[str], made: str) -> None:
        before = self._in_force(spark, what)
        for name in names:
            number = before.get(name, (0, ""))[0] + 1
            fs, marker = _fs(spark, f"{self.folder}/_{what}/{name}~{number:09d}~{made}")
            fs.create(marker).close()

    def taken(self, spark: SparkSession) -> set[date]:
        return {date.fromisoformat(d) for d in self._in_force(spark, "days")}

    def missing(self, spark: SparkSession, lo: date, hi: date) -> list[date]:
        """The days of a range that were never taken."""
        known = self.taken(spark)
        return [d for d in days_between(lo, hi) if d not in known]

    # ---- writing

    def take(self, rows: DataFrame, day: Column, days: Sequence[date]) -> None:
        """Replace ``days`` by what ``rows`` hold for them (a day without rows is taken, too). ``day`` is their date."""
        if not days:
            return
        spark, made = rows.sparkSession, uuid.uuid4().hex
        fs, _ = _fs(spark, self.folder)
        wanted = sorted(set(days))
        rows = rows.where(day.between(F.lit(wanted[0]), F.lit(wanted[-1])))
        if len(wanted) <= (wanted[-1] - wanted[0]).days:
            rows = rows.where(day.isin(wanted))
        partial = self._merged(rows.withColumn("_day", day), "_day")
        if not fs.exists(_fs(spark, f"{self.folder}/schema")[1]):
            partial.drop("_day").limit(0).write.mode("ignore").parquet(f"{self.folder}/schema")
        partial.write.partitionBy("_day").parquet(f"{self.folder}/days/{made}")
        for month in {d.isoformat()[:7] for d in wanted}:  # a month that holds the old day must not be read any more
            for name in self._markers(spark, "months", month):
                fs.delete(_fs(spark, f"{self.folder}/_months/{name}")[1], False)
        self._mark(spark, "days", [d.isoformat() for d in wanted], made)

    def _markers(self, spark: SparkSession, what: str, of: str) -> list[str]:
        fs, at = _fs(spark, f"{self.folder}/_{what}")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return [n for n in names if n.split("~")[0] == of]

    def fold(self, spark: SparkSession, before: date) -> list[str]:
        """Fold the months that end before a day, whose days are all taken and which aren't folded yet, in one job."""
        known, done = self.taken(spark), self._in_force(spark, "months")
        months = sorted({d.isoformat()[:7] for d in known})
        whole = [m for m in months if m not in done and _last(m) < before and all(d in known for d in days_between(_first(m), _last(m)))]
        if whole:
            made = uuid.uuid4().hex
            parts = [self._read(spark, days_between(_first(m), _last(m)), []).withColumn("_month", F.lit(m)) for m in whole]
            rows = reduce(DataFrame.unionByName, parts)
            self._merged(rows, "_month").write.partitionBy("_month").parquet(f"{self.folder}/months/{made}")
            self._mark(spark, "months", whole, made)
        return whole

    def vacuum(self, spark: SparkSession) -> int:
        """Delete what no marker in force names. No one may be reading or writing."""
        gone = 0
        for what, column in (("days", "_day"), ("months", "_month")):
            force = {(made, name) for name, (_, made) in self._in_force(spark, what).items()}
            fs, top = _fs(spark, f"{self.folder}/{what}")
            for made in fs.listStatus(top) if fs.exists(top) else ():
                kept = 0
                for part in fs.listStatus(made.getPath()):
                    key, _, name = part.getPath().getName().partition("=")
                    if key == column and (made.getPath().getName(), name) in force:
                        kept += 1
                    elif key == column:
                        fs.delete(part.getPath(), True)
                        gone += 1
                if not kept:
                    fs.delete(made.getPath(), True)
            for name, (number, made) in self._in_force(spark, what).items():
                for marker in self._markers(spark, what, name):
                    if int(marker.split("~")[1]) < number:
                        fs.delete(_fs(spark, f"{self.folder}/_{what}/{marker}")[1], False)
        return gone

    # ---- reading

    def _read(self, spark: SparkSession, days: Sequence[date], months: Sequence[str]) -> DataFrame:
        paths = []
        for what, column, names in (("days", "_day", [d.isoformat() for d in days]), ("months", "_month", list(months))):
            force = self._in_force(spark, what)
            paths += [f"{self.folder}/{what}/{force[n][1]}/{column}={n}" for n in names]
        there = []
        for path in paths:
            fs, at = _fs(spark, path)
            if fs.exists(at):  # a day without rows has a marker and no folder
                there.append(path)
        schema = self.schema(spark)
        return spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)

    def schema(self, spark: SparkSession) -> T.StructType:
        """Keys and values as they were first taken."""
        return spark.read.parquet(f"{self.folder}/schema").schema

    def read(self, spark: SparkSession, lo: date, hi: date) -> DataFrame:
        """One row per key over the days from ``lo`` to ``hi``, all of which must have been taken."""
        absent = self.missing(spark, lo, hi)
        if absent:
            raise LookupError(f"{len(absent)} days from {absent[0]} on were never taken in {self.folder}")
        folded = self._in_force(spark, "months")
        months = [m for m in sorted({d.isoformat()[:7] for d in days_between(lo, hi)}) if m in folded and _first(m) >= lo and _last(m) <= hi]
        days = [d for d in days_between(lo, hi) if d.isoformat()[:7] not in months]
        return self._merged(self._read(spark, days, months))


def _first(month: str) -> date:
    return date.fromisoformat(f"{month}-01")


def _last(month: str) -> date:
    first = _first(month)
    return first.replace(day=calendar.monthrange(first.year, first.month)[1])
