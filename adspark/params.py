"""Report parameters and the windows derived from them."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adspark.functions.time import (
    date_literal, day_end, day_start, previous_day, quarter_start, shift, shift_date, ts_literal)


def months_back(day: date, months: int) -> date:
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    last = (date(year + (month == 11), (month + 1) % 12 + 1, 1) - timedelta(days=1)).day
    return date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class ReportParams:
    """One reporting period. ``countries`` empty means all of them, in one job.

    ``known_sellers`` are those whose delivery carries resolved device ids; ``own_exchange`` and
    ``own_seller`` mark our own delivery, which the device universe takes in.
    """

    start: date
    end: date
    attribution_days: int | None = 7
    lookback_months: int = 12
    page_lookback_days: int = 30
    countries: tuple[str, ...] = ()
    app_name: str | None = None
    run_date: date | None = None
    signup_segment: int | None = None
    homepage_segment: int | None = None
    min_seconds: int = 60
    known_sellers: tuple[str, ...] = ()
    own_exchange: int | None = None
    own_seller: str | None = None

    @property
    def window_start(self) -> datetime:
        return datetime.combine(self.start, time())

    @property
    def window_end(self) -> datetime:
        return datetime.combine(self.end, time(23, 59, 59))

    @property
    def attribution_end(self) -> datetime:
        return self.window_end + timedelta(days=abs(self.attribution_days or 0))

    @property
    def usage_lookback(self) -> datetime:
        return datetime.combine(months_back(self.start, abs(self.lookback_months)), time())

    @property
    def page_lookback(self) -> datetime:
        return self.window_start - timedelta(days=abs(self.page_lookback_days))

    def in_window(self, ts: Column) -> Column:
        return ts.between(ts_literal(self.window_start), ts_literal(self.window_end))

    def in_attribution(self, ts: Column) -> Column:
        return ts.between(ts_literal(self.window_start), ts_literal(self.attribution_end))

    def in_country(self, country: Column) -> Column:
        return country.isin(*self.countries) if self.countries else country.isNotNull()

    def but(self, **changes) -> ReportParams:
        return replace(self, **changes)

    @classmethod
    def weekly(cls, run_date: date, **kwargs) -> ReportParams:
        """Monday to Sunday, two weeks before the run, as when no dates are given."""
        back = (run_date.weekday() + 1) % 7 or 7
        end = run_date - timedelta(days=back + 7)
        return cls(start=end - timedelta(days=6), end=end, run_date=run_date, **kwargs)


def report_window(spark: SparkSession, p: ReportParams) -> DataFrame:
    """The derived edges as one row."""
    return spark.range(1).select(
        ts_literal(p.window_start).alias("window_start"),
        ts_literal(p.window_end).alias("window_end"),
        ts_literal(p.attribution_end).alias("attribution_end"),
        ts_literal(p.usage_lookback).alias("usage_lookback"),
        ts_literal(p.page_lookback).alias("page_lookback"))


def window_edges(start: Column, end: Column, attribution_days: int, lookback_months: int,
                 page_lookback_days: int) -> dict[str, Column]:
    """The same edges for a table that holds one reporting period per row."""
    return {
        "window_start": day_start(start),
        "window_end": day_end(end),
        "attribution_end": shift("day", attribution_days, day_end(end)),
        "usage_lookback": shift("month", -lookback_months, day_start(start)),
        "page_lookback": shift("day", -page_lookback_days, day_start(start)),
    }


def default_window(run_date: Column) -> tuple[Column, Column]:
    """Start and end (Monday, Sunday) of the default period for a run date."""
    end = F.date_sub(previous_day(run_date, "SUN"), 7)
    return previous_day(end, "MON"), end


def campaign_window(meta: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """One row: first campaign start and last campaign end, or the whole days given instead."""
    return meta.agg(
        F.min("campaign_start").alias("campaign_start"),
        F.max("campaign_end").alias("campaign_end"),
    ).select(
        (day_start(date_literal(start)) if start else F.col("campaign_start")).alias("campaign_start"),
        (day_end(date_literal(end)) if end else F.col("campaign_end")).alias("campaign_end"))


def mapping_window(run_date: Column) -> tuple[Column, Column]:
    """From the earlier of six months ago and the quarter start, to the end of yesterday."""
    lo = F.least(shift_date("month", -6, run_date), quarter_start(run_date))
    return day_start(lo), day_end(F.date_sub(run_date, 1))
