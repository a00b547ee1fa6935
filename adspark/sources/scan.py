"""Scans limited by partition range, by a dimension, by name or over JDBC."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from adspark.functions.time import ts_literal


def scan_events(df: DataFrame, start: datetime, end: datetime, countries=(),
                partition_col: str = "partition_time", partition_format: str | None = None,
                country_col: str = "country") -> DataFrame:
    """Rows of a partition range and of the countries wanted.

    The bounds are literals compared with the raw column, so partition pruning and parquet
    push-down both apply. ``partition_format`` (for instance ``%Y%m%d%H``) is for partition columns
    that hold the hour or day as text.
    """
    column = F.col(partition_col)
    if partition_format:
        df = df.where(column.between(start.strftime(partition_format), end.strftime(partition_format)))
    else:
        df = df.where(column.between(ts_literal(start), ts_literal(end)))
    return df.where(F.col(country_col).isin(*countries)) if countries else df


def scan_between_dim(fact: DataFrame, ts_col: str, dim: DataFrame, lo_col: str, hi_col: str) -> DataFrame:
    """Fact rows between the smallest and the largest time found in a dimension.

    Both bounds are scalar subqueries: evaluated once, before the scan, and merged by Catalyst.
    """
    lo = dim.agg(F.min(lo_col)).scalar()
    hi = dim.agg(F.max(hi_col)).scalar()
    return fact.where((F.col(ts_col) >= lo) & (F.col(ts_col) <= hi))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str, lower: date | int,
              upper: date | int, num_partitions: int, **options: str) -> DataFrame:
    """A parallel read of another warehouse: one range of ``partition_column`` per task."""
    return (spark.read.format("jdbc").options(**options)
            .option("url", url)
            .option("dbtable", f"({query}) q")
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(num_partitions))
            .option("fetchsize", "100000")
            .load())
