"""Relations made from parameters and from delimited or map columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def split_to_rows(spark: SparkSession, text: str, sep: str = ",", name: str = "value") -> DataFrame:
    """A delimited parameter as rows, trimmed, without empty items."""
    return split_column(spark.range(1).select(F.lit(text).alias("text")), "text", sep, name).select(name)


def split_column(df: DataFrame, column: str, sep: str = ",", name: str = "value") -> DataFrame:
    """One row per item of a delimited column."""
    items = F.split(F.col(column), f"\\Q{sep}\\E")
    return (df.withColumn(name, F.explode(items))
            .withColumn(name, F.trim(name))
            .where(F.col(name) != ""))


def one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()])


def numbers(spark: SparkSession, n: int, name: str = "num") -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", name)


def map_rows(df: DataFrame, column: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per entry of a map column."""
    return df.select(*[c for c in df.columns if c != column], F.explode(column).alias(key, value))
