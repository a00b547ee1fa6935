"""Row choice per key, and orderings over a whole result.

A global window would send every row through one task. Orderings here sort by range over all
tasks, number rows inside each range, and add the sizes of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from adspark.functions.columns import as_col, seeded_order
from adspark.stage import written


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key. Text in ``order`` means descending.

    Spark keeps one row per key in every map task before it shuffles (WindowGroupLimit), so a key
    that holds a large share of the rows is cut down where it is read.
    """
    by = [F.col(o).desc() if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def with_group_min(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """The minimum of the group on each of its rows.

    A partial aggregate and a join in place of a window over the whole group: the hot group's rows
    stay spread, and adaptive execution splits its side of the join.
    """
    low = df.groupBy(*keys).agg(F.min(col).alias(name))
    return df.join(low, on=list(keys), how="left")


def _in_ranges(df: DataFrame, order: Sequence[Column], number: Column) -> DataFrame:
    """The rows with their range of the order (``_range``) and ``number``, a window function, inside it (``_in``).

    They are written once and read from there. Rows that are equal in the order are dealt by a hash of the whole
    row, so that a frequent value fills no single range.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind]  # Spark hashes no maps
    ranged = df.repartitionByRange(*order, F.xxhash64(*hashed)).withColumn("_range", F.spark_partition_id())
    return written(ranged.withColumn("_in", number.over(Window.partitionBy("_range").orderBy(*order))))


def _offsets(ranged: DataFrame, *facts: Column) -> DataFrame:
    """A row for each range, at most spark.sql.shuffle.partitions of them: the rows in front of it, and ``facts``."""
    in_front = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"), *facts)
    return sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(in_front), F.lit(0)))


def row_rank(df: DataFrame, order: Sequence[str], name: str = "row_num") -> DataFrame:
    """Global RANK: rows with equal order columns share a number, and the next number has a gap.

    The input is read once and no row is joined back: whole rows are numbered inside ranges of the order. Only a range's first value
    may have begun in an earlier range. Its rank is the least that the ranges beginning or ending with it give it.
    """
    cols = [F.col(c).asc_nulls_last() for c in order]
    ranged = _in_ranges(df, cols, F.rank())
    value = F.struct(*[x for k, c in enumerate(order) for x in (F.col(c).isNull().alias(f"n{k}"), F.col(c).alias(f"v{k}"))])
    ranges = written(_offsets(ranged, F.min(value).alias("_first"), F.max(value).alias("_last"), F.max("_in").alias("_last_in")))
    ends = F.explode(F.array(F.struct(F.col("_first").alias("v"), (F.col("_offset") + 1).alias("rank")),
                             F.struct(F.col("_last").alias("v"), (F.col("_offset") + F.col("_last_in")).alias("rank"))))
    begun = ranges.select(ends.alias("e")).groupBy("e.v").agg(F.min("e.rank").alias("_start"))
    ranges = ranges.join(begun, F.col("_first") == F.col("v")).select("_range", "_offset", "_first", "_start")
    ranked = F.when(value == F.col("_first"), F.col("_start")).otherwise(F.col("_offset") + F.col("_in"))
    return ranged.join(ranges, "_range").select(*df.columns, ranked.cast("long").alias(name))


def numbered_rows(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows (unique by ``order``) with their place in the order, from 0 on without gaps."""
    ranged = _in_ranges(df, [F.col(c) for c in order], F.row_number())
    numbered = ranged.join(_offsets(ranged).select("_range", "_offset"), "_range")
    return numbered.select(*df.columns, (F.col("_offset") + F.col("_in") - 1).cast("long").alias(name))


def random_ntile(df: DataFrame, key: str, n: int, seed: int = 0, name: str = "tile") -> DataFrame:
    """Split rows (unique by ``key``) at random into ``n`` tiles whose sizes differ by at most one."""
    ordered = df.withColumn("_order", seeded_order(key, seed))
    ranged = _in_ranges(ordered, [F.col("_order"), as_col(key)], F.row_number())
    numbered = ranged.join(_offsets(ranged).select("_range", "_offset"), "_range")
    total = F.col("_total")
    small, rest = F.floor(total / n), total % n
    row = F.col("_offset") + F.col("_in")
    edge = rest * (small + 1)
    tile = F.when(row <= edge, F.ceil(row / (small + 1))).otherwise(
        rest + F.ceil((row - edge) / F.greatest(small, F.lit(1))))
    return (numbered.withColumn("_total", ranged.agg(F.count("*")).scalar())
            .withColumn(name, tile.cast("long")).drop("_range", "_in", "_offset", "_order", "_total"))
