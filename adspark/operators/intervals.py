"""Points in the intervals of their key, where a key may have many of both.

An equi-join on the key pairs every point with every interval of its key before the range test. Keys with few intervals
are joined so. For the others each interval is cut into aligned blocks of whole seconds, at most two of each size
1, 2, 4, ... (a dyadic cover), and its first and last second; a point lies in one block of each size, so a
join on (key, size, block) finds each of its intervals exactly once. Only in the first and last second the range itself is tested.
A point is read once for each size that its key's intervals use, a number that grows with the logarithm of their length.

Where a key's intervals overlap, the pairs outgrow both sides whatever the join. A caller who wants them counted gets counts (``count``): equal
blocks are added up before they meet the points.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from adspark.stage import stage

#: Keys with at most so many intervals are joined by the key alone, at the level ``ALWAYS``.
FEW, ALWAYS, LEVELS = 4, -1, 40


def _second(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def _cover(spans: DataFrame) -> DataFrame:
    """``spans`` with a row for each of the blocks (level, block, edge) that hold the seconds from ``_lo`` to ``_hi`` exactly once;
    edges hold the two ends."""
    first, last = _second(F.col("_lo")), _second(F.col("_hi"))
    inner_lo, inner_hi, level = first + 1, last, F.col("level")  # the seconds between, as a half-open range
    a = -F.call_function("shiftright", -inner_lo, level)  # the first block of this size that begins in the range
    b = F.call_function("shiftright", inner_hi, level)  # the first that doesn't end in it
    left, right = F.when((a % 2 != 0) & (a < b), a), F.when((b % 2 != 0) & (a < b), b - 1)
    spread = spans.repartition(*spans.columns)  # a small file may be a single task's
    levels = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level"))
    inside = levels.where(F.coalesce(left, right).isNotNull()).select(
        *spans.columns, F.col("level").cast("int").alias("level"), F.explode(F.array_compact(F.array(left, right))).alias("block"), F.lit(False).alias("edge"))
    edges = spread.select(*spans.columns, F.lit(0).alias("level"), F.explode(F.array_distinct(F.array(first, last))).alias("block"),
                          F.lit(True).alias("edge"))
    return inside.unionByName(edges)


def _blocks(intervals: DataFrame, keys: list[str], extra: list[str], lo: str, hi: str, few: int, count: bool) -> DataFrame:
    """The blocks of each interval, with its ends and, as ``_with``, its columns ``extra``; with ``count`` equal intervals are one, ``_m`` times."""
    spans = intervals.select(*keys, F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), F.struct(F.lit(True).alias("_"), *extra).alias("_with"))
    spans = spans.where((F.col("_lo") <= F.col("_hi")) & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    if count:
        spans = spans.groupBy(*spans.columns).agg(F.count("*").alias("_m"))
    dense = spans.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > few).select(*keys)
    always = spans.join(dense, keys, "left_anti").select(
        *spans.columns, F.lit(ALWAYS).alias("level"), F.lit(0).cast("long").alias("block"), F.lit(True).alias("edge"))
    return _cover(spans.join(dense, keys, "left_semi")).unionByName(always)


def _found(points: DataFrame, blocks: DataFrame, keys: list[str], ts: str, how: str) -> tuple[DataFrame, DataFrame]:
    """The points with the sizes that their key uses, and the points with the blocks that hold them."""
    used = blocks.where(F.col("level") >= 0).groupBy(*keys).agg(F.collect_set("level").alias("_levels"))
    tagged = points.join(used, keys, "left")
    looked = tagged.select(*points.columns, F.explode(F.coalesce("_levels", F.array(F.lit(ALWAYS)))).alias("_level"))
    second = F.call_function("shiftright", _second(F.col(ts)), F.col("_level"))
    looked = looked.withColumn("_block", F.when(F.col("_level") == ALWAYS, 0).otherwise(second))
    names = reduce(lambda d, k: d.withColumnRenamed(k, f"_r{k}"), keys, blocks)
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r{k}") for k in keys])
    same = same & (F.col("_level") == F.col("level")) & (F.col("_block") == F.col("block"))
    inside = F.coalesce(F.col(ts) >= F.col("_lo"), F.lit(True)) & F.coalesce(F.col(ts) <= F.col("_hi"), F.lit(True))
    return tagged, looked.join(names, same & F.col(ts).isNotNull() & (~F.col("edge") | inside), how)


def _counted(points: DataFrame, blocks: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Each key and time of the points with every ``_with`` of the intervals that hold it, and their number ``_n``.

    Equal blocks are one row with their number. Of an interval's first and last second only the end that lies in it tells blocks apart.
    """
    edge_at = [F.when(F.col("edge") & ((F.col("level") == ALWAYS) | (F.col("block") == _second(F.col(c)))), F.col(c)).alias(c)
            for c in ("_lo", "_hi")]
    blocks = stage(blocks.groupBy(*keys, "level", "block", "edge", *edge_at, "_with").agg(F.sum("_m").alias("_n")))
    times = points.select(*keys, ts).distinct()
    _, found = _found(times, blocks, keys, ts, "inner")
    return found.groupBy(*keys, ts, "_with").agg(F.sum("_n").alias("_n"))


def point_in_interval(points: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str,
                      lo: str, hi: str, how: str = "inner", few: int = FEW, count: str | None = None) -> DataFrame:
    """Points with the intervals of their key that hold them, ends included, a row for each of several; ``how="left"``
    also keeps points in none, with NULLs. Points and intervals without a key or a time match nothing.

    One join serves both kinds of keys: those with few intervals have a single block for all time. Points in none
    are found by a second look at the points of the other keys, if there are such keys.

    With ``count`` a point's intervals that agree in all columns but their ends come as one row without these, with their number in the
    column ``count``; a point in none has 1. The numbers add up to the rows of the join, which are never made.
    """
    keys, own = list(keys), [*points.columns]
    extra = [c for c in intervals.columns if c not in own and not (count and c in (lo, hi))]
    blocks = _blocks(intervals, keys, extra, lo, hi, few, bool(count))
    with_extra = [F.col(f"_with.{c}").alias(c) for c in extra]
    if count:
        if how != "left":
            points = points.where(F.col(ts).isNotNull())
        held = _counted(points, blocks, keys, ts)
        return points.join(held, [*keys, ts], how).select(*own, *with_extra, F.coalesce("_n", F.lit(1)).alias(count))
    blocks = stage(blocks)
    tagged, found = _found(points, blocks, keys, ts, how)
    out = lambda df: df.select(*own, *with_extra)
    if how != "left":
        return out(found)
    kept = out(found.where(F.col("_with").isNotNull() | (F.col("_level") == ALWAYS)))
    if blocks.where(F.col("level") >= 0).isEmpty():
        return kept
    hit = found.where(F.col("_with").isNotNull() & (F.col("_level") != ALWAYS)).select(*keys, ts).distinct()  # key and time decide
    rest = tagged.where(F.col("_levels").isNotNull()).join(hit, [*keys, ts], "left_anti")
    return kept.unionByName(rest.select(*own), allowMissingColumns=True)
