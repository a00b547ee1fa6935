"""Projections, filters, joins, aggregates and set operations.

No join carries a broadcast hint: Spark broadcasts a side when its size, known or measured at run
time, is below ``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from adspark.functions.columns import as_col
from adspark.functions.time import day_of, diff_units, duration


# ---- projections

def derive(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns one after the other; each may use the ones before it."""
    return reduce(lambda acc, item: acc.withColumn(*item), exprs.items(), df)


def project(df: DataFrame, **exprs: Column | str) -> DataFrame:
    """Select and rename: ``project(df, new="old", other=F.col("a") + 1)``."""
    return df.select(*[as_col(c).alias(n) for n, c in exprs.items()])


def with_const(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({n: F.lit(v) for n, v in values.items()})


def with_nulls(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items()})


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


# ---- filters

def between(df: DataFrame, col: str, lo: Column, hi: Column) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def in_list(df: DataFrame, col: str, values: Iterable, negate: bool = False) -> DataFrame:
    found = F.col(col).isin(*values)
    return df.where(~found if negate else found)


def optional_in(df: DataFrame, col: str, values: Iterable | None) -> DataFrame:
    """Rows with one of the values that are set; none if no value is set."""
    wanted = [v for v in values or [] if v not in (None, "")]
    return df.where(F.col(col).isin(*wanted)) if wanted else df.where(F.lit(False))


def not_dropped(df: DataFrame, col: str = "dropped") -> DataFrame:
    return df.where(~F.coalesce(F.col(col), F.lit(False)))


def contains(col: Column | str, text: str, ignore_case: bool = False) -> Column:
    value = as_col(col)
    return F.contains(F.lower(value), F.lit(text.lower())) if ignore_case else F.contains(value, F.lit(text))


def like_any(col: Column | str, patterns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [as_col(col).like(p) for p in patterns])


def eq_ci(left: Column | str, right: Column | str) -> Column:
    return F.lower(as_col(left)) == F.lower(as_col(right))


def present(df: DataFrame, cols: Sequence[str], empty: bool = False) -> DataFrame:
    """Rows whose columns are all set (and, for text, not empty unless ``empty``)."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
        if not empty and dict(df.dtypes)[c] == "string":
            df = df.where(F.col(c) != "")
    return df


def overlaps(start: Column | str, end: Column | str, lo: Column, hi: Column,
             inclusive: str = "both") -> Column:
    """Does [start, end] overlap [lo, hi]? ``inclusive``: both, left (start < hi, end >= lo), neither."""
    start, end = as_col(start), as_col(end)
    before = start <= hi if inclusive == "both" else start < hi
    after = end > lo if inclusive == "neither" else end >= lo
    return before & after


def min_seconds(start: Column | str, end: Column | str, n: int, inclusive: bool = True) -> Column:
    spent = diff_units("second", start, end)
    return spent >= n if inclusive else spent > n


def longer_than(start: Column | str, end: Column | str, seconds: int) -> Column:
    return duration(start, end) > F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def any_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def recent_or_null(cols: Sequence[Column | str], since: Column) -> Column:
    """Is any of the dates recent or not known?"""
    return any_of(*[(as_col(c) >= since) | as_col(c).isNull() for c in cols])


def since_min(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """Rows on or after the smallest value of another table's column."""
    return df.where(F.col(col) >= other.agg(F.min(other_col)).scalar())


# ---- joins

def inner(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    return left.join(right, on=keys, how="inner")


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Keep every left row, add what the right side knows."""
    return left.join(right, on=keys, how="left")


def join_expr(left: DataFrame, right: DataFrame, lexpr: Column, rexpr: Column,
              how: str = "inner") -> DataFrame:
    """Equi-join on computed keys, projected first so that both sides hash on a plain column."""
    return (left.withColumn("_join_key", lexpr)
            .join(right.withColumn("_join_key", rexpr), "_join_key", how).drop("_join_key"))


def in_rel(df: DataFrame, other: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    return df.join(other, on=keys, how="left_semi")


def not_in_rel(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Difference by key. NULLs in the exclusion list exclude nothing; a NULL key is dropped."""
    listed = other.select(key).where(F.col(key).isNotNull())
    return df.where(F.col(key).isNotNull()).join(listed, on=key, how="left_anti")


def not_exists(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), on=list(keys), how="left_anti")


def not_held(df: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` without an equal key in ``held``, where NULL equals NULL."""
    other = held.select(*[F.col(k).alias(f"_held_{k}") for k in keys])
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(other[f"_held_{k}"]) for k in keys])
    return df.join(other, on, "left_anti")


def left_star(spine: DataFrame, arms: Iterable[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Left-join aggregates, each on its own keys, to a spine."""
    return reduce(lambda acc, arm: lookup(acc, arm[0], list(arm[1])), arms, spine)


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row, as scalar subqueries."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def with_parent(df: DataFrame, parent_key: str, key: str, cols: Sequence[str],
                prefix: str = "parent_", parents: DataFrame | None = None) -> DataFrame:
    """Add columns of the row (of ``parents``, if it is given) that ``parent_key`` points to; NULL where there is none.

    Rows without a parent, often most of them, would all be shuffled to one task with the key NULL. A second part of the key spreads
    them: a hash of their own key, and 0 in rows with a parent and in parents (as a remainder, for a literal would be folded away).
    """
    own = F.xxhash64(key)
    parent = (df if parents is None else parents).select(F.col(key).alias(parent_key), F.pmod(own, F.lit(1)).alias("_spread"), *[F.col(c).alias(prefix + c) for c in cols])
    rows = df.withColumn("_spread", F.when(F.col(parent_key).isNull(), own).otherwise(F.lit(0).cast("long")))
    return lookup(rows, parent, [parent_key, "_spread"]).drop("_spread")


# ---- aggregates

def cond_sum(df: DataFrame, keys: Sequence[str], tests: Mapping[str, Column],
             zero: bool = True) -> DataFrame:
    """Rows that meet each test, per group. Without ``zero`` no match gives NULL, not 0."""
    aggs = [(F.count_if(test) if zero else F.sum(F.when(test, 1))).alias(n)
            for n, test in tests.items()]
    return df.groupBy(*keys).agg(*aggs)


def pivot_counts(df: DataFrame, keys: Sequence[str], col: str, names: Mapping, measure: str) -> DataFrame:
    """One summed column per listed value of ``col``; 0 where a group has none."""
    aggs = [F.sum(F.when(F.col(col) == v, F.col(measure)).otherwise(0)).alias(n)
            for v, n in names.items()]
    return df.groupBy(*keys).agg(*aggs)


def agg_where(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], pred: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()]).where(pred)


def collect_distinct_text(df: DataFrame, keys: Sequence[str], col: str, name: str,
                          sep: str = ",") -> DataFrame:
    """Sorted distinct values as text. Deduplicated first, so a group holds its vocabulary only."""
    values = df.select(*keys, F.col(col).cast("string").alias(col)).distinct()
    return values.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set(col)), sep).alias(name))


def ratio_to_total(num: DataFrame, num_col: str, den: DataFrame, den_col: str, name: str) -> DataFrame:
    total = den.select(den_col).scalar()
    return num.withColumn(name, F.try_divide(F.col(num_col).cast("double"), total.cast("double")))


# ---- set operations

def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def intersect_keys(*dfs: DataFrame, key: str) -> DataFrame:
    """Keys present in all inputs: one grouping, no join."""
    tagged = union_all(*[d.select(key, F.lit(1 << i).alias("_in")) for i, d in enumerate(dfs)])
    return (tagged.where(F.col(key).isNotNull()).groupBy(key).agg(F.bit_or("_in").alias("_in"))
            .where(F.col("_in") == (1 << len(dfs)) - 1).select(key))


def same_day_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
                  right_ts: str) -> DataFrame:
    """Keys and days found on both sides; both are reduced to their days before they meet."""
    l = left.select(*keys, day_of(left_ts).alias("day")).distinct()
    r = right.select(*keys, day_of(right_ts).alias("day")).distinct()
    return in_rel(l, r, [*keys, "day"])
