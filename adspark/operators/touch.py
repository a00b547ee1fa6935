"""Joining exposures with later conversions of the same device.

The textbook form joins on the device and keeps the pairs in time order. One device with many
rows on both sides then gives the product of the two, in one task. Nothing here builds pairs, and
no device is ever handled whole: its time line is cut into slices (a quarter of an hour, unless told
otherwise), slices are worked on apart, and one small row per slice is carried from one to the next.
Sparse devices have about as many slices as rows, so short slices cost them nothing.

* :func:`last_touch` and :func:`first_touch` choose one exposure for each conversion,
  :func:`next_touch` the first one after a point in time.
* :func:`pair_totals` counts and sums over all pairs, from running sums.

``max_days`` counts calendar days; None means no limit. An exposure at the very time of the
conversion counts. Rows without a key or a time take part in nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from adspark.functions.columns import as_col
from adspark.stage import stage

SLICE_MINUTES = 15


def _keyed(df: DataFrame, keys: Sequence[str], ts: str, slice_minutes: int) -> DataFrame:
    """Rows with a key and a time, their day number and the slice of the day."""
    at = F.col(ts).cast("timestamp_ntz")
    minute = F.hour(at) * 60 + F.minute(at)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.col(ts).isNotNull())
    return df.where(known).withColumns({
        "_ts": at, "_day": F.unix_date(F.to_date(at)), "_slice": F.floor(minute / slice_minutes).cast("int")})


def _nearest(exposures: DataFrame, probes: DataFrame, keys: Sequence[str], exposure_ts: str,
             carry: Sequence[str], forward: bool, slice_minutes: int) -> DataFrame:
    """Each probe with the nearest exposure at or before it (``forward``: at or after it), or NULL.

    Of several exposures at the same time the one with the lowest ``carry`` is taken.
    """
    slice_of = [*keys, "_day", "_slice"]
    touches = _keyed(exposures, keys, exposure_ts, slice_minutes).select(
        *slice_of, "_ts", F.struct(F.col("_ts").alias("ts"), F.struct(*carry, F.lit(0)).alias("at")).alias("_touch"))
    line = touches.unionByName(probes, allowMissingColumns=True)

    # In time order, an exposure before a probe of the same time, and the lowest carry last.
    by_time = F.col("_ts").desc() if forward else F.col("_ts").asc()
    so_far = (Window.partitionBy(*slice_of)
              .orderBy(by_time, F.col("_probe").isNotNull(), F.col("_touch.at").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    line = line.withColumn("_found", F.last("_touch", ignorenulls=True).over(so_far))

    # What a slice passes on: its latest find. Counting the probes keeps both readers of ``line``
    # on the same columns, so that Spark shuffles it once and reuses the exchange.
    outermost = F.min_by if forward else F.max_by
    per_slice = line.groupBy(*slice_of).agg(
        outermost("_found", "_found.ts").alias("_found"), F.count("_probe").alias("_probes"))
    order = [F.col(c).desc() if forward else F.col(c).asc() for c in ("_day", "_slice")]
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inherited = (per_slice.withColumn("_inherited", F.last("_found", ignorenulls=True).over(earlier))
                 .where((F.col("_probes") > 0) & F.col("_inherited").isNotNull())
                 .select(*slice_of, "_inherited"))
    return (line.where(F.col("_probe").isNotNull()).join(inherited, slice_of, "left")
            .select("_probe", F.coalesce("_found", "_inherited").alias("_touch")))


def last_touch(exposures: DataFrame, conversions: DataFrame, keys: Sequence[str], exposure_ts: str,
               conversion_ts: str, carry: Sequence[str], max_days: int | None = None,
               slice_minutes: int = SLICE_MINUTES) -> DataFrame:
    """Each conversion that follows an exposure, with the time and ``carry`` of the latest one.

    The latest exposure is within ``max_days`` if any exposure is, so only that one is tested.
    """
    probes = _probes(conversions, keys, F.col(conversion_ts), slice_minutes)
    found = _nearest(exposures, probes, keys, exposure_ts, carry, False, slice_minutes)
    found = found.where(F.col("_touch").isNotNull())
    if max_days is not None:
        found = found.where(F.date_diff(F.col(f"_probe.{conversion_ts}"), F.col("_touch.ts")) <= max_days)
    return _flat(found, exposure_ts, carry)


def first_touch(exposures: DataFrame, conversions: DataFrame, keys: Sequence[str], exposure_ts: str,
                conversion_ts: str, carry: Sequence[str], max_days: int | None = None,
                slice_minutes: int = SLICE_MINUTES) -> DataFrame:
    """Each conversion that follows an exposure, with the earliest exposure of its window.

    The window opens ``max_days`` calendar days before; the first exposure after that moment is the
    one, if it is not later than the conversion.
    """
    if max_days is None:
        opens = F.lit("0001-01-01").cast("timestamp_ntz")
    else:
        opens = F.date_sub(F.to_date(conversion_ts), max_days).cast("timestamp_ntz")
    probes = _probes(conversions, keys, opens, slice_minutes)
    found = _nearest(exposures, probes, keys, exposure_ts, carry, True, slice_minutes)
    found = found.where(F.col("_touch.ts") <= F.col(f"_probe.{conversion_ts}").cast("timestamp_ntz"))
    return _flat(found, exposure_ts, carry)


def next_touch(exposures: DataFrame, probes: DataFrame, keys: Sequence[str], exposure_ts: str, probe_ts: str,
               carry: Sequence[str] = (), slice_minutes: int = SLICE_MINUTES) -> DataFrame:
    """Each probe with the earliest exposure at or after it; probes that nothing follows are left out."""
    at = _probes(probes, keys, F.col(probe_ts), slice_minutes)
    found = _nearest(exposures, at, keys, exposure_ts, carry, True, slice_minutes)
    return _flat(found.where(F.col("_touch").isNotNull()), exposure_ts, carry)


def _probes(conversions: DataFrame, keys: Sequence[str], at: Column, slice_minutes: int) -> DataFrame:
    whole = F.struct(*conversions.columns)
    df = conversions.withColumn("_at", at).withColumn("_probe", whole)
    return _keyed(df, keys, "_at", slice_minutes).select(*keys, "_day", "_slice", "_ts", "_probe")


def _flat(found: DataFrame, exposure_ts: str, carry: Sequence[str]) -> DataFrame:
    return found.select("_probe.*", F.col("_touch.ts").alias(exposure_ts),
                        *[F.col(f"_touch.at.{c}").alias(c) for c in carry])


def pair_totals(exposures: DataFrame, conversions: DataFrame, keys: Sequence[str], exposure_ts: str,
                conversion_ts: str, dims: Sequence[str], measures: Mapping[str, Column | str] | None = None,
                max_days: int | None = None, by_conversion_day: bool = False,
                slice_minutes: int = SLICE_MINUTES) -> DataFrame:
    """Totals over all (exposure, conversion) pairs, per key and ``dims`` of the exposure.

    Gives ``pairs`` and the sum of each measure (a column of the conversions) over the pairs. With
    ``by_conversion_day`` also one row per ``conversion_day``. An exposure sees the conversions
    after it in its slice, then the later slices of its day, then the days after that. What comes
    after a slice does not depend on ``dims``: it is found from one row per key and slice, and joined
    to the exposures of the slice. So a task holds a key's slices, but never its rows by ``dims``.
    """
    measures = {"pairs": F.lit(1), **(measures or {})}
    names = list(measures)
    slot = [*keys, "_day", "_slice"]

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    shown = (_keyed(exposures, keys, exposure_ts, slice_minutes)
             .select(*slot, "_ts", *dims, F.lit(1).cast("long").alias("_w")))
    done = conversions.select(*keys, F.col(conversion_ts).alias("_at"),
                              *[as_col(c).alias(f"_m_{n}") for n, c in measures.items()])
    done = _keyed(done, keys, "_at", slice_minutes).drop("_at")

    # Inside a slice: conversions at or after the exposure, as a running sum from the end.
    line = shown.unionByName(done, allowMissingColumns=True)
    onward = (Window.partitionBy(*slot).orderBy(F.col("_ts").desc())
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    line = line.withColumns({f"_o_{n}": F.sum(f"_m_{n}").over(onward) for n in names})
    slices = line.where(F.col("_w").isNotNull()).groupBy(*slot, *dims).agg(
        F.sum("_w").alias("_w"), *[F.sum(f"_o_{n}").alias(f"_p_{n}") for n in names])

    # After a slice, one row per key and slice: the rest of its day, and the days after it.
    slots = shown.select(*slot).distinct().unionByName(done, allowMissingColumns=True).groupBy(*slot).agg(
        *[F.sum(f"_m_{n}").alias(f"_m_{n}") for n in names])
    rest = (Window.partitionBy(*keys, "_day").orderBy(F.col("_slice").desc())
            .rowsBetween(Window.unboundedPreceding, -1))
    if max_days is None:
        later = (Window.partitionBy(*keys).orderBy(F.col("_day").desc())
                 .rangeBetween(Window.unboundedPreceding, -1))
    else:
        later = Window.partitionBy(*keys).orderBy("_day").rangeBetween(1, max(max_days, 1))
    ahead = {f"_r_{n}": F.sum(f"_m_{n}").over(rest) for n in names}
    if not by_conversion_day and max_days != 0:
        ahead |= {f"_n_{n}": F.sum(f"_m_{n}").over(later) for n in names}
    after = slots.repartition(*keys).withColumns(ahead).select(*slot, *ahead)
    seen = slices.join(after, slot).withColumns({
        n: zero(f"_p_{n}") + F.col("_w") * sum((zero(c) for c in (f"_r_{n}", f"_n_{n}") if c in ahead), F.lit(0))
        for n in names})
    if not by_conversion_day:
        return (seen.groupBy(*keys, *dims).agg(*[F.sum(n).alias(n) for n in names])
                .where(F.col("pairs") > 0))

    # Conversion days of the key next to the exposure days of each ``dims``: a row for a day to report,
    # and a running sum of the exposures before it.
    days = stage(seen.groupBy(*keys, "_day", *dims).agg(
        F.sum("_w").alias("_w"), *[F.sum(n).alias(f"_p_{n}") for n in names]))
    if max_days != 0:
        spans = days.groupBy(*keys, *dims).agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"))
        reported = done.groupBy(*keys, "_day").agg(*[F.sum(f"_m_{n}").alias(f"_m_{n}") for n in names])
        in_reach = F.col("_day") > F.col("_first")
        if max_days is not None:
            in_reach = in_reach & (F.col("_day") <= F.col("_last") + max_days)
        reported = spans.join(reported, list(keys)).where(in_reach).drop("_first", "_last")
        days = days.unionByName(reported, allowMissingColumns=True)
        before = Window.partitionBy(*keys, *dims).orderBy("_day").rangeBetween(
            Window.unboundedPreceding if max_days is None else -max_days, -1)
        days = days.withColumn("_before", F.sum("_w").over(before)).withColumns({
            f"_p_{n}": zero(f"_p_{n}") + zero(f"_m_{n}") * zero("_before") for n in names})
    return (days.groupBy(*keys, *dims, F.date_from_unix_date("_day").alias("conversion_day"))
            .agg(*[F.sum(f"_p_{n}").alias(n) for n in names])
            .where(F.col("pairs") > 0))
