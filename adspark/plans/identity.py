"""Device universe and identity maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adspark.functions.columns import as_col, first_of
from adspark.functions.time import shift, ts_literal
from adspark.operators.relational import in_rel, inner, lookup, not_dropped, union_distinct
from adspark.operators.windows import latest_per_key
from adspark.params import ReportParams

EXTRA_DAYS = 30


def qualified_start(delivery: DataFrame, creative_map: DataFrame, p: ReportParams) -> DataFrame:
    """One row: where the universe starts.

    30 days before the report if none of the sellers that delivered is in ``p.known_sellers``, and also if
    nothing was delivered.
    """
    shown = (delivery.where(p.in_window(F.col("partition_time")) & (F.col("event") == "impression")
                            & p.in_country(F.col("country"))))
    return start_of(in_rel(shown, creative_map.select("campaign_id"), "campaign_id"), p)


def start_of(shown: DataFrame, p: ReportParams) -> DataFrame:
    """:func:`qualified_start` from the impressions of the report's campaigns."""
    known = F.coalesce(F.bool_or(F.col("seller_id").isin(*p.known_sellers)), F.lit(False))
    start = ts_literal(p.window_start)
    return (shown.agg(known.alias("known_seller"))
            .withColumn("universe_start", F.when(F.col("known_seller"), start)
                        .otherwise(shift("day", -EXTRA_DAYS, start))))


def own_impression(p: ReportParams) -> Column:
    """Whether a row of the log is an impression that we delivered ourselves."""
    return (F.col("event") == "impression") & (
        (F.col("exchange_id") == F.lit(p.own_exchange).cast("long")) | (F.col("seller_id") == F.lit(p.own_seller).cast("string")))


def shown_device() -> Column:
    """The device of an impression, resolved or else the first of those listed."""
    return F.coalesce("device_id", first_of("device_ids").cast("long"))


def device_universe(hardware: DataFrame, delivery: DataFrame, app_opens: DataFrame, id_map: DataFrame,
                    p: ReportParams, start: DataFrame | None = None) -> DataFrame:
    """Devices seen in the window by hardware, by our own impressions or by an app opening.

    ``start`` is the one-row result of :func:`qualified_start`.
    """
    own = not_dropped(delivery).where(own_impression(p)).withColumn("device_id", shown_device())
    return universe_with(hardware, own, app_opens, id_map, p, start)


def universe_with(hardware: DataFrame, own: DataFrame, app_opens: DataFrame, id_map: DataFrame,
                  p: ReportParams, start: DataFrame | None = None) -> DataFrame:
    """:func:`device_universe` where the rows of our own impressions, with their devices, are known.

    Source ids are reduced to distinct ones before they are mapped to devices.
    """
    lo: Column = ts_literal(p.window_start) if start is None else start.select("universe_start").scalar()
    hi = ts_literal(p.window_end)

    def seen(df: DataFrame) -> DataFrame:
        t = F.col("partition_time")
        return df.where((t >= lo) & (t <= hi) & p.in_country(F.col("country")))

    sources = union_distinct(*[seen(df).select("country", "source_id") for df in (hardware, app_opens)])
    mapped = inner(sources, id_map.select("source_id", "device_id"), "source_id").select("country", "device_id")
    return (union_distinct(mapped, seen(own).select("country", "device_id"))
            .where(F.col("device_id").isNotNull()))


def universe_size(universe: DataFrame) -> DataFrame:
    return universe.groupBy("country").agg(F.countDistinct("device_id").alias("total_universe"))


def ip_device_map(delivery: DataFrame, id_map: DataFrame, p: ReportParams, ip: Column | str = "ip") -> DataFrame:
    """The device last seen behind each address. Same time: the lowest device id."""
    seen = not_dropped(delivery).where(
        p.in_attribution(F.col("partition_time")) & (F.col("event") == "impression") & p.in_country(F.col("country")))
    return with_sources(last_behind(seen.withColumn("ip", as_col(ip)), id_map), id_map)


def with_sources(last: DataFrame, id_map: DataFrame) -> DataFrame:
    """Add the source ids of each address' device: a row for each, if it has several."""
    return inner(last, id_map, "device_id").select("ip", "source_id", "device_id")


def last_behind(seen: DataFrame, id_map: DataFrame) -> DataFrame:
    """ip and device_id, one row for each address, from the impressions that tell addresses."""
    seen = seen.select("ip", "device_id", "event_time").where(F.col("ip").isNotNull())
    known = in_rel(seen, id_map, "device_id")
    return latest_per_key(known, ["ip"], [F.col("event_time").desc(), F.col("device_id")]).select("ip", "device_id")


def with_ad_id(df: DataFrame, id_map: DataFrame) -> DataFrame:
    """Add ``device_id`` to rows known by their source id; NULL where there is no mapping."""
    return lookup(df, id_map.select("source_id", "device_id"), "source_id")
