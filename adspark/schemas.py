"""Declared schemas of the inputs and of the tables this package writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_TYPES = {
    "str": T.StringType(), "int": T.LongType(), "float": T.DoubleType(), "bool": T.BooleanType(),
    "date": T.DateType(), "ts": T.TimestampNTZType(), "ids": T.ArrayType(T.StringType()),
}


def schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# One row per ad-server event: impression, click, tracker (video progress) or segment (web pixel).
DELIVERY = schema(
    event="str", event_time="ts", device_id="int", device_ids="ids", ip="str", campaign_id="int",
    flight_id="int", creative_id="int", segment_id="int", tracker="str", country="str",
    dropped="bool", exchange_id="int", seller_id="str", partition_time="ts")
SESSIONS = schema(
    source_id="str", app_id="str", country="str", start_time="ts", end_time="ts", partition_time="ts")
APP_OPENS = schema(
    source_id="str", app_id="str", country="str", event_time="ts", partition_time="ts")
HARDWARE = schema(source_id="str", country="str", partition_time="ts")
VOICE_EVENTS = schema(
    source_id="str", category="str", payload="str", country="str", partition_time="ts")
ID_MAP = schema(source_id="str", device_id="int")
APP_DICTIONARY = schema(product_name="str", app_id="str")
SUBSCRIBERS = schema(source_id="str")
CONTROL = schema(source_id="str")
CREATIVE_MAPPING = schema(
    advertiser_name="str", product_country="str", country="str", target_country="str",
    region="str", order_number="int", campaign_id="int", campaign_name="str", flight_id="int",
    flight_name="str", flight_start="ts", flight_end="ts", line_item_id="int",
    line_item_name="str", creative_name="str", creative_id="int", line_item_start="ts",
    line_item_end="ts", advertiser_id="int", order_name="str", campaign_start="date",
    campaign_end="date", rate_type="str", rate="float", booked_budget="float",
    booked_impressions="int", budget_delivered="float", last_update="ts")
MAPPING_CSV = schema(
    country="str", order_number="int", line_item_name="str", campaign_start="str",
    campaign_end="str", campaign_name="str", campaign_id="int", flight_name="str",
    flight_id="int", creative_name="str", creative_id="int", target_country="str",
    line_item_id="int", impressions="int")
CAMPAIGN_META = schema(
    order_number="int", crm_campaign_id="str", sales_order_id="int", sales_order_name="str",
    order_start="date", order_end="date", campaign_id="int", campaign_name="str", rate_type="str",
    net_unit_cost="float", campaign_start="ts", campaign_end="ts", flight_id="int",
    flight_name="str", flight_start="ts", flight_end="ts", creative_id="int", creative_name="str",
    line_item_id="int", line_item_name="str", line_item_start="ts", line_item_end="ts",
    product_id="int", product_name="str")
CAMPAIGN_META_CSV = schema(**{f.name: "str" for f in CAMPAIGN_META})
REGIONAL_EXPOSURE = schema(
    order_number="int", device_id="int", exposure_time="ts", country="str", campaign_id="int",
    creative_id="int", flight_id="int", event="str", date_imported="date")
REGIONAL_USAGE = schema(
    device_id="int", usage_time="ts", country="str", app_id="str", minutes="int",
    usage_count="int", date_imported="date")


def conform(df: DataFrame, target: T.StructType, lenient: bool = False) -> DataFrame:
    """Select and cast to ``target``; columns the input lacks become NULL.

    With ``lenient`` a value that cannot be cast becomes NULL instead of failing the job.
    """
    present = set(df.columns)

    def cast(f: T.StructField):
        if f.name not in present:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        return (c.try_cast(f.dataType) if lenient else c.cast(f.dataType)).alias(f.name)

    return df.select(*[cast(f) for f in target])


def empty_like(spark: SparkSession, target: T.StructType) -> DataFrame:
    return spark.createDataFrame([], target)
