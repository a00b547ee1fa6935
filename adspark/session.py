"""Settings the plans rely on. All can be set on a running session."""

from __future__ import annotations

from pyspark.sql import SparkSession

CONF = {
    # Re-plan from measured sizes: broadcast what turns out small, merge small partitions, and split
    # the partitions of a hot key in joins even where that costs a shuffle later.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in CONF.items():
        spark.conf.set(key, value)
    return spark
