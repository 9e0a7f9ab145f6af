"""NAT flow totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bucket_day, bucket_hour


def nat_hour(flow: DataFrame, dedupe: bool = True) -> DataFrame:
    """Counts per hour, type and address. ``dedupe`` counts equal counts of a key once per hour, as the reports do."""
    day = bucket_day(F.col("accesstime"))
    keyed = flow.select(
        bucket_hour(F.col("accesstime")).alias("hour"),
        day.alias("day"),
        "types",
        "data",
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )
    counted = keyed.distinct() if dedupe else keyed
    summed = counted.groupBy("hour", "day", "types", "data").agg(F.sum("count").alias("count"))
    return summed.select(
        "hour",
        (F.col("day") * 1000).alias("accesstime"),
        "types",
        "data",
        "count",
        F.concat_ws("_", F.col("day").cast("string"), "types", "data").alias("key"),
    )


def add_running(new: DataFrame, previous: DataFrame, key: str = "key", measure: str = "count") -> DataFrame:
    """Add the previous total of the same key, if there is one."""
    before = previous.groupBy(key).agg(F.sum(measure).alias("_before"))
    total = F.col(measure) + F.coalesce(F.col("_before"), F.lit(0))
    return new.join(before, key, "left").withColumn(measure, total).drop("_before")


def nat_day(lines: DataFrame) -> DataFrame:
    """Counts per day and destination address."""
    daily = lines.withColumn("accesstime", bucket_day(F.col("ts")) * 1000)
    return (
        daily.groupBy("accesstime", F.col("ip").alias("data"))
        .agg(F.sum("count").alias("count"))
        .withColumn("types", F.lit("destinationIp"))
    )
