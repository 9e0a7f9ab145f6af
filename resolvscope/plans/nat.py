"""The NAT jobs: counts per hour with their running day totals, and counts per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nat
from ..sinks.tables import INTERVAL, append_report, touched_partitions, upsert, with_day
from .five_minute import persisting


def run_hours(spark: SparkSession, flow: DataFrame, root: str, dedupe: bool = True, buckets: int = 1) -> None:
    """Store the hours in ``flow``, which must be whole, and upsert the totals of their days.

    Totals are sums over the stored hours, not increments: an hour that is run again replaces its own rows.
    """
    with persisting() as keep:
        hourly = keep(with_day(nat.nat_hour(flow, dedupe), "hour").withColumn("interval", F.col("hour")))
        append_report(hourly, f"{root}/nat_hour", INTERVAL, hourly.select(*INTERVAL).distinct().count())
        days = [tuple(r) for r in hourly.select("dt").distinct().collect()]
        stored = touched_partitions(spark.read.parquet(f"{root}/nat_hour"), ("dt",), days)
        totals = stored.groupBy("key", "accesstime", "types", "data", "dt").agg(F.sum("count").alias("count"))
        upsert(spark, totals, f"{root}/nat_running", "key", buckets=buckets)


def run_days(spark: SparkSession, lines: DataFrame, target: str) -> None:
    """Upsert the day counts of the addresses in ``lines``, which must hold whole days."""
    totals = nat.nat_day(lines)
    key = F.concat_ws("_", F.col("accesstime").cast("string"), "types", "data")
    dated = with_day(totals.withColumn("_at", (F.col("accesstime") / 1000).cast("bigint")), "_at").drop("_at")
    upsert(spark, dated.withColumn("key", key), target, "key")
