"""The day job: detail day totals, in-net domains and domain summaries."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import DAY
from ..operators import daily
from ..sinks.ledger import read_committed
from ..sinks.tables import upsert, with_day
from ..sources.logs import read_if_exists

INNET = "domain string, aip string, accesstime bigint, counts int"


def run(spark: SparkSession, detail: DataFrame, root: str, state: str, now: int) -> None:
    """Upsert the day totals and domain summaries as of ``now``, and add new in-net domains to ``state``."""
    at = F.lit(now).cast("bigint")
    day = daily.day_totals(detail).withColumn("updateTime", at).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        upsert(spark, with_day(day), f"{root}/detail_day", "key")
        domains = daily.nested_domains(day).unionByName(daily.nested_domains(day, per_client=True))
        upsert(spark, with_day(domains.withColumn("updateTime", at)), f"{root}/domain_day", "key")
        known = read_if_exists(spark, state, INNET)
        added = daily.innet_domains(day).join(known.select("domain"), "domain", "left_anti")
        added.write.mode("append").parquet(state)
    finally:
        day.unpersist()


def run_users(spark: SparkSession, user_rows: DataFrame, target: str) -> None:
    """Upsert the user totals of the days in ``user_rows``. They are summed from the interval rows, so a rerun adds nothing."""
    upsert(spark, with_day(daily.user_day(user_rows)), target, "key")


def merge_user_days(spark: SparkSession, root: str, target: str, intervals: list[int]) -> None:
    """Bring the day totals of the users seen in some intervals up to date, from all committed intervals of their days.

    Only keys of the intervals are summed and merged. The sum is over stored rows, not an increment, so the same intervals
    may come again, and late.
    """
    rows = read_committed(spark, root, "user_rows")
    days = sorted({day for at in intervals for day in (at - at % DAY,)})
    at = F.col("accesstime")
    whole = rows.where(F.array_contains(F.lit(days), at - at % DAY))
    seen = rows.where(at.isin(intervals)).select((at - at % DAY).alias("_day"), *daily.USER_KEY).distinct()
    touched = whole.withColumn("_day", at - at % DAY).join(seen, ["_day", *daily.USER_KEY], "left_semi").drop("_day", "dt", "interval")
    run_users(spark, touched, target)
