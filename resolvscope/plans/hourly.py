"""The hourly job: day-to-date totals and domain summaries of what the last hour touched."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import HOUR, day_text
from ..operators import daily
from ..sinks.tables import INTERVAL, append_report, upsert, with_day
from ..sources.reports import read_report
from .rollups import last_window

HOURS = "detail_hour"


def store_hours(spark: SparkSession, detail: str, root: str, begin: int, end: int) -> DataFrame:
    """Sum the detail rows of ``[begin, end)``, whole hours, and put the sums in place of those stored for the hours."""
    hours = daily.hour_totals(read_report(spark, detail, None, begin, end))
    append_report(with_day(hours, "hour").withColumn("interval", F.col("hour")), f"{root}/{HOURS}", INTERVAL)
    stored = spark.read.parquet(f"{root}/{HOURS}")
    return stored.where((F.col("interval") >= begin) & (F.col("interval") < end))


def run(spark: SparkSession, detail: str, root: str, begin: int, end: int, buckets: int = 1) -> None:
    """Upsert day totals of the keys, and summaries of the domains, that have a row in the whole hours of ``[begin, end)``.

    The detail rows of these hours only are read. Their sums are stored by hour; a day's total merges the at most 24 stored
    sums of a key, and a domain is nested again from the stored sums of its own keys. An hour that runs again, or late,
    replaces its own sums, adds nothing twice and never takes a total back. ``buckets`` cuts the days of both tables by key
    (:func:`upsert`), so that an hour of few keys rewrites a part of its day.
    """
    begin, end = begin - begin % HOUR, end + -end % HOUR
    seen = store_hours(spark, detail, root, begin, end).select("accesstime", "domain", "dt").distinct()
    stored = spark.read.parquet(f"{root}/{HOURS}").where(F.col("dt").between(*_days(spark, begin, end - 1)))
    # A summary needs all keys of its domains; those of the hour are among them.
    day = daily.merge_hours(stored.join(seen, ["accesstime", "domain", "dt"], "left_semi"))
    day = with_day(day.withColumn("updateTime", F.lit(end).cast("bigint"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        upsert(spark, day, f"{root}/detail_day", "key", buckets=buckets)
        nested = daily.nested_domains(day).unionByName(daily.nested_domains(day, per_client=True))
        upsert(spark, with_day(nested.withColumn("updateTime", F.lit(end).cast("bigint"))), f"{root}/domain_day", "key", buckets=buckets)
    finally:
        day.unpersist()


def _days(spark: SparkSession, *times: int) -> tuple[int, ...]:
    return tuple(spark.range(1).select(*[day_text(F.lit(t)).cast("int") for t in times]).first())


def run_last(spark: SparkSession, detail: str, root: str, now: int) -> None:
    """The hour before ``now``, as a schedule calls it."""
    run(spark, detail, root, *last_window(spark, "hh", now))
