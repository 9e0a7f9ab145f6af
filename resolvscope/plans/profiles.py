"""The daily activity profile job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile
from ..operators.clean import keep_user_domains
from ..operators.enrich import app_index
from ..functions import bucket_hour
from ..sinks.tables import INTERVAL, append_report, touched_partitions, upsert, with_day
from .five_minute import Keep, persisting


def build(
    user_domains: DataFrame,
    flows: DataFrame,
    app_rule: DataFrame,
    tags: DataFrame,
    auth_domain: DataFrame,
    district: DataFrame,
    day: str,
    accesstime: int,
    minimum: int = 1,
    keep: Keep = lambda df: df,
) -> DataFrame:
    """Profiles of one day. The inputs are summed once each; ``keep`` lets a job persist the sums."""
    sums = keep(profile.user_domain_sums(keep_user_domains(user_domains, minimum)))
    flow = keep(profile.flow_sums(profile.flow_base(flows, app_index(app_rule))))
    return profile.profile(sums, flow, tags, auth_domain, district, day, accesstime)


def run(
    spark: SparkSession, target: str, user_domains: DataFrame, flows: DataFrame, *lookups: DataFrame, day: str, accesstime: int
) -> None:
    """Build the profiles of a day and upsert them. Errors are not caught: a failed day must be seen."""
    with persisting() as keep:
        people = build(user_domains, flows, *lookups, day=day, accesstime=accesstime, keep=keep)
        upsert(spark, with_day(people), target, "id")


SOURCES = "source_hour"


def store_sources(flow: DataFrame, root: str) -> None:
    """Store which sources each client used in the whole hours of ``flow``; an hour that runs again replaces its own rows."""
    with persisting() as keep:
        masks = profile.source_masks(flow.withColumn("hour", bucket_hour(F.col("timestamp"))), ["clientName", "hour"])
        dated = keep(with_day(masks, "hour").withColumn("interval", F.col("hour")))
        append_report(dated, f"{root}/{SOURCES}", INTERVAL, dated.select(*INTERVAL).distinct().count())


def day_points(spark: SparkSession, root: str, days: list[int]) -> DataFrame:
    """Distinct sources and bytes per client and day, from the stored hours of the days alone: at most 24 masks a block."""
    by = ["clientName", "dt"]
    stored = touched_partitions(spark.read.parquet(f"{root}/{SOURCES}"), ("dt",), [(d,) for d in days])
    return profile.points(profile.merge_masks(stored, by), by)
