"""Day totals of the detail rows and the per-domain summaries built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bucket_day, bucket_hour, md5_key
from ..functions.times import day_text

COUNTERS = ["resolver", "inNet", "error", "abroadNum", "telecomNum", "linkNum", "gatNum"]
# In key order.
DIMENSIONS = [
    "clientName", "authorityDomain", "dnsIp", "aip", "domain",
    "websiteName", "creditCode", "companyType", "companyName", "companyAddr",
    "onRecord", "websiteType", "soft", "resourceName", "resourceType", "resourceProps", "aIpAddr",
]
DOMAIN_KEY = [
    "authorityDomain", "domain", "websiteName", "creditCode", "companyType", "companyName",
    "companyAddr", "onRecord", "websiteType", "soft",
]
# What a domain summary shows of its busiest row.
REPRESENTATIVE = [c for c in DIMENSIONS if c not in ("clientName", "domain", "resourceType")]
USER_KEY = ["clientName", "userName", "domain", "clientIp"]
RESOURCE = ["resolver", "inNet", "error", "resourceType", "resourceName", "resourceProps"]


def dated_key(day: Column, *parts: Column | str) -> Column:
    return F.concat(day_text(day), F.lit("_"), md5_key(*parts))


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in COUNTERS]


def hour_totals(detail: DataFrame) -> DataFrame:
    """Counters per hour and full detail key; ``key`` names the day document the row belongs to."""
    hourly = detail.withColumn("hour", bucket_hour(F.col("accesstime")))
    summed = hourly.groupBy("hour", *DIMENSIONS).agg(*_sums()).withColumn("accesstime", bucket_day(F.col("hour")))
    return summed.withColumn("key", dated_key(F.col("accesstime"), *DIMENSIONS))


def day_totals(detail: DataFrame) -> DataFrame:
    """Counters per day and full detail key."""
    daily = detail.withColumn("accesstime", bucket_day(F.col("accesstime")))
    summed = daily.groupBy("accesstime", *DIMENSIONS).agg(*_sums())
    return summed.withColumn("key", dated_key(F.col("accesstime"), *DIMENSIONS))


def running_day_totals(hourly: DataFrame) -> DataFrame:
    """Day-to-date counters after each hour, for the keys seen in that hour. A day has at most 24 rows per key."""
    so_far = Window.partitionBy("accesstime", "key").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return hourly.withColumns({c: F.sum(c).over(so_far) for c in COUNTERS})


def merge_hours(hourly: DataFrame) -> DataFrame:
    """Day totals from hour totals: at most 24 rows a key."""
    return hourly.groupBy("accesstime", *DIMENSIONS, "key").agg(*_sums())


def domain_types(day: DataFrame, per_client: bool = False, time: Sequence[str] = ("accesstime",)) -> DataFrame:
    """Counters per domain and resource type, with the attributes of the busiest row."""
    keys = [*time, "domain", "resourceType", *(["clientName"] if per_client else [])]
    busiest = F.max_by(F.struct(*[F.col(c) for c in REPRESENTATIVE], "key"), F.struct("resolver", "key"))
    top = F.max(F.struct("resolver", "key"))
    return day.groupBy(*keys).agg(*_sums(), busiest.alias("rep"), top.alias("_top"))


def flatten_types(types: DataFrame) -> DataFrame:
    return types.select(*[c for c in types.columns if c not in ("rep", "_top")], "rep.*")


def domain_totals(types: DataFrame, per_client: bool = False, nest: bool = False, time: Sequence[str] = ("accesstime",)) -> DataFrame:
    """Counters per domain over its resource types, with the document key and the busiest row's attributes.

    It aggregates the output of :func:`domain_types`, so the day is read once and no join brings the types back;
    ``nest`` adds them as a list. A domain has no more types than there are companies.
    """
    keys = [*time, "domain", *(["clientName"] if per_client else [])]
    resources = F.struct(*[F.col(c) if c in types.columns else F.col(f"rep.{c}").alias(c) for c in RESOURCE])
    nested = [F.sort_array(F.collect_list(resources)).alias("resourceTypes")] if nest else []
    summed = types.groupBy(*keys).agg(*_sums(), F.max_by("rep", "_top").alias("rep"), *nested)
    client = F.col("clientName") if per_client else F.lit(0)
    named = summed.select(
        *time,
        client.alias("clientName"),
        "domain",
        *COUNTERS,
        *[F.col(f"rep.{c}").alias(c) for c in REPRESENTATIVE],
        F.col("rep.key").alias("oldKey"),
        *(["resourceTypes"] if nest else []),
    )
    return named.withColumn("key", dated_key(F.col(time[0]), "clientName", *DOMAIN_KEY)).select(
        "key",
        *time,
        "clientName",
        "authorityDomain",
        "aip",
        "dnsIp",
        "domain",
        *COUNTERS,
        "oldKey",
        *(["resourceTypes"] if nest else []),
    )


def nested_domains(day: DataFrame, per_client: bool = False, time: Sequence[str] = ("accesstime",)) -> DataFrame:
    return domain_totals(domain_types(day, per_client, time), per_client, nest=True, time=time)


def innet_domains(day: DataFrame) -> DataFrame:
    """One in-net answer address per domain."""
    rank = F.struct("accesstime", "aip")
    return (
        day.where(F.col("inNet") > 0)
        .groupBy("domain")
        .agg(F.min(rank).alias("_first"))
        .select("domain", "_first.aip", "_first.accesstime", F.lit(1).alias("counts"))
    )


def user_day(user_rows: DataFrame) -> DataFrame:
    """Day totals per client, user, domain and asking address, summed from the day's interval rows.

    A contact that changes during the day does not split a total: phone and address are those of the latest interval.
    """
    daily = user_rows.withColumn("_at", F.col("accesstime")).withColumn("accesstime", bucket_day(F.col("accesstime")))
    keys = USER_KEY
    contact = F.struct("phone", "address")
    summed = (
        daily.groupBy("accesstime", *keys)
        .agg(F.max_by(contact, F.struct("_at", contact)).alias("_contact"), *[F.sum(c).alias(c) for c in ("number", "error", "inNet")])
        .select("accesstime", *keys, "_contact.phone", "_contact.address", "number", "error", "inNet")
    )
    return summed.withColumns({"types": F.lit("user"), "key": dated_key(F.col("accesstime"), *keys)})
