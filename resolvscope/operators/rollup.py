"""Hourly, six-hourly and daily rollups of report tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bucket_6h, bucket_day, bucket_hour
from ..functions.times import FIVE_MINUTES

BUCKETS = {"hh": bucket_hour, "6h": bucket_6h, "dd": bucket_day}
# An hour and six hours are means of the intervals present; a day is a sum.
MEANS = {"hh", "6h"}


@dataclass(frozen=True)
class Family:
    """A report and how it rolls up. The six-hour grain reads the hourly table, so it averages rounded averages."""

    dims: tuple[str, ...]
    grains: tuple[str, ...] = ("hh", "6h", "dd")
    measures: tuple[str, ...] = ("number",)


FAMILIES = {
    "requestType": Family(("requestType",)),
    "responseCode": Family(("responseCode",)),
    "responseType": Family(("responseType",)),
    "qps": Family((), measures=("number", "error")),
    "responseCodeDomain": Family(("responseCode", "domain"), ("hh", "6h")),
    "responseCodeClientIP": Family(("responseCode", "clientIp"), ("hh", "6h")),
    "province": Family(("province",)),
    "operator": Family(("operator",)),
    "business": Family(("resourceName", "resourceType", "resourceProps")),
    "dnsIp": Family(("dnsIp",)),
    "user": Family(
        ("userName", "clientIp", "domain", "phone", "address"), ("hh",), measures=("number", "inNet", "error")
    ),
    "trend": Family(
        ("domain", "authorityDomain", "aip", "websiteType", "soft", "websiteName", "companyName"),
        ("hh", "6h"),
        measures=("inNet", "error", "resolver"),
    ),
}


def rollup(rows: DataFrame, dims: Sequence[str], grain: str, measures: Sequence[str] = ("number",)) -> DataFrame:
    """Aggregate report rows of one type to a grain. Numbers stored as text are read as numbers."""
    combine = F.avg if grain in MEANS else F.sum

    def rounded(measure: str) -> Column:
        return F.ceil(combine(F.col(measure).try_cast("double"))).cast("bigint").alias(measure)

    bucket = BUCKETS[grain](F.col("accesstime"))
    return (
        rows.withColumn("accesstime", bucket)
        .groupBy("accesstime", "clientName", *dims)
        .agg(*[rounded(m) for m in measures])
    )


def rollup_qps(rows: DataFrame, grain: str, seconds: int = FIVE_MINUTES) -> DataFrame:
    """Rate rollup. ``avgNum`` divides the unrounded mean, or for a day the sum, by the interval length."""
    combine = F.avg if grain in MEANS else F.sum
    number = combine(F.col("number").try_cast("double"))
    bucket = BUCKETS[grain](F.col("accesstime"))
    return (
        rows.withColumn("accesstime", bucket)
        .groupBy("accesstime", "clientName")
        .agg(
            F.ceil(number).cast("bigint").alias("number"),
            F.ceil(combine(F.col("error").try_cast("double"))).cast("bigint").alias("error"),
            F.floor(number / seconds).cast("bigint").alias("avgNum"),
        )
    )


def roll_report(rows: DataFrame, types: str, grain: str) -> DataFrame:
    """Roll one report family: ``rows`` is the five-minute table, or the hourly table for ``6h``."""
    family = FAMILIES[types]
    if grain not in family.grains:
        raise ValueError(f"{types} has no {grain} rollup")
    rolled = rollup_qps(rows, grain) if types == "qps" else rollup(rows, family.dims, grain, family.measures)
    return rolled.withColumn("types", F.lit(types))
