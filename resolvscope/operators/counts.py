"""Five-minute count reports.

Each report exists per client and for all clients (``clientName = 0``). The rows are aggregated once, per client; the
total is a second aggregate over that small result, so the log itself is never expanded. Rows carry their lookups in
``resolver``: 1 for a log row, more for rows that were summed before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import window_end
from ..functions.times import FIVE_MINUTES
from .enrich import with_online_user

ALL_CLIENTS = 0

# Report name -> its dimensions.
COUNT_REPORTS = {
    "requestType": ["requestType"],
    "responseType": ["responseType"],
    "responseCode": ["responseCode"],
    "dnsIp": ["dnsIp"],
    "province": ["province"],
    "operator": ["operator"],
}


def at_window(rows: DataFrame, seconds: int = FIVE_MINUTES, column: str = "logTimestamp") -> DataFrame:
    """Add ``accesstime``, the end of the row's interval in epoch seconds."""
    return rows.withColumn("accesstime", window_end(F.col(column), seconds))


def add_totals(per_client: DataFrame, dims: Sequence[str], sums: Sequence[str], time: str = "accesstime") -> DataFrame:
    """Append the all-clients rows to an aggregate that has one row per client and dimensions."""
    keys = [time, "clientName", *dims]
    every = [time, *dims]
    client = F.when(F.grouping("clientName") == 1, ALL_CLIENTS).otherwise(F.col("clientName"))
    return (
        per_client.groupingSets([[F.col(k) for k in keys], [F.col(k) for k in every]], *[F.col(k) for k in keys])
        .agg(client.cast("int").alias("_client"), *[F.sum(s).alias(s) for s in sums])
        .select(time, F.col("_client").alias("clientName"), *dims, *sums)
    )


def count_by(rows: DataFrame, types: str, dims: Sequence[str]) -> DataFrame:
    """Lookups by dimensions, per client and in total."""
    per_client = rows.groupBy("accesstime", "clientName", *dims).agg(F.sum("resolver").alias("number"))
    return add_totals(per_client, dims, ["number"]).withColumn("types", F.lit(types))


def count_report(rows: DataFrame, types: str) -> DataFrame:
    return count_by(rows, types, COUNT_REPORTS[types])


def qps(rows: DataFrame, seconds: int = FIVE_MINUTES) -> DataFrame:
    """Lookups and errors per interval, the rate per second and the document key."""
    per_client = rows.groupBy("accesstime", "clientName").agg(
        F.sum("resolver").alias("number"), F.sum("error").alias("error")
    )
    return add_totals(per_client, [], ["number", "error"]).withColumns(
        {
            "types": F.lit("qps"),
            "avgNum": F.floor(F.col("number") / seconds).cast("bigint"),
            "key": F.concat(F.col("accesstime").cast("string"), F.lit("qps_"), F.col("clientName").cast("string")),
        }
    )


def business(detail: DataFrame) -> DataFrame:
    """Lookups by business resource over the detail rows; the printed properties carry the type."""
    dims = ["resourceName", "resourceType", "resourceProps"]
    counted = count_by(detail, "business", dims)
    return counted.withColumn("resourceProps", F.concat_ws("/", "resourceType", "resourceProps"))


def user_domains(rows: DataFrame, online: DataFrame) -> DataFrame:
    """Lookups per address and domain, under the name of the user behind the address."""
    counted = rows.groupBy("accesstime", "clientIp", "domain").agg(F.sum("resolver").alias("resolver"))
    return with_online_user(counted, online).select("accesstime", "userName", "domain", "resolver")
