"""Daily activity profile per user, from user-domain rows and broadband flow rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .enrich import UNKNOWN, with_app, with_district, with_domain_tags
from .ranges import RangeIndex
from .topk import top_k

# Bytes per counted unit, and the length of the lists.
BYTES_WEIGHT = 2048
TOP_DOMAINS = 10
TOP_APPS = 10

TAGS = ["oneLabel", "twoLabel", "threeLabel"]


def weighted_flow(flow: DataFrame) -> DataFrame:
    """Flow rows with their hour of day as ``HH`` and real bytes."""
    return flow.withColumns(
        {
            "hour": F.date_format(F.timestamp_seconds("timestamp"), "HH"),
            "bytes": F.col("bytes") * BYTES_WEIGHT,
        }
    )


def flow_base(flow: DataFrame, apps: RangeIndex) -> DataFrame:
    return with_app(weighted_flow(flow), apps)


def user_domain_sums(rows: DataFrame) -> DataFrame:
    """Lookups per user and domain: all that the profile needs of the user-domain rows."""
    return rows.groupBy("userName", "domain").agg(F.sum("resolver").alias("resolver"))


def flow_sums(flow: DataFrame) -> DataFrame:
    """Bytes per client, hour, source and app: all that the profile needs of the flow rows."""
    return flow.groupBy("clientName", "hour", "sourceIp", "appName").agg(F.sum("bytes").alias("bytes"))


def user_total(rows: DataFrame) -> DataFrame:
    return rows.groupBy("userName").agg(F.sum("resolver").alias("resolver"))


def distinct_user_domain(rows: DataFrame) -> DataFrame:
    return rows.select("userName", "domain").distinct()


def user_tags(pairs: DataFrame, tags: DataFrame, auth_domain: DataFrame) -> DataFrame:
    """Known labels of a user's domains, where the third label is known; where it is none, a site's name stands for it."""
    labelled = with_domain_tags(pairs, tags, auth_domain).where(F.col("threeLabel") != UNKNOWN)
    label = labelled.select("userName", F.explode(F.array(*TAGS)).alias("tag")).where(F.col("tag") != UNKNOWN)
    return label.groupBy("userName").agg(F.sort_array(F.collect_set("tag")).alias("tags"))


def user_bytes(flow: DataFrame) -> DataFrame:
    return flow.groupBy("clientName").agg(F.sum("bytes").alias("bytes"))


# Addresses that share a mask, one bit each.
_WIDTH = 64


def _masked(source: str) -> dict[str, Column]:
    """A source as block, part of the block and a bit; texts that do not end in an octet are a block of their own."""
    text = F.col(source)
    last = F.substring_index(text, ".", -1)
    octet = last.try_cast("int")
    plain = F.coalesce(text.contains(".") & (octet.cast("string") == last) & octet.between(0, 255), F.lit(False))
    bit = F.expr(f"shiftleft(1L, try_cast(substring_index({source}, '.', -1) AS INT) % {_WIDTH})")
    return {
        "block": F.when(plain, F.substr(text, F.lit(1), F.length(text) - F.length(last) - 1)).otherwise(text),
        "part": F.when(plain, F.floor(octet / _WIDTH).cast("int")).otherwise(-1),
        "mask": F.when(plain, bit).when(text.isNotNull(), F.lit(1).cast("bigint")),
    }


def source_masks(flow: DataFrame, by: list[str]) -> DataFrame:
    """The sources seen and the bytes per group, as masks of 64 neighbouring addresses.

    Masks are exact and can be merged: those of a day are the unions of its hours' (:func:`merge_masks`).
    """
    keys = [*by, "block", "part"]
    return flow.withColumns(_masked("sourceIp")).groupBy(*keys).agg(F.bit_or("mask").alias("mask"), F.sum("bytes").alias("bytes"))


def merge_masks(masks: DataFrame, by: list[str]) -> DataFrame:
    return masks.groupBy(*by, "block", "part").agg(F.bit_or("mask").alias("mask"), F.sum("bytes").alias("bytes"))


def points(masks: DataFrame, by: list[str]) -> DataFrame:
    """Distinct sources and bytes per group."""
    seen = F.coalesce(F.sum(F.bit_count("mask")), F.lit(0).cast("bigint"))
    return masks.groupBy(*by).agg(F.sum("bytes").alias("bytes"), seen.alias("points"))


def hour_points(flow: DataFrame) -> DataFrame:
    """Sources seen per client and hour."""
    by = ["clientName", "hour"]
    return points(source_masks(flow, by), by).drop("bytes")


def hour_bytes(flow: DataFrame) -> DataFrame:
    """Bytes per client and hour, divided by the sources seen: one pass yields both numbers."""
    by = ["clientName", "hour"]
    both = points(source_masks(flow, by), by)
    # Rows without a source count as one point.
    seen = F.greatest(F.col("points"), F.lit(1))
    return both.select("clientName", "hour", "points", F.call_function("div", "bytes", seen).alias("byte"))


def day_curve(flow: DataFrame) -> DataFrame:
    """Per client the list of ``{hour, byte}``, at most 24 long."""
    point = F.struct(F.col("hour").cast("int").alias("hour"), "byte")
    return hour_bytes(flow).groupBy("clientName").agg(F.sort_array(F.collect_list(point)).alias("byte"))


def _ordered_list(rows: DataFrame, user: str, fields: list[str], name: str) -> DataFrame:
    entry = F.struct("_rank", *fields)
    listed = rows.groupBy(user).agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    shown = F.transform("_list", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return listed.select(user, shown.alias(name))


def top_domains(rows: DataFrame, tags: DataFrame, auth_domain: DataFrame, k: int = TOP_DOMAINS) -> DataFrame:
    """Per user the busiest domains in order, with their known labels."""
    kept = top_k(user_domain_sums(rows), ["userName"], [F.desc("resolver"), F.asc("domain")], k, rank="_rank")
    known = F.array_remove(F.array_distinct(F.array(*TAGS)), UNKNOWN)
    labelled = with_domain_tags(kept, tags, auth_domain).withColumn("tags", known)
    return _ordered_list(labelled, "userName", ["domain", "resolver", "tags"], "domains")


def top_apps(flow: DataFrame, k: int = TOP_APPS) -> DataFrame:
    """Per client the apps with the most bytes, in order."""
    summed = (
        flow.where(F.col("appName") != "").groupBy("clientName", "appName").agg(F.sum("bytes").alias("byte"))
    )
    kept = top_k(summed, ["clientName"], [F.desc("byte"), F.asc("appName")], k, rank="_rank")
    return _ordered_list(kept.withColumnRenamed("appName", "app"), "clientName", ["app", "byte"], "apps")


def combine(parts: list[DataFrame]) -> DataFrame:
    """Full outer join of frames with one row per ``userName``, as a union and one aggregate: a single shuffle."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [c for c in stacked.columns if c != "userName"]
    return stacked.groupBy("userName").agg(*[F.any_value(c, F.lit(True)).alias(c) for c in values])


def profile(
    sums: DataFrame,
    flow: DataFrame,
    tags: DataFrame,
    auth_domain: DataFrame,
    district: DataFrame,
    day: str,
    accesstime: int,
) -> DataFrame:
    """The profile document per user, from :func:`user_domain_sums` and :func:`flow_sums`."""

    def of_user(part: DataFrame) -> DataFrame:
        return part.withColumnRenamed("clientName", "userName")

    parts = [
        top_domains(sums, tags, auth_domain),
        user_total(sums),
        user_tags(sums.select("userName", "domain"), tags, auth_domain),
        of_user(user_bytes(flow)),
        of_user(top_apps(flow)),
        of_user(day_curve(flow)),
    ]
    whole = with_district(combine(parts), district)
    lists = {c: F.coalesce(F.col(c), F.array().cast(whole.schema[c].dataType)) for c in ("domains", "tags", "apps", "byte")}
    numbers = {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("resolver", "bytes")}
    return whole.withColumns(
        {
            **lists,
            **numbers,
            "rids": F.array("rid1", "rid2", "rid3", "rid4"),
            "accesstime": F.lit(accesstime).cast("bigint"),
            "id": F.concat(F.lit(day + "_"), F.col("userName")),
        }
    ).select("id", "accesstime", F.col("userName").alias("username"), "domains", "resolver", "tags", "bytes", "apps", "byte", "rids")
