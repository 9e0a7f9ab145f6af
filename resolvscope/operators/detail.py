"""Detail rows: the busiest (client, domain, server, answer) keys of an interval, enriched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import in_top_sites, md5_key, strip_scheme
from .enrich import (
    BUSINESS,
    GEO_METRICS,
    SITE,
    Lookups,
    with_business,
    with_geo_metrics,
    with_innet,
    with_site,
    with_whitelist,
)
from .topk import top_k

# Default sizes.
DETAIL_ROWS = 70_000
DETAIL_MINIMUM = 10
WHITELIST_BONUS = 10
TREND_MINIMUM = 100
SITE_MINIMUM = 100

FOUR_KEYS = ["clientName", "domain", "dnsIp", "aip"]
DETAIL_COLUMNS = [
    "clientName",
    "authorityDomain",
    "dnsIp",
    "aip",
    "domain",
    "resolver",
    "inNet",
    "error",
    "accesstime",
    *SITE,
    *BUSINESS,
    *GEO_METRICS,
    "aIpAddr",
]


def four_key(rows: DataFrame) -> DataFrame:
    return rows.groupBy("accesstime", *FOUR_KEYS).agg(
        F.sum("resolver").alias("resolver"), F.sum("error").alias("error")
    )


def boosted(summed: DataFrame, whitelist: DataFrame, bonus: int = WHITELIST_BONUS) -> DataFrame:
    """Add ``boosted``: the lookups plus a bonus for listed domains. Only the choice of rows uses it."""
    marked = with_whitelist(summed, whitelist)
    gain = F.when(F.col("listed"), bonus).otherwise(0).cast("bigint")
    return marked.withColumn("boosted", F.col("resolver") + gain)


def top_detail(
    rows: DataFrame,
    lookups: Lookups,
    k: int = DETAIL_ROWS,
    minimum: int = DETAIL_MINIMUM,
    bonus: int = WHITELIST_BONUS,
) -> DataFrame:
    """Busiest detail keys per interval, with their business resource."""
    kept = boosted(four_key(rows), lookups.whitelist, bonus).where(F.col("boosted") >= minimum)
    order = [F.desc("boosted"), *[F.asc(c) for c in FOUR_KEYS]]
    ranked = top_k(kept, ["accesstime"], order, k).drop("listed", "boosted")
    return with_business(ranked, lookups.resources)


def enrich_detail(top: DataFrame, lookups: Lookups) -> DataFrame:
    """Detail rows with in-net, site and geography columns."""
    flagged = with_innet(top, lookups.innet_flags)
    placed = with_geo_metrics(flagged, lookups.places)
    sited = with_site(placed, lookups.auth_domain)
    return sited.withColumn("domain", strip_scheme(F.col("domain"))).select(*DETAIL_COLUMNS)


def trend(detail: DataFrame, minimum: int = TREND_MINIMUM) -> DataFrame:
    """Interval trend per client, domain, answer and site; only busy rows."""
    keys = [
        "accesstime", "clientName", "domain", "aip", "companyName", "authorityDomain", "soft", "websiteName", "websiteType"
    ]
    summed = detail.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("resolver", "inNet", "error")])
    key = F.concat(F.col("accesstime").cast("string"), md5_key("domain", "aip", "clientName"))
    return summed.where(F.col("resolver") > minimum).withColumn("key", key)


def top_site_rows(rows: DataFrame, lookups: Lookups, minimum: int = SITE_MINIMUM, sites: list[str] | None = None) -> DataFrame:
    """Busy detail keys of the twenty busiest sites, with their business resource."""
    chosen = in_top_sites(F.col("domain"), sites) if sites else in_top_sites(F.col("domain"))
    summed = four_key(rows.where(chosen)).where(F.col("resolver") > minimum)
    return with_business(summed, lookups.resources)
