"""Exact top-k lists with a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import authority_domain
from .counts import ALL_CLIENTS
from .enrich import Lookups, with_contact, with_innet, with_online_user

# Parts of a group that are ranked before the group as a whole, round by round. Each map task first cuts its rows to k in a
# part, so one round bounds what the last one sees, and a second would only shuffle again.
SALTS = (32,)

# Default sizes.
DOMAINS_PER_CODE = 5000
ADDRESSES_PER_CODE = 500
USER_ROWS = 20_000
USER_ERRORS = 100
USER_MINIMUM = 50
USER_CLIENT = 1


def top_k(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None, salts: Sequence[int] = SALTS
) -> DataFrame:
    """The first ``k`` rows of each group. ``order`` must be total.

    The list is found first within salted parts of a group, then in the group, which by then has at most ``32 k`` rows. No
    task ever sorts a whole hot group, and rows that are in no part's list are shuffled at most once.
    """
    name = rank or "_rank"
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    rows = rows.withColumn("_salt", spread)
    for parts in salts:
        part = Window.partitionBy(*group, F.pmod(F.col("_salt"), F.lit(parts))).orderBy(*order)
        rows = rows.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= k).drop("_rank")
    rows = rows.drop("_salt")
    whole = Window.partitionBy(*group).orderBy(*order)
    ranked = rows.withColumn(name, F.row_number().over(whole)).where(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def by_number(*ties: str) -> list[Column]:
    return [F.desc("number"), *[F.asc(t) for t in ties]]


def _code_group(per_client: bool) -> list[str]:
    return ["accesstime", "responseCode", *(["clientName"] if per_client else [])]


def _finish(rows: DataFrame, per_client: bool, types: str) -> DataFrame:
    named = rows if per_client else rows.withColumn("clientName", F.lit(ALL_CLIENTS))
    return named.withColumn("types", F.lit(types))


def top_by_code(rows: DataFrame, item: str, types: str, k: int, per_client: bool = False) -> DataFrame:
    """Busiest domains or asking addresses of each response code, in total or per client."""
    group = _code_group(per_client)
    counted = rows.groupBy(*group, item).agg(F.sum("resolver").alias("number"))
    return _finish(top_k(counted, group, by_number(item), k), per_client, types)


def top_domains(rows: DataFrame, k: int = DOMAINS_PER_CODE, per_client: bool = False) -> DataFrame:
    return top_by_code(rows, "domain", "responseCodeDomain", k, per_client)


def top_addresses(rows: DataFrame, k: int = ADDRESSES_PER_CODE, per_client: bool = False) -> DataFrame:
    return top_by_code(rows, "clientIp", "responseCodeClientIP", k, per_client)


def top_authorities(domains: DataFrame, k: int = DOMAINS_PER_CODE, per_client: bool = False) -> DataFrame:
    """Authority domains of the rows that :func:`top_domains` kept."""
    group = _code_group(per_client)
    named = domains.select(*group, "number", authority_domain(F.col("domain")).alias("authorityDomain"))
    summed = named.groupBy(*group, "authorityDomain").agg(F.sum("number").alias("number"))
    ranked = top_k(summed, group, by_number("authorityDomain"), k)
    return _finish(ranked, per_client, "responseCodeAuthorityDomain")


def top_user_rows(
    rows: DataFrame, lookups: Lookups, k: int = USER_ROWS, minimum: int = USER_MINIMUM, client: int = USER_CLIENT
) -> DataFrame:
    """Busiest (address, domain, answer) rows of one client per interval, with in-net count, user and contact."""
    keys = ["accesstime", "clientName", "clientIp", "domain", "aip"]
    summed = (
        rows.where(F.col("clientName") == client)
        .groupBy(*keys)
        .agg(F.sum("resolver").alias("number"), F.sum("error").alias("error"))
        .where(F.col("number") > minimum)
    )
    kept = top_k(summed, ["accesstime"], by_number("clientIp", "domain", "aip"), k)
    flagged = with_innet(kept, lookups.innet_flags, counted="number")
    return with_contact(with_online_user(flagged, lookups.online_user, keep_all=True), lookups.user_contact)


def top_user_errors(user_rows: DataFrame, k: int = USER_ERRORS) -> DataFrame:
    """The interval rows with the most errors."""
    order = [F.desc("error"), F.desc("number"), F.asc("clientIp"), F.asc("domain"), F.asc("aip")]
    ranked = top_k(user_rows, ["accesstime"], order, k)
    return ranked.withColumn("types", F.lit("user")).select(
        "types", "clientName", "clientIp", "userName", "phone", "address", "domain", "number", "accesstime", "error", "inNet"
    )
