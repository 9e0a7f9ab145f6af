"""Lookups that add columns to report rows.

Equality lookups carry no broadcast hint: Spark broadcasts a side below ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise sort-merges, where adaptive execution splits hot keys. It can do so only if the join shuffles both sides itself,
so the deduplicated side is dealt by another hash first (:func:`_dealt`).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import authority_domain, ip_to_long
from .clean import CLEAN_COLUMNS, UNKNOWN_CLIENT
from .ranges import RangeIndex

# Labels for what no lookup knows, and the place names the reports count.
UNKNOWN = "未知"
OTHER_APP = "其他"
HOME_COUNTRY = "中国"
TELECOM = "电信"
UNICOM = "联通"
OVERSEAS_REGIONS = ["香港", "澳门", "台湾"]
NO_CONTACT = " "

BUSINESS = ["resourceName", "resourceType", "resourceProps"]
SITE = ["websiteName", "creditCode", "companyType", "companyName", "companyAddr", "onRecord", "websiteType", "soft"]
SITE_UNKNOWN = {"companyType", "websiteType"}
PLACE = ["country", "province", "city", "operator"]
GEO_METRICS = ["abroadNum", "telecomNum", "linkNum", "gatNum"]


@dataclass(frozen=True)
class Lookups:
    """Rule and lookup frames of the five-minute job."""

    client: DataFrame
    business: DataFrame
    innet: DataFrame
    geo: DataFrame
    whitelist: DataFrame
    auth_domain: DataFrame
    online_user: DataFrame
    user_contact: DataFrame

    def prepare(self) -> Lookups:
        """Have all four range indexes built or found, at once: each is a few small jobs, so one alone leaves executors idle."""
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda name: getattr(self, name), ("clients", "resources", "innet_flags", "places")))
        return self

    @cached_property
    def clients(self) -> RangeIndex:
        return client_index(self.client)

    @cached_property
    def resources(self) -> RangeIndex:
        return business_index(self.business)

    @cached_property
    def innet_flags(self) -> RangeIndex:
        return innet_index(self.innet, self.business)

    @cached_property
    def places(self) -> RangeIndex:
        return geo_index(self.geo, PLACE)


def _or(column: str | Column, default) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value, F.lit(default))


def _dealt(dim: DataFrame, key: str) -> DataFrame:
    """A lookup side whose partitioning no join on ``key`` can reuse, so that a hot key of the rows can be split."""
    return dim.repartition(F.xxhash64(key))


def last_per_key(dim: DataFrame, key: str, values: list[str], order: str | None = None) -> DataFrame:
    """One row per key: the last by ``order``, or the greatest values where the table has no order."""
    rank = F.struct(*([F.col(order)] if order else []), *[F.col(v) for v in values])
    last = dim.groupBy(key).agg(F.max(rank).alias("_last"))
    return _dealt(last, key).select(key, *[F.col("_last")[v].alias(v) for v in values])


def _matched(rows: DataFrame, index: RangeIndex, ip: str) -> DataFrame:
    return index.match(rows.withColumn("_ip", ip_to_long(F.col(ip))), "_ip").drop("_ip")


def client_index(rules: DataFrame) -> RangeIndex:
    """Client rules: the first rule wins."""
    named = rules.withColumn("clientName", F.col("client_type_id"))
    return RangeIndex.build(named, ["clientName"], lo="min_long_ip", hi="max_long_ip", keep="first")


def with_client(rows: DataFrame, clients: RangeIndex, ip: str = "clientIp") -> DataFrame:
    """Client of the asking address."""
    return _matched(rows, clients, ip).withColumn("clientName", _or("clientName", UNKNOWN_CLIENT))


def business_index(rules: DataFrame) -> RangeIndex:
    """Business rules: the last rule wins."""
    named = rules.select(
        "min_long_ip",
        "max_long_ip",
        "ord",
        F.col("s_id").cast("string").alias("resourceName"),
        F.col("company_id").cast("string").alias("resourceType"),
        F.col("resource_id").cast("string").alias("resourceProps"),
    )
    return RangeIndex.build(named, BUSINESS, lo="min_long_ip", hi="max_long_ip")


def with_business(rows: DataFrame, resources: RangeIndex, ip: str = "aip") -> DataFrame:
    """Resource name, type and properties of the answer address."""
    return _matched(rows, resources, ip).withColumns({c: _or(c, "") for c in BUSINESS})


def innet_ranges(innet: DataFrame, business: DataFrame) -> DataFrame:
    """Ranges that count as in-net: those of both tables, but none if the in-net table is empty."""
    bounds = ["min_long_ip", "max_long_ip"]
    counted = business.select(*bounds).where(innet.exists())
    return innet.select(*bounds).unionByName(counted).withColumns({"ord": F.lit(0), "_innet": F.lit(True)})


def innet_index(innet: DataFrame, business: DataFrame) -> RangeIndex:
    return RangeIndex.build(innet_ranges(innet, business), ["_innet"], lo="min_long_ip", hi="max_long_ip")


def with_innet(rows: DataFrame, flags: RangeIndex, ip: str = "aip", counted: str = "resolver") -> DataFrame:
    """``inNet``: the counted lookups if the answer address is in-net, else 0."""
    inside = F.coalesce(F.col("_innet"), F.lit(False))
    counted_inside = F.when(inside, F.col(counted)).otherwise(F.lit(0).cast("bigint"))
    return _matched(rows, flags, ip).withColumn("inNet", counted_inside).drop("_innet")


def geo_index(geo: DataFrame, fields: list[str]) -> RangeIndex:
    """Geo ranges, which do not overlap."""
    named = geo.select("lo", "hi", F.col("lo").alias("ord"), *[F.col(f).alias(f"geo_{f}") for f in fields])
    return RangeIndex.build(named, [f"geo_{f}" for f in fields])


def with_geo(rows: DataFrame, places: RangeIndex, ip: str = "aip") -> DataFrame:
    """Geography of an address in ``geo_`` columns; null where no range holds it."""
    return _matched(rows, places, ip)


def with_place(rows: DataFrame, places: RangeIndex) -> DataFrame:
    """Operator and province of the answer address, empty if unknown."""
    named = with_geo(rows, places).withColumns(
        {"operator": _or("geo_operator", ""), "province": _or("geo_province", "")}
    )
    return named.drop(*places.payload)


def geo_metrics(rows: DataFrame, counted: str = "resolver") -> DataFrame:
    """Lookups answered abroad, by either operator and in the overseas regions, and the printed address."""
    country, province, city, operator = (F.col(f"geo_{f}") for f in PLACE)
    overseas = province.contains(OVERSEAS_REGIONS[0])
    for region in OVERSEAS_REGIONS[1:]:
        overseas = overseas | province.contains(region)

    def count_if(condition: Column) -> Column:
        return F.when(condition, F.col(counted)).otherwise(F.lit(0).cast("bigint"))

    place = F.when(city == province, province).otherwise(F.concat(province, city))
    return rows.withColumns(
        {
            "abroadNum": count_if(country != HOME_COUNTRY),
            "telecomNum": count_if(operator.contains(TELECOM)),
            "linkNum": count_if(operator.contains(UNICOM)),
            "gatNum": count_if(overseas),
            "aIpAddr": _or(F.concat(country, place, operator), ""),
        }
    ).drop(*[f"geo_{f}" for f in PLACE])


def with_geo_metrics(rows: DataFrame, places: RangeIndex, counted: str = "resolver") -> DataFrame:
    return geo_metrics(with_geo(rows, places), counted)


def with_site(rows: DataFrame, auth_domain: DataFrame, domain: str = "domain", order: str | None = None) -> DataFrame:
    """Authority domain and the attributes of its site."""
    dim = last_per_key(auth_domain, "authDomain", SITE, order).withColumnRenamed("authDomain", "authorityDomain")
    joined = rows.withColumn("authorityDomain", authority_domain(F.col(domain))).join(dim, "authorityDomain", "left")
    return joined.withColumns({c: _or(c, UNKNOWN if c in SITE_UNKNOWN else "") for c in SITE})


def with_online_user(rows: DataFrame, online: DataFrame, ip: str = "clientIp", keep_all: bool = False) -> DataFrame:
    """User behind an address. By default rows without a user are dropped; ``keep_all`` leaves them with ``''``."""
    dim = last_per_key(online, "ip", ["user"]).select(F.col("ip").alias(ip), F.col("user").alias("userName"))
    if keep_all:
        return rows.join(dim, ip, "left").withColumn("userName", _or("userName", ""))
    return rows.join(dim.where(F.col("userName") != ""), ip)


def with_contact(rows: DataFrame, contact: DataFrame) -> DataFrame:
    """Address and phone of ``userName``."""
    dim = last_per_key(contact, "username", ["doorDesc", "mobile"]).select(
        F.col("username").alias("userName"), F.col("doorDesc").alias("address"), F.col("mobile").alias("phone")
    )
    joined = rows.join(dim, "userName", "left")
    return joined.withColumns({"address": _or("address", NO_CONTACT), "phone": _or("phone", NO_CONTACT)})


def with_whitelist(rows: DataFrame, whitelist: DataFrame) -> DataFrame:
    """``listed``: whether the domain is on the white list."""
    marks = _dealt(whitelist.select("domain").distinct(), "domain").withColumn("listed", F.lit(True))
    return rows.join(marks, "domain", "left").withColumn("listed", _or("listed", False))


def with_domain_tags(rows: DataFrame, tags: DataFrame, auth_domain: DataFrame) -> DataFrame:
    """Three labels per domain; an unknown third label falls back to the site of the authority domain."""
    labels = ["oneLabel", "twoLabel", "threeLabel"]
    exact = last_per_key(tags, "domain", labels)
    sites = last_per_key(auth_domain, "authDomain", ["websiteName"]).select(
        F.col("authDomain").alias("_authority"), F.col("websiteName").alias("_site")
    )
    joined = (
        rows.join(exact, "domain", "left")
        .withColumns({label: _or(label, UNKNOWN) for label in labels})
        .withColumn("_authority", F.when(F.col("threeLabel") == UNKNOWN, authority_domain(F.col("domain"))))
        .join(sites, "_authority", "left")
    )
    return joined.withColumn(
        "threeLabel", F.when(F.col("threeLabel") == UNKNOWN, _or("_site", UNKNOWN)).otherwise(F.col("threeLabel"))
    ).drop("_authority", "_site")


def with_district(rows: DataFrame, district: DataFrame, user: str = "userName") -> DataFrame:
    rids = ["rid1", "rid2", "rid3", "rid4"]
    dim = last_per_key(district, "userName", rids).withColumnRenamed("userName", user)
    return rows.join(dim, user, "left").withColumns({r: _or(r, 0) for r in rids})


def app_ranges(rules: DataFrame) -> DataFrame:
    """One row per range of an app rule; the app is the first word of its segment name and the end is exclusive."""
    span = F.split("_span", "-")
    return rules.withColumn("_span", F.explode(F.split("ip_long_str", ";"))).select(
        F.split("segment_name", r"\s")[0].alias("appName"),
        span[0].cast("bigint").alias("lo"),
        span[1].cast("bigint").alias("end"),
        "ord",
    )


def app_index(rules: DataFrame) -> RangeIndex:
    """App rules: the last rule wins."""
    return RangeIndex.build(app_ranges(rules).withColumn("hi", F.col("end") - 1), ["appName"])


def with_app(rows: DataFrame, apps: RangeIndex, ip: str = "destinationIp") -> DataFrame:
    """App behind a destination address."""
    return _matched(rows, apps, ip).withColumn("appName", _or("appName", OTHER_APP))


def enriched_log(clean: DataFrame, lookups: Lookups, *extra: str) -> DataFrame:
    """Clean rows with client, operator and province: the base of every five-minute report."""
    placed = with_place(with_client(clean, lookups.clients), lookups.places)
    return placed.select(*CLEAN_COLUMNS, *extra)
