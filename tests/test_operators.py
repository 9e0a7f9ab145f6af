from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from resolvscope.operators import counts, daily, detail, enrich, nat, profile, rollup


def rules(spark, *rows):
    return spark.createDataFrame(rows, "min_long_ip bigint, max_long_ip bigint, ord bigint")


def test_client_first_and_business_last_rule_wins(spark):
    both = rules(spark, (0, 100, 0), (50, 200, 1))
    facts = spark.createDataFrame([("0.0.0.60",), ("0.0.1.9",)], "clientIp string")
    clients = enrich.client_index(both.withColumn("client_type_id", F.col("ord").cast("int") + 1))
    assert rows_of(enrich.with_client(facts, clients), "clientIp", "clientName") == [("0.0.0.60", 1), ("0.0.1.9", 5)]
    named = both.withColumns({"s_id": F.col("ord"), "company_id": F.lit(7), "resource_id": F.lit(8)})
    matched = enrich.with_business(facts, enrich.business_index(named), ip="clientIp")
    assert rows_of(matched, "resourceName", "resourceType", "resourceProps") == [("", "", ""), ("1", "7", "8")]


@pytest.mark.parametrize(("innet", "wanted"), [([(0, 9, 0)], [0, 3, 3]), ([], [0, 0, 0])])
def test_innet_counts_business_ranges_only_beside_innet_rules(spark, innet, wanted):
    table = spark.createDataFrame(innet, "min_long_ip bigint, max_long_ip bigint, ord bigint")
    facts = spark.createDataFrame([("0.0.0.5", 3), ("0.0.0.50", 3), ("0.0.0.90", 3)], "aip string, resolver bigint")
    index = enrich.innet_index(table, rules(spark, (40, 60, 0)))
    assert sorted(r.inNet for r in enrich.with_innet(facts, index).collect()) == wanted


def test_app_ranges_end_is_exclusive_and_last_wins(spark):
    table = spark.createDataFrame([("one app", "0-10;20-30", 0), ("two app", "5-6", 1)], "segment_name string, ip_long_str string, ord int")
    facts = spark.createDataFrame([(f"0.0.0.{n}",) for n in (4, 5, 6, 10, 20, 30)], "destinationIp string")
    got = dict(rows_of(enrich.with_app(facts, enrich.app_index(table)), "destinationIp", "appName"))
    assert [got[f"0.0.0.{n}"] for n in (4, 5, 6, 10, 20, 30)] == ["one", "two", "one", "其他", "one", "其他"]


def test_geo_metrics(spark):
    geo = [
        (0, 9, "中国", "香港", "香港", "电信"),
        (10, 19, "中国", "浙江", "杭州", "中国联通"),
        (20, 29, "美国", "加州", "洛杉矶", "x"),
    ]
    table = spark.createDataFrame(geo, "lo bigint, hi bigint, country string, province string, city string, operator string")
    facts = spark.createDataFrame([(f"0.0.0.{n}", 2) for n in (1, 11, 21, 31)], "aip string, resolver bigint")
    index = enrich.geo_index(table, enrich.PLACE)
    got = rows_of(enrich.with_geo_metrics(facts, index), "aip", "abroadNum", "telecomNum", "linkNum", "gatNum", "aIpAddr")
    assert got == [
        ("0.0.0.1", 0, 2, 0, 2, "中国香港电信"),
        ("0.0.0.11", 0, 0, 2, 0, "中国浙江杭州中国联通"),
        ("0.0.0.21", 2, 0, 0, 0, "美国加州洛杉矶x"),
        ("0.0.0.31", 0, 0, 0, 0, ""),
    ]


def test_site_defaults_and_last_row_per_domain(spark):
    dim = spark.createDataFrame(
        [("qq.com", 1, "old"), ("qq.com", 2, "new")], "authDomain string, seen int, websiteName string"
    ).withColumns({c: F.lit("v") for c in enrich.SITE if c != "websiteName"})
    facts = spark.createDataFrame([("www.qq.com",), ("b.jd.com",)], "domain string")
    got = rows_of(enrich.with_site(facts, dim, order="seen"), "domain", "websiteName", "companyType", "soft")
    assert got == [("b.jd.com", "", "未知", ""), ("www.qq.com", "new", "v", "v")]


def test_labels_fall_back_to_the_site(spark):
    tags = spark.createDataFrame([("a.qq.com", "1", "2", "未知"), ("b.qq.com", "1", "2", "3")], "domain string, oneLabel string, twoLabel string, threeLabel string")
    sites = spark.createDataFrame([("qq.com", "QQ")], "authDomain string, websiteName string")
    facts = spark.createDataFrame([("a.qq.com",), ("b.qq.com",), ("c.jd.com",)], "domain string")
    got = rows_of(enrich.with_domain_tags(facts, tags, sites), "domain", "oneLabel", "threeLabel")
    assert got == [("a.qq.com", "1", "QQ"), ("b.qq.com", "1", "3"), ("c.jd.com", "未知", "未知")]


def log_rows(spark):
    rows = [(300, 1, "A", 1, 1), (300, 1, "A", 1, 0), (300, 2, "A", 1, 0), (300, 2, "AAAA", 1, 1), (600, 1, "A", 700, 0)]
    return spark.createDataFrame(rows, "accesstime bigint, clientName int, requestType string, resolver bigint, error bigint")


def test_counts_have_client_and_total_rows(spark):
    got = rows_of(counts.count_report(log_rows(spark), "requestType"), "accesstime", "clientName", "requestType", "number")
    assert got == [
        (300, 0, "A", 3), (300, 0, "AAAA", 1), (300, 1, "A", 2), (300, 2, "A", 1), (300, 2, "AAAA", 1),
        (600, 0, "A", 700), (600, 1, "A", 700),
    ]


def test_qps_rate_and_key(spark):
    got = rows_of(counts.qps(log_rows(spark)).where("accesstime = 600"), "clientName", "number", "error", "avgNum", "key")
    assert got == [(0, 700, 0, 2, "600qps_0"), (1, 700, 0, 2, "600qps_1")]


def test_detail_bonus_only_chooses(spark):
    rows = [(300, 1, "a.com", "s", "1.1.1.1", 3, 0), (300, 1, "b.com", "s", "1.1.1.1", 9, 0), (300, 1, "c.com", "s", "1.1.1.1", 12, 0)]
    summed = spark.createDataFrame(rows, "accesstime bigint, clientName int, domain string, dnsIp string, aip string, resolver bigint, error bigint")
    white = spark.createDataFrame([("a.com",)], "domain string")
    got = rows_of(detail.boosted(summed, white).where("boosted >= 10"), "domain", "resolver", "boosted")
    assert got == [("a.com", 3, 13), ("c.com", 12, 12)]


def test_trend_threshold(spark):
    base = {c: F.lit("") for c in ("companyName", "authorityDomain", "soft", "websiteName", "websiteType")}
    rows = spark.createDataFrame([(300, 1, "a", "x", 100, 0, 0), (300, 1, "b", "x", 101, 0, 0)], "accesstime bigint, clientName int, domain string, aip string, resolver bigint, inNet bigint, error bigint")
    assert [r.domain for r in detail.trend(rows.withColumns(base)).collect()] == ["b"]


def test_rollups(spark):
    rows = [(0, 1, "A", "1"), (300, 1, "A", "2"), (3600, 1, "A", "4"), (7200, 1, "A", None), (7500, 1, "A", "x"), (21600, 1, "A", "5")]
    frame = spark.createDataFrame(rows, "accesstime bigint, clientName int, requestType string, number string")
    hours = rollup.roll_report(frame, "requestType", "hh")
    assert rows_of(hours, "accesstime", "number") == [(0, 2), (21600, 5), (3600, 4), (7200, None)]
    assert rows_of(rollup.roll_report(hours, "requestType", "6h"), "accesstime", "number") == [(0, 3), (21600, 5)]
    assert rows_of(rollup.roll_report(frame, "requestType", "dd"), "accesstime", "number") == [(0, 12)]
    with pytest.raises(ValueError):
        rollup.roll_report(frame, "user", "dd")


def test_qps_rollup_divides_the_unrounded_value(spark):
    frame = spark.createDataFrame([(0, 1, 599, 1), (300, 1, 600, 0)], "accesstime bigint, clientName int, number bigint, error bigint")
    assert rows_of(rollup.roll_report(frame, "qps", "hh"), "number", "error", "avgNum") == [(600, 1, 1)]
    assert rows_of(rollup.roll_report(frame, "qps", "dd"), "number", "error", "avgNum") == [(1199, 1, 3)]


def day_rows(spark, *rows):
    frame = spark.createDataFrame(rows, "accesstime bigint, domain string, clientName int, resourceType string, aip string, resolver bigint")
    zero = {c: F.lit(1).cast("bigint") for c in daily.COUNTERS if c != "resolver"}
    text = {c: F.lit("") for c in daily.DIMENSIONS if c not in frame.columns}
    return frame.withColumns({**zero, **text})


def test_domain_summary_shows_the_busiest_row(spark):
    day = daily.day_totals(day_rows(spark, (3600, "a", 1, "t1", "1.1.1.1", 5), (7200, "a", 2, "t1", "2.2.2.2", 9), (90, "a", 1, "t2", "3.3.3.3", 7)))
    (whole,) = daily.nested_domains(day).collect()
    assert (whole.clientName, whole.resolver, whole.aip, whole.inNet) == (0, 21, "2.2.2.2", 3)
    assert [(t.resourceType, t.resolver) for t in whole.resourceTypes] == [("t2", 7), ("t1", 14)]
    per_client = daily.nested_domains(day, per_client=True)
    assert rows_of(per_client, "clientName", "resolver", "aip") == [(1, 12, "3.3.3.3"), (2, 9, "2.2.2.2")]


def test_running_totals_and_active_keys(spark):
    detail_rows = day_rows(spark, (10, "a", 1, "t", "x", 5), (3700, "a", 1, "t", "x", 2), (3800, "b", 1, "t", "x", 1))
    running = daily.running_day_totals(daily.hour_totals(detail_rows))
    assert rows_of(running, "hour", "domain", "resolver") == [(0, "a", 5), (3600, "a", 7), (3600, "b", 1)]
    hours = daily.hour_totals(detail_rows)
    assert rows_of(daily.merge_hours(hours), "key", "resolver") == rows_of(daily.day_totals(detail_rows), "key", "resolver")


def test_nat_counts_equal_counts_once(spark):
    flow = spark.createDataFrame([(10, "t", "d", 4), (20, "t", "d", 4), (30, "t", "d", 5)], "accesstime bigint, types string, data string, count bigint")
    assert rows_of(nat.nat_hour(flow), "count", "key") == [(9, "0_t_d")]
    assert rows_of(nat.nat_hour(flow, dedupe=False), "count") == [(13,)]
    before = spark.createDataFrame([("0_t_d", 100)], "key string, count bigint")
    assert rows_of(nat.add_running(nat.nat_hour(flow), before), "count") == [(109,)]
    assert rows_of(nat.add_running(nat.nat_hour(flow), before.where("key = 'x'")), "count") == [(9,)]


def test_profile_of_users_known_to_one_side(spark):
    rows = spark.createDataFrame([("u1", "a.qq.com", 3), ("u1", "b.qq.com", 4)], "userName string, domain string, resolver bigint")
    flow = spark.createDataFrame(
        [("u2", "08", "s1", "app", 10), ("u2", "08", "s2", "app", 15), ("u2", "09", "s1", "", 4)],
        "clientName string, hour string, sourceIp string, appName string, bytes bigint",
    )
    tags = spark.createDataFrame([("a.qq.com", "1", "未知", "3")], "domain string, oneLabel string, twoLabel string, threeLabel string")
    sites = spark.createDataFrame([("jd.com", "JD")], "authDomain string, websiteName string")
    district = spark.createDataFrame([("u2", 1, 2, 3, 4)], "userName string, rid1 int, rid2 int, rid3 int, rid4 int")
    got = {r.username: r for r in profile.profile(rows, flow, tags, sites, district, "20240101", 7).collect()}
    one, two = got["u1"], got["u2"]
    assert (one.id, one.accesstime, one.resolver, one.bytes, one.rids) == ("20240101_u1", 7, 7, 0, [0, 0, 0, 0])
    assert [(d.domain, d.resolver, d.tags) for d in one.domains] == [("b.qq.com", 4, []), ("a.qq.com", 3, ["1", "3"])]
    assert (one.tags, one.apps, one.byte) == (["1", "3"], [], [])
    assert (two.domains, two.resolver, two.bytes, two.rids) == ([], 0, 29, [1, 2, 3, 4])
    assert [(p.hour, p.byte) for p in two.byte] == [(8, 12), (9, 4)]
    assert [(a.app, a.byte) for a in two.apps] == [("app", 25)]


@pytest.mark.parametrize("lookup", ["site", "online", "contact", "whitelist", "tags", "district"])
def test_hot_keys_of_equality_lookups_are_split(spark, lookup):
    """With broadcasting off, a key that holds half of the rows is split at run time."""
    look = enrich
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "qq.com").otherwise(F.concat(F.col("id"), F.lit(".cn"))).alias("domain"),
        F.when(F.col("id") % 2 == 0, "").otherwise(F.col("id").cast("string")).alias("userName"),
        F.when(F.col("id") % 2 == 0, "10.0.0.1").otherwise(F.col("id").cast("string")).alias("clientIp"),
    )
    keys = spark.range(1000).select((F.col("id") * 2 + 1).cast("string").alias("k"))
    hot = keys.unionByName(spark.createDataFrame([("",), ("10.0.0.1",), ("qq.com",)], "k string"))
    site = hot.select(F.col("k").alias("authDomain"), *[F.lit("s").alias(c) for c in look.SITE])
    run = {
        "site": lambda: look.with_site(rows, site),
        "online": lambda: look.with_online_user(rows.drop("userName"), hot.select(F.col("k").alias("ip"), F.lit("u").alias("user"))),
        "contact": lambda: look.with_contact(rows, hot.select(F.col("k").alias("username"), F.lit("d").alias("doorDesc"), F.lit("1").alias("mobile"))),
        "whitelist": lambda: look.with_whitelist(rows, hot.select(F.col("k").alias("domain"))),
        "tags": lambda: look.with_domain_tags(rows, hot.select(F.col("k").alias("domain"), *[F.lit("t").alias(c) for c in ("oneLabel", "twoLabel", "threeLabel")]), site),
        "district": lambda: look.with_district(rows, hot.select(F.col("k").alias("userName"), *[F.lit(1).alias(f"rid{i}") for i in range(1, 5)])),
    }[lookup]
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        joined = run()
        # All columns are used, so that no join is optimised away.
        counted = joined.agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*joined.columns)).alias("used"))
        assert counted.collect()[0]["n"] == (400_000 if lookup != "online" else 201_000)
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
