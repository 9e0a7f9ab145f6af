from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from resolvscope import functions as fn
from resolvscope.functions.ip import cidr_table, explode_cidr, explode_hosts, parse_cidr

c = F.col


@pytest.mark.parametrize(
    ("text", "wanted"),
    [("1.2.3.4", 16909060), ("1.2.3", 0), ("255.255.255.255", 4294967295), ("a.2.3.4", None), ("1.2.3.4.", 16909060), ("", 0)],
)
def test_ip_to_long(value, text, wanted):
    assert value(fn.ip_to_long(c("t")), t=text) == wanted


def test_ip_to_long_of_null(spark):
    assert spark.sql("select cast(null as string) t").select(fn.ip_to_long(c("t"))).first()[0] is None


@pytest.mark.parametrize("number", [0, 1, 16909060, 4294967295, 3663657152])
def test_long_to_ip_round_trip(value, number):
    text = value(fn.long_to_ip(c("n").cast("bigint")), n=number)
    assert text == ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))
    assert value(fn.ip_to_long(c("t")), t=text) == number


@pytest.mark.parametrize(
    ("ip", "cidr", "inside"),
    [
        ("218.108.248.192", "218.108.248.192/26", True),
        ("218.108.248.255", "218.108.248.192/26", True),
        ("218.108.248.191", "218.108.248.192/26", False),
        ("192.168.8.3", "192.168.9.10/22", True),
        ("9.9.9.9", "1.2.3.4/0", True),
        ("1.2.3.4", "1.2.3.4/32", True),
        ("1.2.3", "0.0.0.0/8", None),
    ],
)
def test_in_cidr(value, ip, cidr, inside):
    assert value(fn.in_cidr(c("t"), cidr), t=ip) is inside


def test_parse_cidr():
    assert parse_cidr("10.1.2.3/16") == (167837696, 167903231)


@pytest.mark.parametrize(("text", "good"), [("1.2.3.4", True), ("999.1.1.1", True), ("1.2.3", False), ("1.2.3.4.5", False), ("x", False)])
def test_is_ip(value, text, good):
    assert value(fn.is_ip(c("t")), t=text) is good


def test_cidr_table(spark):
    rows = spark.createDataFrame([("218.240.38.69", 30), ("10.9.8.7", 8), ("1.2.3.4", 32)], "ip string, bits int")
    got = {r["bits"]: r for r in cidr_table(rows).collect()}
    assert (got[30]["begin_ip"], got[30]["end_ip"], got[30]["mask"]) == ("218.240.38.68", "218.240.38.71", "255.255.255.252")
    assert (got[30]["addresses"], got[30]["usable_hosts"], got[30]["mask_bits"]) == (4, 2, 30)
    assert (got[8]["begin_ip"], got[8]["end_ip"], got[8]["usable_hosts"]) == ("10.0.0.0", "10.255.255.255", 2**24 - 2)
    assert (got[32]["addresses"], got[32]["usable_hosts"]) == (1, 0)


def test_explode_cidr_leaves_out_edges(spark):
    rows = spark.createDataFrame([("10.0.0.9", 29), ("10.0.0.9", 31), ("10.0.0.9", 32)], "ip string, bits int")
    got = sorted((r["bits"], r["host"] - 167772160) for r in explode_cidr(rows).collect())
    assert got == [(29, n) for n in range(9, 15)] + [(31, 8), (31, 9), (32, 9)]


def test_explode_hosts_in_blocks(spark):
    rows = spark.createDataFrame([(5, 30)], "lo bigint, hi bigint")
    assert sorted(r["host"] for r in explode_hosts(rows, "lo", "hi", block=4).collect()) == list(range(5, 31))


@pytest.mark.parametrize(
    ("name", "wanted"),
    [
        ("www.qq.com", "qq.com"),
        ("a.cnn.com", "n.com"),
        ("x.com.cn", "x.com.cn"),
        ("localhost", "localhost"),
        ("a.net.b.com", "b.com"),
        ("1.0.168.192.in-addr.arpa", "in-addr.arpa"),
        ("foo.bar.co", "bar.co"),
        ("foo.co.bar", "foo.co.bar"),
    ],
)
def test_authority_domain(value, name, wanted):
    assert value(fn.authority_domain(c("n")), n=name) == wanted


@pytest.mark.parametrize(
    ("name", "noise"),
    [
        ("hadoop", False), ("spark", False), ("ml", False), ("mmmm", False), ("fsdsdfDHCP", True), ("DHCP5", False),
        ("", True), ("a b", True), ("x.localdomain", True), ("HOST-1", True), ("master01.x", True), ("getCachedX", True),
    ],
)
def test_noise(value, name, noise):
    assert value(fn.has_noise(c("n")), n=name) is noise


@pytest.mark.parametrize(("name", "hit"), [("www.qq.com", True), ("m.vivo.com.cn", True), ("qq.comet.org", True), ("qqxcom", False)])
def test_top_sites(value, name, hit):
    assert value(fn.in_top_sites(c("n")), n=name) is hit


@pytest.mark.parametrize(("name", "wanted"), [("http://a", "a"), ("https://a", "a"), ("http://x/https://y", "http://x/y"), ("a", "a")])
def test_strip_scheme(value, name, wanted):
    assert value(fn.strip_scheme(c("n")), n=name) == wanted


def test_md5_key_prints_null(spark):
    row = spark.sql("select 1 a, cast(null as string) b, 'x' c").select(fn.md5_key("a", "b", "c")).first()[0]
    assert row == hashlib.md5(b"1nullx").hexdigest()


def test_task_windows(spark):
    # 2024-01-10 13:47:21
    now = 1704894441
    bounds = {k: (u, low) for k, (u, low) in fn.task_windows(F.lit(now).cast("bigint")).items()}
    got = spark.range(1).select(*[v.alias(f"{k}{i}") for k, pair in bounds.items() for i, v in enumerate(pair)]).first()
    day = now // 86400 * 86400
    assert (got["hour0"], got["hour1"]) == (day + 13 * 3600, day + 12 * 3600)
    assert (got["six_hours0"], got["six_hours1"]) == (day + 12 * 3600, day + 6 * 3600)
    assert (got["day0"], got["day1"]) == (day, day - 86400)
    assert (got["five_minutes0"], got["five_minutes1"]) == (now // 300 * 300, now // 300 * 300 - 300)


def test_window_end_is_exclusive(value):
    assert value(fn.window_end(c("n").cast("bigint")), n=299_999) == 300
    assert value(fn.window_end(c("n").cast("bigint")), n=300_000) == 600
