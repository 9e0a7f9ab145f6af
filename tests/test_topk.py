from __future__ import annotations

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from resolvscope.operators import topk


@pytest.mark.parametrize("k", [3, 40])
@pytest.mark.parametrize("salts", [topk.SALTS, (128, 8), ()])
def test_top_k_equals_sorting(spark, k, salts):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.8 else f"g{rng.randrange(5)}", f"d{i}", rng.randrange(9)) for i in range(700)]
    frame = spark.createDataFrame(rows, "g string, domain string, number bigint")
    got = rows_of(topk.top_k(frame, ["g"], topk.by_number("domain"), k, salts=salts))
    wanted = []
    for group in {r[0] for r in rows}:
        wanted += sorted((r for r in rows if r[0] == group), key=lambda r: (-r[2], r[1]))[:k]
    assert got == sorted(wanted, key=repr)


def test_short_lists_are_cut_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("g"), "id", F.lit(1).alias("number"))
    plan = topk.top_k(frame, ["g"], topk.by_number("id"), 5)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_two_shuffles_after_the_sum(spark):
    rows = spark.range(1000).selectExpr("id % 7 as accesstime", "id % 3 as responseCode", "cast(id as string) as domain", "id as resolver")
    plan = topk.top_domains(rows, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 3


def test_rank_is_kept_on_request(spark):
    frame = spark.createDataFrame([("a", "x", 5), ("a", "y", 7)], "g string, domain string, number bigint")
    got = topk.top_k(frame, ["g"], topk.by_number("domain"), 2, rank="_rank")
    assert rows_of(got, "_rank", "domain") == [(1, "y"), (2, "x")]


def test_authorities_come_from_kept_domains(spark):
    rows = [("a.qq.com", 5), ("b.qq.com", 4), ("c.jd.com", 6), ("d.jd.com", 1)]
    frame = spark.createDataFrame([(1, 0, d, n) for d, n in rows], "accesstime bigint, responseCode int, domain string, resolver bigint")
    domains = topk.top_domains(frame, 3)
    assert rows_of(topk.top_authorities(domains, 5), "authorityDomain", "number") == [("jd.com", 6), ("qq.com", 9)]
