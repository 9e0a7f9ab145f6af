"""Distinct sources by mergeable masks, against sets."""

from __future__ import annotations

import random

from conftest import rows_of
from pyspark.sql import functions as F

from resolvscope.operators import profile
from resolvscope.plans import profiles

ODD = [None, "", ".", "5", ".5", "1.2.3.4", "1.2.3.04", "1.2.3.256", "1.2.3.-1", "1.2.3.+4", "1.2.3. 4", "a.b", "x.7", "1.2.3.4.5", "1.2.3.", "1.2.3.63", "1.2.3.64", "1.2.3.255", "1.2.3.127"]
SCHEMA = "clientName string, timestamp bigint, sourceIp string, bytes bigint"


def flows(n=3000):
    rng = random.Random(8)
    ips = ODD + [f"10.{rng.randrange(3)}.{rng.randrange(2)}.{rng.randrange(256)}" for _ in range(400)]
    rows = [(rng.choice(["c", "d", None]), 1704067200 + rng.randrange(3 * 86400), rng.choice(ips), rng.randrange(1, 9)) for _ in range(n)]
    return rows + [("only nulls", 1704067200, None, 4)] * 2


def sets(rows, of):
    seen, total = {}, {}
    for client, at, ip, n in rows:
        seen.setdefault((client, of(at)), set()).update([ip] if ip is not None else [])
        total[client, of(at)] = total.get((client, of(at)), 0) + n
    return sorted(((c, t, len(s), total[c, t]) for (c, t), s in seen.items()), key=repr)


def test_masks_count_what_sets_hold(spark):
    rows = flows()
    flow = spark.createDataFrame(rows, SCHEMA).withColumn("hour", F.expr("timestamp div 3600"))
    by = ["clientName", "hour"]
    got = profile.points(profile.source_masks(flow, by), by)
    assert rows_of(got, *by, "points", "bytes") == sets(rows, lambda t: t // 3600)
    counted = flow.groupBy(*by).agg(F.count_distinct("sourceIp").alias("points"))
    assert rows_of(profile.hour_points(flow)) == rows_of(counted)


def test_days_from_stored_hours_equal_the_direct_count(spark, tmp_path):
    rows, root = flows(), str(tmp_path)
    flow = spark.createDataFrame(rows, SCHEMA)
    profiles.store_sources(flow, root)
    days = {1704067200 + 86400 * i: 20240101 + i for i in range(3)}
    want = sets(rows, lambda t: days[t - t % 86400])
    columns = ["clientName", "dt", "points", "bytes"]
    assert rows_of(profiles.day_points(spark, root, list(days.values())), *columns) == want
    # An hour that runs again replaces itself.
    profiles.store_sources(flow.where("timestamp < 1704067200 + 3600"), root)
    assert rows_of(profiles.day_points(spark, root, list(days.values())), *columns) == want
    assert rows_of(profiles.day_points(spark, root, [20240102]), *columns) == [w for w in want if w[1] == 20240102]
