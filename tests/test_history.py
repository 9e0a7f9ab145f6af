"""Lookups of the time that is replayed."""

from __future__ import annotations

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from resolvscope import fixtures as fx
from resolvscope.catalog.queries import SIZES, lookups
from resolvscope.plans import five_minute, replay
from resolvscope.sources import history

SCHEMA = "userName string, rid1 int, rid2 int, dt int"


def test_versions_and_as_of_equal_a_search(spark):
    rng = random.Random(3)
    days = [20240130, 20240131, 20240201, 20240210, 20240301]
    rows = [(u, rng.choice([1, 2, None]), rng.choice([1, 2]), d) for u in "abcdefgh" for d in days if rng.random() < 0.7]
    # A key twice in one snapshot, a snapshot that repeats rows, a key that is null.
    rows += [("a", 9, 1, 20240201), ("a", 9, 1, 20240201), (None, 5, 5, 20240130)]
    made = history.versions(spark.createDataFrame(rows, SCHEMA), "userName", ["rid1", "rid2"])
    asked = [(u, d) for u in [*"abcdefgh", "z", None] for d in [20240101, *days, 20240205, 20250101]] * 2
    got = history.as_of(spark.createDataFrame(asked, "userName string, day int"), made, "userName", ["rid1", "rid2"], "day")

    def search(user, day):
        held = max((d for d in days if d <= day), default=None)
        found = [(r[1], r[2]) for r in rows if r[0] == user and r[3] == held and user is not None]
        return max(found, key=lambda v: tuple((x is not None, x or 0) for x in v), default=(None, None))

    assert rows_of(got) == sorted(((u, d, *search(u, d)) for u, d in asked), key=repr)
    assert history.versions(spark.createDataFrame([], SCHEMA), "userName", ["rid1", "rid2"]).count() == 0


def test_equal_snapshots_make_one_version(spark):
    rows = [("a", 1, 1, 20240101 + i) for i in range(20)] + [("b", 1, 1, 20240101), ("b", 1, 1, 20240103)]
    made = history.versions(spark.createDataFrame(rows, SCHEMA), "userName", ["rid1", "rid2"])
    want = [("a", 20240101, None), ("b", 20240101, 20240102), ("b", 20240103, 20240104)]
    assert rows_of(made, "userName", "valid_from", "valid_to") == sorted(want, key=repr)


def test_snapshot_of_a_day(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no snapshot"):
        history.snapshot(spark, path, 20240101)
    for day, n in ((20240105, 1), (20240110, 2), (20240110, 3)):
        history.store_snapshot(spark.range(n), path, day)
    found = {d: history.snapshot(spark, path, d).count() for d in (20240104, 20240105, 20240109, 20240110, 20240401)}
    assert found == {20240104: 0, 20240105: 1, 20240109: 1, 20240110: 3, 20240401: 3}


def test_backfill_gives_each_day_its_own_rules(spark, folder, tmp_path):
    """Client rules and places change on the second day; both days equal runs with the lookups of the day alone."""
    old, stored, target = lookups(spark, folder), str(tmp_path / "history"), str(tmp_path / "out")
    log = fx.dns_log(spark, folder).drop("event_id")
    newest = log.agg(F.max("Timestamp")).first()[0] // 1000
    second = newest - newest % 86400
    begin, end = second - 86400, second + 86400
    before, after = (int(r) for r in spark.range(1).select(*[F.date_format(F.timestamp_seconds(F.lit(t)), "yyyyMMdd") for t in (begin, second)]).first())
    changed = {
        "client": old.client.withColumn("client_type_id", F.concat(F.col("client_type_id").cast("string"), F.lit("9")).cast(old.client.schema["client_type_id"].dataType)),
        "geo": old.geo.withColumn("province", F.concat("province", F.lit("+"))),
    }
    for name in replay.TABLES:
        history.store_snapshot(getattr(old, name), f"{stored}/{name}", before)
    for name, rows in changed.items():
        history.store_snapshot(rows, f"{stored}/{name}", after)
    assert replay.run(spark, log, stored, target, begin, end, SIZES) == [(begin, second, before), (second, end, after)]

    at = F.col("Timestamp")
    new = type(old)(**{n: changed.get(n, getattr(old, n)) for n in replay.TABLES})
    for low, high, look in ((begin, second, old), (second, end, new)):
        rows = log.where((at >= low * 1000) & (at < high * 1000))
        want = five_minute.all_tables(five_minute.base(rows, look, SIZES), look, SIZES, only=["qps", "province"])
        for name, table in want.items():
            got = spark.read.parquet(f"{target}/{name}").where((F.col("accesstime") > low) & (F.col("accesstime") <= high))
            assert rows_of(got, *table.columns) == rows_of(table), name
            assert table.count() > 0
    both = [{r[0] for r in spark.read.parquet(f"{target}/qps").where(F.col("accesstime").between(low + 1, low + 86400)).select("clientName").collect()} for low in (begin, second)]
    assert not both[0] & both[1] - {0, None}
