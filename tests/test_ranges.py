from __future__ import annotations

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from resolvscope.functions.ip import SPACE
from resolvscope.operators import ranges
from resolvscope.operators.ranges import CROWD, IndexStore, RangeIndex, range_segments


def random_rules(rng, n):
    rules = [(0, SPACE - 1, 0, "all")] if rng.random() < 0.5 else []
    for i in range(1, n):
        width = rng.choice([0, 1, 7, 300, 70_000, 20_000_000])
        low = rng.randrange(SPACE // 64) if rng.random() < 0.7 else rng.randrange(SPACE)
        rules.append((low, min(low + rng.randrange(width + 1), SPACE - 1), i, f"r{i}"))
    return rules


def winner(rules, address, keep):
    hits = [(order, name) for low, high, order, name in rules if low <= address <= high]
    return (max(hits) if keep == "last" else min(hits))[1] if hits else None


@pytest.mark.parametrize("keep", ["first", "last"])
@pytest.mark.parametrize("dense", [False, True])
def test_equals_brute_force(spark, keep, dense):
    rng = random.Random(7)
    rules = random_rules(rng, 60)
    if dense:
        # A /24 full of hosts, one with a few, and the rest of their /16 in wide ranges.
        base = 10 << 24
        rules += [(base + i, base + i, 1000 + i, f"h{i}") for i in range(0, 256, 3)]
        rules += [(base + 512 + 50 * i, base + 520 + 50 * i, 2000 + i, f"n{i}") for i in range(5)]
        rules += [(base + 5000, base + 60_000, 3000, "wide"), (base + 300, base + 70_000, 500, "under")]
    edges = [e + d for low, high, _, _ in rules for e in (low, high) for d in (-1, 0, 1)]
    addresses = sorted({a for a in edges if 0 <= a < SPACE} | {rng.randrange(SPACE) for _ in range(200)})
    frame = spark.createDataFrame(rules, "lo bigint, hi bigint, ord bigint, name string")
    # A third of the rows share one address.
    facts = [(i, a) for i, a in enumerate(addresses)] + [(-i, addresses[5]) for i in range(1, len(addresses) // 2)]
    facts.append((10**6, None))
    index = RangeIndex.build(frame, ["name"], keep=keep)
    assert index.cells.groupBy("_level", "_cell").count().agg(F.max("count")).first()[0] <= CROWD
    matched = index.match(spark.createDataFrame(facts, "id bigint, ip bigint"), "ip")
    wanted = sorted(((i, a, winner(rules, a, keep) if a is not None else None) for i, a in facts), key=repr)
    assert rows_of(matched, "id", "ip", "name") == wanted


def test_segments_are_disjoint(spark):
    rules = random_rules(random.Random(3), 40)
    frame = spark.createDataFrame(rules, "lo bigint, hi bigint, ord bigint, name string")
    got = sorted((r["seg_lo"], r["seg_hi"], r["bucket"]) for r in range_segments(frame, ["name"]).collect())
    assert all(low <= high and low >> 16 == high >> 16 == bucket for low, high, bucket in got)
    assert all(a[1] < b[0] for a, b in zip(got, got[1:]))


def test_ranges_that_cannot_match_are_ignored(spark):
    frame = spark.createDataFrame([(9, 3, 1, "empty"), (5, 6, 2, "good")], "lo bigint, hi bigint, ord bigint, name string")
    facts = spark.createDataFrame([(4,), (5,), (7,)], "ip bigint")
    assert rows_of(RangeIndex.build(frame, ["name"]).match(facts, "ip")) == [(4, None), (5, "good"), (7, None)]


def test_lookup_plans_an_equi_join_without_moving_the_facts(spark):
    frame = spark.createDataFrame([(5, 6, 2, "good")], "lo bigint, hi bigint, ord bigint, name string")
    facts = spark.range(1000).select(F.col("id").alias("ip"))
    plan = RangeIndex.build(frame, ["name"]).match(facts, "ip")._jdf.queryExecution().optimizedPlan().toString()
    physical = RangeIndex.build(frame, ["name"]).match(facts, "ip")._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in physical and "Cartesian" not in physical
    assert "BroadcastHashJoin" in physical
    assert "LeftOuter" in plan


def test_a_crowded_bucket_stays_small(spark):
    """One host in three of a /16: cells hold few segments, and the index grows with the rules only."""
    frame = spark.range(20_000).select(
        (F.lit(10 << 24) + F.col("id") * 3).alias("lo"), (F.lit(10 << 24) + F.col("id") * 3).alias("hi"), F.col("id").alias("ord"), F.col("id").alias("name")
    )
    index = RangeIndex.build(frame, ["name"])
    assert index.cells.count() == 20_000
    assert index.cells.groupBy("_level", "_cell").count().agg(F.max("count")).first()[0] <= CROWD
    facts = spark.range(65_536).select((F.lit(10 << 24) + F.col("id")).alias("ip"))
    assert index.match(facts, "ip").where("name is not null").agg(F.count("*"), F.sum(F.col("ip") - F.col("name") * 3)).first()[:] == (20_000, 20_000 * (10 << 24))


def test_large_rules_are_shuffled_and_hot_addresses_split(spark):
    """Without broadcasting, the same plan gives the same rows, and the rows are read once."""
    rules = random_rules(random.Random(5), 40)
    frame = spark.createDataFrame(rules, "lo bigint, hi bigint, ord bigint, name string")
    facts = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") * 1_000_003 % SPACE).alias("ip"), "id")
    index = RangeIndex.build(frame, ["name"])
    small = rows_of(index.match(facts, "ip"), "id", "ip", "name")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set(adaptive, -1)
        matched = index.match(facts, "ip")
        plan = matched._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Range (") == 1
        assert rows_of(matched, "id", "ip", "name") == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset(adaptive)


NAMED = "lo bigint, hi bigint, ord int, name string"


def stored_rules(spark, path, rows):
    spark.createDataFrame(rows, NAMED).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def jobs_of(spark, action):
    group = f"counted-{action}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_equal_rules_are_not_indexed_again(spark, tmp_path):
    rows = [(5, 9, 1, "a"), (1 << 20, (1 << 20) + 70000, 2, "b")]
    one = stored_rules(spark, str(tmp_path / "one"), rows)
    first = RangeIndex.build(one, ["name"])
    again, jobs = jobs_of(spark, lambda: RangeIndex.build(spark.read.schema(one.schema).parquet(str(tmp_path / "one")), ["name"]))
    assert jobs == 0 and again is first
    # The same rules from elsewhere, in another order: found by their content.
    other = stored_rules(spark, str(tmp_path / "two"), rows[::-1])
    assert RangeIndex.build(other, ["name"]).cells.inputFiles() == first.cells.inputFiles()
    # Files that change in place are seen, and a frame that is no file is digested each time.
    changed = stored_rules(spark, str(tmp_path / "one"), [(5, 9, 1, "z")])
    assert rows_of(RangeIndex.build(changed, ["name"]).match(spark.createDataFrame([(7,)], "ip bigint"), "ip")) == [(7, "z")]


def test_changed_rules_rebuild_their_buckets_only(spark):
    rng = random.Random(12)
    bucket = 1 << 16
    rows = [(b * bucket + lo, b * bucket + lo + rng.choice((0, 3, 300, 2 * bucket)), i, f"r{i}") for i, (b, lo) in enumerate((rng.randrange(60), rng.randrange(bucket)) for _ in range(900))]
    steps = [rows, [r for r in rows if r[2] != 17] + [(3 * bucket + 5, 3 * bucket + 9, 5000, "new")], [(r[0], r[1], r[2], r[3] + "!") if r[2] == 400 else r for r in rows]]
    asks = [(rng.randrange(64 * bucket),) for _ in range(3000)] + [(e,) for r in rows[:300] for e in (r[0] - 1, r[0], r[1], r[1] + 1) if e >= 0]
    facts = spark.createDataFrame(sorted(set(asks)), "ip bigint")
    folders = []
    for rules in steps:
        frame = spark.createDataFrame(rules, NAMED).withColumnRenamed("name", "kept_name")
        store = IndexStore(frame.select("lo", "hi", "ord", "kept_name"), ("kept_name",), "last")
        got = dict(rows_of(store.index().match(facts, "ip")))
        folders.append(store._folder(store.digest()))
        for ip in got:
            holds = [r for r in rules if r[0] <= ip <= r[1]]
            assert got[ip] == (max(holds, key=lambda r: r[2])[3] if holds else None)
    for folder in folders[1:]:
        rebuilt = {r[0] for r in spark.read.parquet(f"{folder}/rebuilt").select("bucket").distinct().collect()}
        assert 0 < len(rebuilt) <= len({r[0] for r in spark.read.parquet(f"{folder}/touched").collect()}) <= 8


def test_a_build_that_broke_off_is_not_used(spark, monkeypatch):
    rules = spark.createDataFrame([(1, 3, 1, "kept")], NAMED).withColumnRenamed("name", "broken_name")
    store = IndexStore(rules, ("broken_name",), "first")
    with monkeypatch.context() as patch:
        patch.setattr(ranges, "cells", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.index()
    assert rows_of(store.index().match(spark.createDataFrame([(2,)], "ip bigint"), "ip")) == [(2, "kept")]
