"""Whole jobs, in batch and as a stream."""

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from resolvscope import fixtures as fx
from resolvscope.catalog.queries import SIZES, lookups
from resolvscope.operators.daily import user_day
from resolvscope.plans import daily, five_minute, hourly, nat, profiles, rollups
from resolvscope.sinks import ledger
from resolvscope.sources.logs import parse_nat_lines, read_user_domains, slot_paths, stream_dns_json
from resolvscope.streaming import reports as stream

DAY = 86400


@pytest.fixture(scope="module")
def log(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "t")
    fx.dns_log(spark, folder).drop("event_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def written(spark, folder, log, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("reports"))
    names = five_minute.run(log, lookups(spark, folder), root, SIZES)
    return root, names


def test_summed_groups_give_the_reports_of_the_rows(spark, folder, log, written):
    root, names = written
    look = lookups(spark, folder)
    direct = five_minute.all_tables(five_minute.base(log, look, SIZES), look, SIZES)
    assert set(names) == set(direct)
    for name, table in direct.items():
        if name == "user_domain":
            assert rows_of(read_user_domains(spark, f"{root}/{name}")) == rows_of(table, "userName", "domain", "resolver")
        else:
            assert rows_of(spark.read.parquet(f"{root}/{name}"), *table.columns) == rows_of(table), name


def as_lines(log):
    return log.select(F.to_json(F.struct("*")).alias("value")).coalesce(1)


def test_stream_equals_batch_for_closed_intervals(spark, folder, log, written, tmp_path):
    """Files arrive in time order, one per batch; a late copy of the first file changes nothing."""
    root, _ = written
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "progress"))
    # All tables; the text of user_domain carries no interval column to cut by.
    only = sorted(set(written[1]) - {"user_domain"})
    bounds = [0, 1704500000, 1705500000, 2**40]
    for low, high in zip(bounds, bounds[1:]):
        at = F.col("Timestamp") / 1000
        as_lines(log.where((at >= low) & (at < high))).write.mode("append").text(source)
        stream.start(
            stream_dns_json(spark, source),
            lookups(spark, folder), target, checkpoint, SIZES, trigger={"availableNow": True}, only=only,
        ).awaitTermination()
    late = log.where(F.col("Timestamp") < 1704500000000)
    as_lines(late).write.mode("append").text(source)
    stream.start(
        stream_dns_json(spark, source),
        lookups(spark, folder), target, checkpoint, SIZES, trigger={"availableNow": True}, only=only,
    ).awaitTermination()
    newest = log.agg(F.max("Timestamp")).first()[0] // 1000
    for name in only:
        batch = spark.read.parquet(f"{root}/{name}").where(F.col("accesstime") <= newest - 600)
        got = spark.read.parquet(f"{target}/{name}").where(F.col("accesstime") <= newest - 600)
        columns = [c for c in batch.columns if c not in ("dt", "interval")]
        assert rows_of(got, *columns) == rows_of(batch, *columns), name


def test_rollup_job(spark, written, tmp_path):
    root, _ = written
    families = ["qps", "province", "user", "trend"]
    sources = {t: f"{root}/{t}" for t in families}
    hours = {t: str(tmp_path / "hh" / t) for t in families}
    days = {t: str(tmp_path / "dd" / t) for t in families}
    assert set(rollups.run(spark, "hh", sources, hours, 0, 2**40)) == set(families)
    assert set(rollups.run(spark, "dd", sources, days, 0, 2**40)) == set(families) - {"user", "trend"}
    total = spark.read.parquet(sources["qps"]).agg(F.sum("number")).first()[0]
    assert spark.read.parquet(days["qps"]).agg(F.sum("number")).first()[0] == total
    before = rows_of(spark.read.parquet(days["qps"]), "accesstime", "clientName", "number")
    low = before[0][0]
    rollups.run(spark, "dd", sources, days, low, low + DAY)
    assert rows_of(spark.read.parquet(days["qps"]), "accesstime", "clientName", "number") == before
    # A range that cuts through buckets replaces them by whole ones.
    rollups.run(spark, "dd", sources, days, low + 40_000, low + DAY + 5_000)
    assert rows_of(spark.read.parquet(days["qps"]), "accesstime", "clientName", "number") == before


@pytest.mark.parametrize(
    ("task", "begin", "end", "wanted"),
    [("hh", 3600, 7200, (3600, 7200)), ("hh", 3601, 7201, (3600, 10800)), ("6h", 5, 21600, (0, 21600)), ("dd", 86399, 86401, (0, 172800))],
)
def test_ranges_widen_to_whole_buckets(spark, task, begin, end, wanted):
    assert rollups.whole_buckets(spark, task, begin, end) == wanted


def test_last_window(spark):
    assert rollups.last_window(spark, "hh", 1704894441) == (1704888000, 1704891600)


def test_day_job_is_repeatable(spark, written, tmp_path):
    root, _ = written
    detail = spark.read.parquet(f"{root}/detail")
    target, state = str(tmp_path / "day"), str(tmp_path / "innet")
    daily.run(spark, detail, target, state, 1)
    first = {n: rows_of(spark.read.parquet(f"{target}/{n}"), "key", "resolver") for n in ("detail_day", "domain_day")}
    known = rows_of(spark.read.parquet(state))
    daily.run(spark, detail, target, state, 1)
    for name, rows in first.items():
        assert rows_of(spark.read.parquet(f"{target}/{name}"), "key", "resolver") == rows
    assert rows_of(spark.read.parquet(state)) == known and known
    total = detail.agg(F.sum("resolver")).first()[0]
    assert spark.read.parquet(f"{target}/detail_day").agg(F.sum("resolver")).first()[0] == total
    by_client = spark.read.parquet(f"{target}/domain_day").groupBy(F.col("clientName") == 0).agg(F.sum("resolver").alias("n"))
    assert {r.n for r in by_client.collect()} == {total}


def test_user_day_job(spark, written, tmp_path):
    root, _ = written
    rows = spark.read.parquet(f"{root}/user_rows")
    daily.run_users(spark, rows, str(tmp_path / "u"))
    daily.run_users(spark, rows, str(tmp_path / "u"))
    stored = spark.read.parquet(str(tmp_path / "u"))
    assert stored.agg(F.sum("number")).first()[0] == rows.agg(F.sum("number")).first()[0]


def test_profile_job(spark, folder, written, tmp_path):
    root, _ = written
    target = str(tmp_path / "p")
    args = [fx.flowmsg(spark, folder), fx.app_rule(spark, folder), fx.domain_tags(spark, folder), fx.auth_domain(spark, folder), fx.district(spark, folder)]
    profiles.run(spark, target, read_user_domains(spark, f"{root}/user_domain"), *args, day="20240131", accesstime=1706659200)
    stored = spark.read.parquet(target)
    assert stored.count() == stored.select("id").distinct().count() > 0


def test_hourly_job_meets_the_day_job_and_is_repeatable(spark, written, tmp_path):
    root, _ = written
    detail = f"{root}/detail"
    rows = spark.read.parquet(detail)
    hours = [r[0] for r in rows.select((F.col("accesstime") - F.col("accesstime") % 3600).alias("h")).distinct().orderBy("h").limit(3).collect()]
    whole, hour = str(tmp_path / "whole"), str(tmp_path / "hour")
    daily.run(spark, rows, whole, str(tmp_path / "innet"), 1)
    for begin in [*hours, hours[0]]:
        hourly.run(spark, detail, hour, begin, begin + 3600)
    for name in ("detail_day", "domain_day"):
        wanted, got = spark.read.parquet(f"{whole}/{name}"), spark.read.parquet(f"{hour}/{name}")
        assert set(rows_of(got, "key", "resolver")) <= set(rows_of(wanted, "key", "resolver")) and got.count() > 0
    touched = rows.where(F.col("accesstime").between(hours[0], hours[0] + 3599)).select("domain").distinct().count()
    assert spark.read.parquet(f"{hour}/domain_day").select("domain").distinct().count() >= touched


def test_hourly_job_reads_the_detail_of_its_hour_only(spark, written, tmp_path):
    root, _ = written
    detail = f"{root}/detail"
    first = spark.read.parquet(detail).agg(F.min("accesstime")).first()[0]
    begin, target = first - first % 3600, str(tmp_path / "h")
    rows = hourly.read_report(spark, detail, None, begin, begin + 3600)
    assert {r[0] for r in rows.select("accesstime").distinct().collect()} == {first}
    assert "PartitionFilters: [isnotnull(dt" in rows._jdf.queryExecution().executedPlan().toString()
    hourly.run(spark, detail, target, begin, begin + 3600)
    stored = spark.read.parquet(f"{target}/{hourly.HOURS}")
    assert {r[0] for r in stored.select("hour").distinct().collect()} == {begin}
    # The day's totals come from the stored hours: doubling one of another hour shows.
    other = stored.withColumn("hour", F.lit(begin + 3600)).withColumn("interval", F.lit(begin + 3600))
    other.write.mode("append").partitionBy("dt", "interval").parquet(f"{target}/{hourly.HOURS}")
    before = dict(rows_of(spark.read.parquet(f"{target}/detail_day"), "key", "resolver"))
    hourly.run(spark, detail, target, begin, begin + 3600)
    assert dict(rows_of(spark.read.parquet(f"{target}/detail_day"), "key", "resolver")) == {k: 2 * v for k, v in before.items()}


def test_a_batch_that_broke_off_is_finished_and_counts_as_one(spark, folder, log, written, tmp_path, monkeypatch):
    root, names = written
    target, look = str(tmp_path / "out"), lookups(spark, folder)
    closed = five_minute.interval_groups(log, SIZES)
    done = []
    store = five_minute.append_interval

    def failing(rows, path):
        if len(done) >= 7:
            raise OSError("the disk is gone")
        store(rows, path)
        done.append(path)

    write = stream.report_writer(target, look, SIZES, user_day=f"{target}/user_day")
    with monkeypatch.context() as patch:
        patch.setattr(five_minute, "append_interval", failing)
        with pytest.raises(OSError, match="gone"):
            write(closed, 4)
    assert ledger.committed_intervals(spark, target, "qps").count() == 0 < len(done)
    again = []
    monkeypatch.setattr(five_minute, "append_interval", lambda rows, path: (again.append(path), store(rows, path)))
    write(closed, 4)
    assert not set(done) & set(again) and len(done) + len(again) == len(names) - 1
    write(closed, 4)
    assert len(done) + len(again) == len(names) - 1
    for name in set(names) - {"user_domain"}:
        assert rows_of(ledger.read_committed(spark, target, name).drop("dt", "interval")) == rows_of(spark.read.parquet(f"{root}/{name}").drop("dt", "interval")), name
    text = ledger.read_committed(spark, target, "user_domain", text=True)
    assert rows_of(text, "value") == rows_of(spark.read.text(f"{root}/user_domain"), "value")
    # The days' totals, merged in the flow, after a replay as well.
    wanted = rows_of(user_day(spark.read.parquet(f"{root}/user_rows")), "key", "number", "error", "inNet", "phone")
    assert rows_of(spark.read.parquet(f"{target}/user_day"), "key", "number", "error", "inNet", "phone") == wanted


def test_user_days_grow_interval_by_interval(spark, written, tmp_path):
    root, _ = written
    rows = spark.read.parquet(f"{root}/user_rows").drop("dt", "interval")
    # Two intervals of one day.
    first = rows.agg(F.min("accesstime")).first()[0]
    one = rows.where(F.col("accesstime") == first)
    two = one.withColumns({"accesstime": F.lit(first + 300), "number": F.col("number") * 3})
    target = str(tmp_path / "flow")
    for batch, part in ((0, one), (1, two), (1, two), (0, one)):
        at = five_minute.interval_list(part)
        five_minute.write_tables({"user_rows": part}, target, ledger.Ledger(spark, target, f"b{batch}"), at)
        daily.merge_user_days(spark, target, f"{target}/user_day", at)
    wanted = rows_of(user_day(one.unionByName(two)), "key", "number", "phone")
    assert rows_of(spark.read.parquet(f"{target}/user_day"), "key", "number", "phone") == wanted


def test_nat_jobs_are_repeatable(spark, folder, tmp_path):
    flow = fx.nat_flow(spark, folder)
    root = str(tmp_path / "nat")
    nat.run_hours(spark, flow, root)
    first = rows_of(spark.read.parquet(f"{root}/nat_running"), "key", "count")
    one = spark.read.parquet(f"{root}/nat_hour").agg(F.min("hour")).first()[0]
    at = F.col("accesstime")
    nat.run_hours(spark, flow.where((at >= one) & (at < one + 3600)), root)
    assert rows_of(spark.read.parquet(f"{root}/nat_running"), "key", "count") == first
    hours = spark.read.parquet(f"{root}/nat_hour").groupBy("key").agg(F.sum("count").alias("count"))
    assert rows_of(hours, "key", "count") == first
    lines = parse_nat_lines(spark.createDataFrame([("(17,1.2.3.4,9)",), ("(18,1.2.3.4,1)",), ("(90000,1.2.3.4,5)",)], "value string"))
    for _ in range(2):
        nat.run_days(spark, lines, f"{root}/day")
    assert rows_of(spark.read.parquet(f"{root}/day"), "accesstime", "data", "count") == [(0, "1.2.3.4", 10), (86_400_000, "1.2.3.4", 5)]


def test_interval_job_reads_its_directories(spark, folder, log, written, tmp_path):
    root, _ = written
    end = spark.read.parquet(f"{root}/qps").agg(F.min("accesstime")).first()[0]
    source, target = str(tmp_path / "dns_log"), str(tmp_path / "out")
    slots = [r["path"] for r in slot_paths(spark.createDataFrame([(end,)], "accesstime bigint"), SIZES.seconds, source).collect()]
    at = F.col("Timestamp")
    near = log.where((at >= (end - SIZES.seconds - 10) * 1000) & (at < (end + 10) * 1000))
    as_lines(near).write.text(slots[0])
    five_minute.run_interval(spark, source, end, lookups(spark, folder), target, SIZES)
    wanted = spark.read.parquet(f"{root}/qps").where(F.col("accesstime") == end)
    assert rows_of(spark.read.parquet(f"{target}/qps"), *wanted.columns) == rows_of(wanted)
