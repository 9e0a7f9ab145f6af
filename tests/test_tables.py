"""Sources and sinks."""

from __future__ import annotations

import threading
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from resolvscope.sinks import tables
from resolvscope.sources import logs, lookups, reports


def report(spark, *rows):
    return spark.createDataFrame(rows, "accesstime bigint, key string, number bigint")


def test_replayed_interval_replaces_itself_and_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_interval(report(spark, (300, "a", 1), (300, "b", 1)), path)
    tables.append_interval(report(spark, (600, "a", 2)), path)
    tables.append_interval(report(spark, (300, "a", 5)), path)
    assert rows_of(spark.read.parquet(path), "accesstime", "key", "number") == [(300, "a", 5), (600, "a", 2)]


def test_upsert_replaces_keys_and_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, tables.with_day(report(spark, (10, "a", 1), (20, "b", 1), (90000, "c", 1))), path, "key")
    tables.upsert(spark, tables.with_day(report(spark, (30, "b", 2), (40, "d", 2))), path, "key")
    tables.upsert(spark, tables.with_day(report(spark, (30, "b", 2), (40, "d", 2))), path, "key")
    assert rows_of(spark.read.parquet(path), "key", "number") == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]


@pytest.mark.parametrize("moves", [0, 1])
def test_upsert_that_breaks_off_keeps_old_or_new_rows(spark, tmp_path, monkeypatch, moves):
    """It fails before the note, or after the note with some partitions moved; the next merge goes on from there."""
    path = str(tmp_path / "t")
    old = [(10, "a", 1), (90000, "c", 1)]
    tables.upsert(spark, tables.with_day(report(spark, *old)), path, "key")
    real, moved, lock = tables.files.rename, [], threading.Lock()

    def rename(session, source, target):
        # Partitions are moved by several threads.
        with lock:
            if len(moved) >= moves + (moves > 0):
                raise OSError("broke off")
            moved.append(target)
        return real(session, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(tables.files, "rename", rename)
        with pytest.raises(OSError, match="broke off"):
            tables.upsert(spark, tables.with_day(report(spark, (20, "a", 2), (90001, "d", 2))), path, "key")
    if moves:
        tables.finish_swap(spark, path)
        want = [("a", 2), ("c", 1), ("d", 2)]
    else:
        want = [("a", 1), ("c", 1)]
    spark.catalog.refreshByPath(path)
    assert rows_of(spark.read.parquet(path), "key", "number") == want
    tables.upsert(spark, tables.with_day(report(spark, (30, "e", 5))), path, "key")
    assert rows_of(spark.read.parquet(path), "key", "number") == sorted([*want, ("e", 5)], key=repr)


def files_of(path):
    return {p for p in Path(path).rglob("*.parquet") if "_staged" not in str(p)}


def test_upsert_rewrites_only_the_buckets_that_get_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(t, f"k{i}", i) for i in range(64) for t in (10 + i,)] + [(90000 + i, f"n{i}", i) for i in range(64)]
    tables.upsert(spark, tables.with_day(report(spark, *rows)), path, "key", buckets=8)
    before = files_of(path)
    assert len({p.parent for p in before}) == 16
    tables.upsert(spark, tables.with_day(report(spark, (99, "k3", 300), (98, "new", 7))), path, "key", buckets=8)
    after = files_of(path)
    assert 1 <= len({p.parent for p in before - after}) <= 2
    want = sorted([(k, n) for _, k, n in rows if k != "k3"] + [("k3", 300), ("new", 7)], key=repr)
    assert rows_of(spark.read.parquet(path), "key", "number") == want
    with pytest.raises(ValueError, match="8 buckets, not 1"):
        tables.upsert(spark, tables.with_day(report(spark, (99, "k3", 1))), path, "key")
    assert files_of(path) == after


def test_touched_partitions_reach_the_scan_and_nulls_count(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "key string, dt int, bucket int"
    rows = [("a", 1, 0), ("b", 1, 1), ("c", 2, 0), ("d", 2, 1), ("e", None, 0)]
    spark.createDataFrame(rows, schema).write.partitionBy("dt", "bucket").parquet(path)
    table = spark.read.parquet(path)
    got = tables.touched_partitions(table, ("dt", "bucket"), [(1, 0), (2, 1), (None, 0)])
    assert rows_of(got, "key") == [("a",), ("d",), ("e",)]
    one = tables.touched_partitions(table, ("dt",), [(1,)])
    assert rows_of(one, "key") == [("a",), ("b",)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dt" in plan.split("PartitionFilters")[1].split("]")[0]


def test_upsert_keeps_rows_without_a_day(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("k", 1, None), ("l", 2, None), ("m", 3, 20240101)], "key string, n int, dt int")
    tables.upsert(spark, rows, path, "key")
    tables.upsert(spark, spark.createDataFrame([("k", 9, None)], "key string, n int, dt int"), path, "key")
    assert rows_of(spark.read.parquet(path), "key", "n") == [("k", 9), ("l", 2), ("m", 3)]


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", 1)], "domain string, counts int")
    new = spark.createDataFrame([("a", 9), ("b", 9)], "domain string, counts int")
    assert rows_of(tables.insert_if_absent(old, new, "domain")) == [("a", 1), ("b", 9)]


def test_time_index_is_the_datas_own_time(spark):
    row = tables.with_time_index(report(spark, (1704067199, "a", 1))).first()
    assert (row["year"], row["month"], row["dt"]) == ("2023", "202312", "20231231")


def test_user_domain_text_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(300, "u", 'd"1', 2), (300, "v", "d2", 1), (600, "u", "d3", 4)], "accesstime bigint, userName string, domain string, resolver bigint")
    tables.write_user_domains(rows, path, files=1)
    assert rows_of(logs.read_user_domains(spark, path)) == [("u", 'd"1', 2), ("u", "d3", 4), ("v", "d2", 1)]


def test_short_user_domain_lines(spark, tmp_path):
    path = str(tmp_path / "t")
    text = ["u\u0001d\u00017", "u\u0001d", "u", "u\u0001d\u0001x"]
    spark.createDataFrame([(t,) for t in text], "value string").write.text(path)
    assert rows_of(logs.read_user_domains(spark, path)) == [("u", "", 1), ("u", "d", 1), ("u", "d", 1), ("u", "d", 7)]


def test_flow_lines_of_another_shape_fail(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1\tc\ts\td\t5",), ("1\tc\ts",)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        logs.read_flows(spark, path).collect()


def test_nat_lines(spark):
    lines = spark.createDataFrame([("(17,1.2.3.4,9)",), ("junk",), ("(x,1.2.3.4,9)",)], "value string")
    assert rows_of(logs.parse_nat_lines(lines)) == [(17, "1.2.3.4", 9)]


def test_interval_reads_its_slots_and_the_one_before(spark):
    windows = spark.createDataFrame([(1577262000,)], "accesstime bigint")
    got = sorted(logs.slot_paths(windows).collect(), key=lambda r: r.slot)
    assert len(got) == 31
    assert got[0].path == "/dns_log/2019/12/25/081450_1577261690"
    assert got[-1].slot == 1577262000 - 10
    some = spark.createDataFrame([(1577261690,), (1577262000,)], "slot bigint")
    assert [r.slot for r in logs.existing_slots(windows, some).collect()] == [1577261690]


def test_window_read_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("20191225", "0814", 1), ("20191225", "0815", 2), ("20191225", "0900", 3)], "dt string, hhmm string, n int")
    rows.write.partitionBy("dt", "hhmm").parquet(path)
    read = logs.read_window(spark, path, 1577261700)
    assert rows_of(read, "n") == [(1,), (2,)]
    assert "PartitionFilters: [" in read._jdf.queryExecution().executedPlan().toString()
    assert rows_of(logs.read_window(spark, path, 1), "n") == []


def test_report_range_prunes_type_and_day(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = report(spark, (300, "a", 1), (90000, "b", 2), (200000, "c", 3)).withColumn("types", F.lit("qps"))
    tables.append_report(tables.with_day(rows.unionByName(rows.withColumn("types", F.lit("user")))), path, ("types", "dt"))
    read = reports.read_report(spark, path, "qps", 300, 200000)
    assert rows_of(read, "key", "types") == [("a", "qps"), ("b", "qps")]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(types" in plan and "GreaterThanOrEqual(accesstime,300)" in plan


def test_missing_table_is_empty(spark, tmp_path):
    assert logs.read_if_exists(spark, str(tmp_path / "none"), "a int").collect() == []


def test_geo_text_needs_eleven_fields(spark):
    full = "亚洲|中国|浙江|杭州||电信|330100|China|CN|120|30"
    rows = spark.createDataFrame([(0, 9, full), (10, 19, "亚洲|中国|浙江|杭州||电信|330100|China|CN||"), (20, 29, "")], "lo bigint, hi bigint, value string")
    (row,) = lookups.geo_ranges(rows).collect()
    assert (row.country, row.operator, row.lat) == ("中国", "电信", "30")


def test_json_lookup_and_unknown_phone(spark):
    values = spark.createDataFrame([('{"username":"u","doorDesc":"d","mobile":""}',), ('{"username":"v","doorDesc":"e","mobile":"1"}',)], "value string")
    assert rows_of(lookups.user_contacts(values)) == [("u", "d", "未知"), ("v", "e", "1")]


def test_jdbc_reads_are_split():
    options = lookups.jdbc_options("jdbc:x", "dns_media", "id", (0, 100), 4, user="u")
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id" and options["user"] == "u"
    assert "numPartitions" not in lookups.jdbc_options("jdbc:x", "dns_media")


def test_rules_from_a_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2, 3, 4, 5)], "min_long_ip bigint, max_long_ip bigint, s_id int, company_id int, resource_id int").write.parquet(path)
    assert rows_of(lookups.business_rules(lookups.read_rules(spark, path))) == [(1, 2, "3", "4", "5")]


def test_upsert_refuses_a_key_that_comes_twice(spark, tmp_path):
    rows = spark.createDataFrame([("k", 1, 20240101), ("k", 2, 20240101)], "key string, n int, dt int")
    target = str(tmp_path / "t")
    with pytest.raises(ValueError, match="'k'"):
        tables.upsert(spark, rows, target, "key")
    tables.upsert(spark, rows.where("n = 1"), target, "key")
    with pytest.raises(ValueError, match="'k'"):
        tables.upsert(spark, rows, target, "key")
    tables.upsert(spark, rows.where("n = 2"), target, "key")
    assert [(r.key, r.n) for r in spark.read.parquet(target).collect()] == [("k", 2)]


def test_user_day_keeps_one_row_when_a_contact_changes(spark):
    from resolvscope.operators.daily import user_day

    schema = "accesstime long, clientName string, userName string, domain string, clientIp string, phone string, address string, number long, error long, inNet long"
    rows = [(1700000100, "c", "u", "d", "ip", "111", "a", 2, 1, 0), (1700000400, "c", "u", "d", "ip", "222", "b", 3, 0, 1)]
    got = user_day(spark.createDataFrame(rows, schema)).collect()
    assert [(r.phone, r.address, r.number, r.error, r.inNet) for r in got] == [("222", "b", 5, 1, 1)]
