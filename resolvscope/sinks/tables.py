"""Partitioned tables, upserts and text output."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..functions.times import day_text
from ..sources.logs import FIELD


def with_time_index(rows: DataFrame, time: str = "accesstime") -> DataFrame:
    """Month, day and year labels of the data's own time, to partition tables by."""
    at = F.col(time)
    return rows.withColumns({"month": day_text(at, "yyyyMM"), "dt": day_text(at, "yyyyMMdd"), "year": day_text(at, "yyyy")})


def with_day(rows: DataFrame, time: str = "accesstime") -> DataFrame:
    return rows.withColumn("dt", day_text(F.col(time)).cast("int"))


def with_interval(rows: DataFrame, time: str = "accesstime") -> DataFrame:
    """Partition columns of a table that one interval after the other is written to."""
    return with_day(rows, time).withColumn("interval", F.col(time))


INTERVAL = ("dt", "interval")


# Folders that a task writes, about, where they are known to be many.
FOLDERS = 64


def _balanced(rows: DataFrame, partitions: Sequence[str], folders: int = 1) -> DataFrame:
    """Rows dealt by partition: no heap of small files, and a large partition is still written by several tasks.

    Where many folders are to be written their number counts, not the bytes: merged by size, few bytes of thousands of
    folders would be one task's.
    """
    if folders <= FOLDERS:
        return rows.hint("rebalance", *partitions)
    return rows.repartition(-(-folders // FOLDERS), *partitions)


def _writer(rows: DataFrame, partitions: Sequence[str], folders: int = 1) -> DataFrameWriter:
    writer = _balanced(rows, partitions, folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return writer.partitionBy(*partitions)


def append_report(rows: DataFrame, path: str, partitions: Sequence[str] = ("dt",), folders: int = 1) -> None:
    """Write report rows by partition. Dynamic overwrite replaces the partitions written, so a replay does not double.

    Partitions must be whole: a table filled by intervals is partitioned by interval (:func:`append_interval`). ``folders``
    tells about how many partitions the rows have, if they are many.
    """
    _writer(rows, partitions, folders).parquet(path)


def append_interval(rows: DataFrame, path: str) -> None:
    append_report(with_interval(rows), path, INTERVAL)


def merge_by_key(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Upsert: the new rows, and the existing rows whose key is not among them."""
    kept = existing.join(new.select(key), key, "left_anti")
    return kept.unionByName(new)


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Existing rows win; new keys are added."""
    return existing.unionByName(new.join(existing.select(key), key, "left_anti"))


BUCKET = "bucket"


def with_bucket(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def upsert(
    spark: SparkSession, rows: DataFrame, path: str, key: str, partitions: Sequence[str] = ("dt",), buckets: int = 1
) -> None:
    """Merge rows into a partitioned table by key, reading and rewriting only the partitions that receive rows.

    More than one bucket cuts every partition further by a hash of the key, in a column ``bucket``, so that a merge of few
    keys leaves the rest of a large partition alone. The number is kept with the table; another one raises.

    The merged partitions are staged inside the table's folder, where readers do not look, and published by a swap: a note
    names the staged folder, then each partition takes the old one's place. A run that breaks off before the note leaves the
    old rows; one that breaks off after it is finished by the next upsert or by :func:`finish_swap`.
    Rows must hold each key once; a key that comes twice raises and nothing is written.
    """
    if buckets > 1:
        rows, partitions = with_bucket(rows, key, buckets), (*partitions, BUCKET)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        twice = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key).head()
        if twice is not None:
            raise ValueError(f"upsert: several rows have the key {twice[0]!r}")
        finish_swap(spark, path)
        _check_buckets(spark, path, buckets)
        # As many values as there are folders to write, which the driver moves one by one anyway.
        touched = [tuple(r) for r in rows.select(*partitions).distinct().collect()]
        rows_now = rows
        if _partition_names(spark, path):
            existing = touched_partitions(spark.read.parquet(path), partitions, touched)
            rows_now = merge_by_key(existing.select(*rows.columns), rows, key)
        staged = f"_staged-{uuid.uuid4().hex}"
        _balanced(rows_now, partitions, len(touched)).write.partitionBy(*partitions).parquet(f"{path}/{staged}")
        files.publish_text(spark, f"{path}/{SWAP}", staged)
        finish_swap(spark, path)
    finally:
        rows.unpersist()


def touched_partitions(table: DataFrame, partitions: Sequence[str], touched: list[tuple]) -> DataFrame:
    """The rows of the named partitions. Values are literals, so that the scan lists and reads no other folder."""

    def held(column: str, values: set) -> Column:
        known = F.col(column).isin([v for v in values if v is not None])
        return known | F.col(column).isNull() if None in values else known

    wide = table
    for place, column in enumerate(partitions):
        wide = wide.where(held(column, {t[place] for t in touched}))
    if len(partitions) == 1:
        return wide
    # Each column's values alone admit more than the combinations that are asked for.
    schema = ", ".join(f"_{c} {table.schema[c].dataType.simpleString()}" for c in partitions)
    exact = table.sparkSession.createDataFrame(touched, schema)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partitions]
    return wide.join(exact, reduce(Column.__and__, same), "left_semi")


# Holds the number of buckets of a table that has more than one.
BUCKETS = "_buckets"


def _check_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    stored = files.read_text(spark, f"{path}/{BUCKETS}")
    if stored is None and not _partition_names(spark, path):
        if buckets > 1:
            files.publish_text(spark, f"{path}/{BUCKETS}", str(buckets))
    elif int(stored or 1) != buckets:
        raise ValueError(f"upsert: {path} has {int(stored or 1)} buckets, not {buckets}")


# Names the staged folder whose partitions replace the table's.
SWAP = "_swap"


def finish_swap(spark: SparkSession, path: str) -> None:
    """Put what a merge has staged in place, if its note is there. What is staged is still to be moved, so this can run again."""
    staged = files.read_text(spark, f"{path}/{SWAP}")
    if staged is None:
        return

    def move(part: str) -> None:
        files.remove(spark, f"{path}/{part}")
        if not files.rename(spark, f"{path}/{staged}/{part}", f"{path}/{part}"):
            raise OSError(f"cannot move {staged}/{part} into {path}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(move, _partition_folders(spark, f"{path}/{staged}")))
    files.remove(spark, f"{path}/{SWAP}")
    files.remove(spark, f"{path}/{staged}")
    spark.catalog.refreshByPath(path)


def _partition_folders(spark: SparkSession, folder: str) -> list[str]:
    """The innermost ``column=value`` folders. All lie equally deep, so one of each level tells whether there is a next."""
    found = _partition_names(spark, folder)
    while found and (_partition_names(spark, f"{folder}/{found[0]}")):
        found = [f"{above}/{name}" for above in found for name in _partition_names(spark, f"{folder}/{above}")]
    return found


def _partition_names(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in files.names(spark, folder) if "=" in n and not n.startswith((".", "_"))]


def _line() -> Column:
    return F.concat_ws(FIELD, "userName", "domain", F.col("resolver").cast("string"))


def user_domain_lines(rows: DataFrame) -> DataFrame:
    return rows.select(_line().alias("value"))


def write_user_domains(rows: DataFrame, path: str, files: int | None = None) -> None:
    """``user, domain, n`` text by day and interval. ``files`` merges the output of small intervals."""
    lines = with_interval(rows).select(*INTERVAL, _line().alias("value"))
    if files:
        # A shuffle, so that what is upstream keeps its own number of tasks.
        lines.repartition(files).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *INTERVAL
        ).text(path)
    else:
        _writer(lines, INTERVAL).text(path)
