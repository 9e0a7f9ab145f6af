"""Stored report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import day_text


def read_report(spark: SparkSession, path: str, types: str | None = None, begin: int | None = None, end: int | None = None) -> DataFrame:
    """Report rows of one type with ``begin <= accesstime < end``.

    The tables are partitioned by type and day, so the filters prune partitions first and row groups after.
    """
    rows = spark.read.parquet(path)
    if types is not None:
        rows = rows.where(F.col("types") == types)
    if begin is not None:
        rows = rows.where((F.col("accesstime") >= begin) & (F.col("dt") >= day_text(F.lit(begin)).cast("int")))
    if end is not None:
        rows = rows.where((F.col("accesstime") < end) & (F.col("dt") <= day_text(F.lit(end)).cast("int")))
    return rows
