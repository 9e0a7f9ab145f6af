"""Lookup tables as they were: dated snapshots, and the versions of a key that they make up.

A snapshot holds a whole table as of the start of its day, under ``<path>/dt=<yyyyMMdd>``; it holds until the next one's day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import files


def store_snapshot(rows: DataFrame, path: str, day: int) -> None:
    """Store a table as of a day (``yyyyMMdd``); a snapshot of the same day is replaced."""
    rows.write.mode("overwrite").parquet(f"{path}/dt={day}")


def snapshot_days(spark: SparkSession, path: str) -> list[int]:
    """Days that have a whole snapshot, from the folders' names; no data is read."""
    days = [n.removeprefix("dt=") for n in files.names(spark, path) if n.startswith("dt=")]
    return sorted(int(d) for d in days if files.exists(spark, f"{path}/dt={d}/_SUCCESS"))


def snapshot(spark: SparkSession, path: str, day: int) -> DataFrame:
    """The table as it was on a day: its last snapshot up to then, of which alone the files are read.

    Before the first snapshot nothing is known: its columns, and no rows. A table without any raises.
    """
    days = snapshot_days(spark, path)
    if not days:
        raise ValueError(f"no snapshot of a table in {path}")
    held = [d for d in days if d <= day]
    rows = spark.read.parquet(f"{path}/dt={held[-1] if held else days[0]}")
    return rows if held else rows.where(F.lit(False))


def versions(snapshots: DataFrame, key: str, values: list[str], day: str = "dt") -> DataFrame:
    """(key, values, valid_from, valid_to) from the rows of all snapshots; ``valid_to`` is not included, null if still open.

    A key that a snapshot lacks is unknown until one has it again. Snapshots that repeat a key's values extend its version,
    so the result grows with changes, not with days. A key that a snapshot holds twice has the greater values, as in the
    lookups. No day has two versions of a key.
    """
    days = snapshots.select(day).distinct()
    # One row a day.
    spans = days.select(F.col(day).alias("valid_from"), F.lead(day).over(Window.orderBy(day)).alias("valid_to"))
    held = snapshots.groupBy(key, F.col(day).alias("valid_from")).agg(F.max(F.struct(*values)).alias("held"))
    dated = held.join(spans, "valid_from")
    before = Window.partitionBy(key).orderBy("valid_from")
    goes_on = F.lag("valid_to").over(before).eqNullSafe(F.col("valid_from")) & F.lag("held").over(before).eqNullSafe(F.col("held"))
    numbered = dated.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("version", F.sum("new").over(before))
    whole = numbered.groupBy(key, "version").agg(
        F.first("held").alias("held"), F.min("valid_from").alias("valid_from"), F.max_by("valid_to", "valid_from").alias("valid_to")
    )
    return whole.select(key, *[F.col("held")[v].alias(v) for v in values], "valid_from", "valid_to")


def as_of(rows: DataFrame, versions: DataFrame, key: str, values: list[str], day: str) -> DataFrame:
    """Rows with the values that their key had on their day (``yyyyMMdd``), null where it had none.

    One equi join for all days: a key's versions are few, and the versions are dealt so that a hot key of the rows is split.
    """
    dim = versions.select(F.col(key).alias("_key"), *[F.col(v) for v in values], "valid_from", "valid_to")
    dim = dim.repartition(F.xxhash64("_key"))
    holds = (F.col("valid_from") <= F.col(day)) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    return rows.join(dim, (F.col(key) == F.col("_key")) & holds, "left").drop("_key", "valid_from", "valid_to")
