"""Backfill with the lookups of the time that is replayed."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import Lookups
from ..sources.history import snapshot, snapshot_days
from . import five_minute
from .five_minute import Sizes

TABLES = [f.name for f in fields(Lookups)]


def day_starts(spark: SparkSession, days: list[int]) -> dict[int, int]:
    """Epoch second at which each day starts in the session zone."""
    dated = spark.createDataFrame([(d,) for d in days], "day int")
    start = F.unix_timestamp(F.to_timestamp(F.col("day").cast("string"), "yyyyMMdd"))
    return {r["day"]: r["start"] for r in dated.select("day", start.alias("start")).collect()}


def spans(spark: SparkSession, history: str, begin: int, end: int, seconds: int) -> list[tuple[int, int, int]]:
    """(low, high, day) that make up ``[begin, end)``: from ``low`` to ``high`` the snapshots up to ``day`` hold.

    A new snapshot counts from the interval that its day starts in. Days without a new snapshot start no span.
    """
    days = sorted({d for name in TABLES for d in snapshot_days(spark, f"{history}/{name}")})
    starts = {d: at - at % seconds for d, at in day_starts(spark, days).items()}
    known = [d for d in days if starts[d] <= begin]
    later = [d for d in days if begin < starts[d] < end]
    held = [known[-1] if known else 0, *later]
    cuts = [begin, *[starts[d] for d in later], end]
    return [(low, high, day) for low, high, day in zip(cuts, cuts[1:], held, strict=False) if low < high]


def lookups_on(spark: SparkSession, history: str, day: int) -> Lookups:
    """All lookup tables as they were on a day."""
    return Lookups(**{name: snapshot(spark, f"{history}/{name}", day) for name in TABLES})


def run(
    spark: SparkSession, log: DataFrame, history: str, root: str, begin: int, end: int, sizes: Sizes = Sizes()
) -> list[tuple[int, int, int]]:
    """Write and commit all report tables of ``[begin, end)``, whole intervals, each with the lookups of its time.

    Work is cut where a lookup table changes, not by day, and range indexes of unchanged rules are found by their content.
    Each span is a run of its own: a replay that broke off goes on where it was, and one that is repeated changes nothing.
    """
    at = F.col("Timestamp")
    found = spans(spark, history, begin, end, sizes.seconds)
    for low, high, day in found:
        five_minute.run(log.where((at >= low * 1000) & (at < high * 1000)), lookups_on(spark, history, day), root, sizes)
    return found
