"""The rollup jobs: five-minute tables to hours, hours to six hours, five-minute tables to days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import task_windows
from ..functions.times import DAY, HOUR, SIX_HOURS
from ..operators.rollup import BUCKETS, FAMILIES, roll_report
from ..sinks.tables import append_interval
from ..sources.reports import read_report

WINDOW_OF = {"hh": "hour", "6h": "six_hours", "dd": "day"}
SECONDS = {"hh": HOUR, "6h": SIX_HOURS, "dd": DAY}


def chain(rows: DataFrame, types: str, grain: str) -> DataFrame:
    """Roll five-minute rows to a grain; six hours go through the hourly table."""
    if grain == "6h":
        return roll_report(roll_report(rows, types, "hh"), types, "6h")
    return roll_report(rows, types, grain)


def run(spark: SparkSession, task: str, sources: dict[str, str | list[str]], targets: dict[str, str], begin: int, end: int) -> list[str]:
    """Roll every family that has the grain, for ``begin <= accesstime < end``.

    ``sources`` and ``targets`` name the table of each report type; for ``6h`` the sources are the hourly tables. A type
    may have several sources, such as the code tables over all clients and per client; their rows are rolled together.
    The range is widened to whole buckets, since a bucket that is written replaces the one stored.
    """
    begin, end = whole_buckets(spark, task, begin, end)
    done = []
    for types, family in FAMILIES.items():
        if task not in family.grains or types not in sources:
            continue
        paths = [sources[types]] if isinstance(sources[types], str) else sources[types]
        parts = [read_report(spark, path, None if types == "trend" else types, begin, end) for path in paths]
        rows = reduce(DataFrame.unionByName, parts)
        append_interval(roll_report(rows, types, task), targets[types])
        done.append(types)
    return done


def whole_buckets(spark: SparkSession, task: str, begin: int, end: int) -> tuple[int, int]:
    """The smallest range of whole buckets of a grain that holds ``[begin, end)``."""
    low, high = (BUCKETS[task](F.lit(at).cast("bigint")) for at in (begin, end))
    row = spark.range(1).select(low.alias("low"), high.alias("high")).first()
    return row["low"], end if row["high"] == end else row["high"] + SECONDS[task]


def last_window(spark: SparkSession, task: str, now: int) -> tuple[int, int]:
    """The ``[begin, end)`` a scheduled task covers at ``now``."""
    upper, lower = task_windows(F.lit(now).cast("bigint"))[WINDOW_OF[task]]
    row = spark.range(1).select(lower.alias("lower"), upper.alias("upper")).first()
    return row["lower"], row["upper"]
