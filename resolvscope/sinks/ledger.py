"""Which report tables of a batch are whole: a batch's intervals count once every one of its tables is written."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files

ENTRY = "batch string, tables array<string>, intervals array<bigint>"


class Ledger:
    """The notes of one batch under ``root``: a mark for each table that is written, and at last the entry that commits all.

    A batch that broke off finds its marks when it runs again and writes what is missing. Tables are overwritten by interval,
    so one that was written but not yet marked is written again without harm.
    """

    def __init__(self, spark: SparkSession, root: str, batch: str):
        self.spark, self.batch = spark, batch
        self.marks = f"{root}/_ledger/marks/{batch}"
        self.entry = f"{root}/_ledger/entries/{batch}.json"

    def is_committed(self) -> bool:
        return files.exists(self.spark, self.entry)

    def written(self) -> set[str]:
        return set(files.names(self.spark, self.marks))

    def mark(self, table: str) -> None:
        files.publish_text(self.spark, f"{self.marks}/{table}", "")

    def commit(self, tables: list[str], intervals: list[int]) -> None:
        entry = json.dumps({"batch": self.batch, "tables": sorted(tables), "intervals": sorted(intervals)})
        files.publish_text(self.spark, self.entry, entry)
        files.remove(self.spark, self.marks)

    def reopen(self) -> None:
        """Take the commit back, so that the batch is written anew."""
        files.remove(self.spark, self.entry)
        files.remove(self.spark, self.marks)


def committed_intervals(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Intervals of which a table and all the tables written with it are whole, each once."""
    entries = f"{root}/_ledger/entries"
    rows = spark.read.schema(ENTRY).json(entries) if files.names(spark, entries) else spark.createDataFrame([], ENTRY)
    return rows.where(F.array_contains("tables", table)).select(F.explode("intervals").alias("interval")).distinct()


def read_committed(spark: SparkSession, root: str, table: str, text: bool = False) -> DataFrame:
    """Rows of a table's committed intervals; the table is partitioned by interval, so Spark prunes the others."""
    rows = spark.read.text(f"{root}/{table}") if text else spark.read.parquet(f"{root}/{table}")
    return rows.join(committed_intervals(spark, root, table), "interval", "left_semi")
