"""Closed intervals from a stream of cleaned rows, and every report of them.

One stateful aggregate per stream: the rows are summed over all columns the reports group by. In append mode each closed
interval comes out once, with all its groups in one batch, so ``foreachBatch`` can run the batch operators on it,
including grouping sets and top-k lists that a streaming plan itself cannot hold. Late rows are dropped by the watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import FIVE_MINUTES
from ..operators.clean import clean_log
from ..operators.enrich import Lookups
from ..plans import daily
from ..plans.five_minute import GROUPS, Sizes, all_tables, enrich_groups, interval_list, persisting, write_tables
from ..sinks.ledger import Ledger

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    """Keep stream state in RocksDB, off the heap: an interval's groups may not fit an executor's memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def closed_intervals(log: DataFrame, seconds: int = FIVE_MINUTES, delay: str = "5 minutes") -> DataFrame:
    """Lookups and errors per closed interval and group."""
    rows = clean_log(log).withColumn("ts", F.timestamp_millis("logTimestamp")).withWatermark("ts", delay)
    return (
        rows.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), *GROUPS)
        .agg(F.sum("resolver").alias("resolver"), F.sum("error").alias("error"))
        .select(F.col("w.end").cast("bigint").alias("accesstime"), *GROUPS, "resolver", "error")
    )


def report_writer(
    root: str, lookups: Lookups | Callable[[], Lookups], sizes: Sizes = Sizes(), only: list[str] | None = None, user_day: str | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes the report tables of the closed intervals in a batch, and commits them together.

    A batch that is replayed after a failure writes the tables that have no mark in its ledger; one that was committed is
    passed over. ``lookups`` may be a function; it is called for each batch that closes an interval, so rule tables that were
    replaced meanwhile are read anew. ``user_day`` names a table of running day totals: the users' rows of the batch are
    merged into their days once the batch is committed, from the stored intervals, so a replay adds nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        ledger = Ledger(spark, root, f"{query}-{batch_id}")
        with persisting() as keep:
            closed = keep(batch)
            # Materialises the stateful batch once, before several tables are written from it. Most batches close no interval.
            intervals = interval_list(closed)
            if intervals and not ledger.is_committed():
                ready = (lookups() if callable(lookups) else lookups).prepare()
                groups = keep(enrich_groups(closed, ready))
                write_tables(all_tables(groups, ready, sizes, keep, only), root, ledger, intervals)
            if intervals and user_day:
                daily.merge_user_days(spark, root, user_day, intervals)

    return write


def start(
    log: DataFrame,
    lookups: Lookups | Callable[[], Lookups],
    root: str,
    checkpoint: str,
    sizes: Sizes = Sizes(),
    delay: str = "5 minutes",
    trigger: dict | None = None,
    only: list[str] | None = None,
    user_day: str | None = None,
) -> StreamingQuery:
    """Start the interval job. ``trigger`` defaults to one batch per interval."""
    use_disk_state(log.sparkSession)
    closed = closed_intervals(log, sizes.seconds, delay)
    return (
        closed.writeStream.outputMode("append")
        .foreachBatch(report_writer(root, lookups, sizes, only, user_day))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{sizes.seconds} seconds"}))
        .start()
    )
